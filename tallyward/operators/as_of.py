"""Facts with the version of a slowly changing row that was valid at their time, without a range join.

Facts and versions are united and ordered by time within their key, and the last version is carried forward. A key's history is cut into
time ranges, so that no task orders a whole key; each range starts with the version that was last before it, which follows from one row
per key and range. Facts of a hot key can be spread further: each part of them meets all versions of its range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = ("day", "week", "month", "quarter", "year")

# Within the same moment a version comes before the facts, and the one carried into a range before all others.
CARRIED, VERSION, FACT = 0, 1, 2


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    time: str,
    valid_from: str = "valid_from",
    valid_to: str | None = "valid_to",
    every: str = "month",
    spread: int = 1,
) -> DataFrame:
    """All facts with the attributes of the version of their key that was valid at ``time``: NULL where there is none.

    A version holds from ``valid_from`` on, that moment included, up to the next version of its key or up to ``valid_to``, not
    included. Versions that begin at the same moment exclude each other; the one with the later (or an open) end counts. Keys compare
    NULL-safe. Facts without a time, and versions without a beginning, meet nothing; such facts stay. Attributes must not have the
    names of the facts' columns.

    ``every`` cuts the keys into ranges of time, ``spread`` the facts of each range into so many parts.
    """
    if every not in RANGES:
        raise ValueError(f"every must be one of {RANGES}")
    attributes = [name for name in versions.columns if name not in keys]
    if clashing := set(attributes) & set(facts.columns):
        raise ValueError(f"the facts have columns of the same name: {sorted(clashing)}")
    # Columns of both sides travel in structs, so that no name of theirs meets one of these.
    key = F.struct(*[F.col(name).alias(f"k{i}") for i, name in enumerate(keys)])
    begin = F.col(valid_from).cast("timestamp")
    end = F.col(valid_to).cast("timestamp") if valid_to else F.lit(None).cast("timestamp")
    fact = facts.select(
        key.alias("key"), F.col(time).cast("timestamp").alias("at"), F.struct(*facts.columns).alias("fact")
    ).withColumn("part", F.pmod(F.xxhash64("fact"), F.lit(spread)) if spread > 1 else F.lit(0).cast("bigint"))
    version = versions.select(key.alias("key"), begin.alias("at"), end.alias("until"), F.struct(*attributes).alias("version")).where("at is not null")

    ranged = [frame.withColumn("range", F.date_trunc(every, "at")) for frame in (fact, version)]
    fact, version = ranged
    order = F.struct("at", F.coalesce("until", F.lit("9999-12-31").cast("timestamp")), "version")
    state = F.struct("until", "version")

    # One row per key and range: whether facts lie there, and its last version. The last of the ranges before is carried in.
    met = fact.groupBy("key", "range").agg(F.lit(True).alias("met")).select("key", "range", "met", F.lit(None).alias("last"))
    held = version.groupBy("key", "range").agg(F.max_by(state, order).alias("last"))
    ranges = held.select("key", "range", F.lit(False).alias("met"), "last").unionByName(met)
    ranges = ranges.groupBy("key", "range").agg(F.max("met").alias("met"), F.first("last", ignorenulls=True).alias("last"))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.withColumn("state", F.last("last", ignorenulls=True).over(earlier)).where("met and state is not null")

    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint")))
    nothing = F.lit(None).cast(fact.schema["fact"].dataType)
    rows = [
        fact.select("key", "range", "part", "at", F.lit(FACT).alias("kind"), "fact", F.lit(None).cast(carried.schema["state"].dataType).alias("state")),
        version.select("key", "range", parts.alias("part"), "at", F.lit(VERSION).alias("kind"), nothing.alias("fact"), state.alias("state")),
        carried.select("key", "range", parts.alias("part"), F.col("range").alias("at"), F.lit(CARRIED).alias("kind"), nothing.alias("fact"), "state"),
    ]
    united = rows[0].unionByName(rows[1]).unionByName(rows[2])
    ordered = Window.partitionBy("key", "range", "part").orderBy(
        "at", "kind", F.coalesce("state.until", F.lit("9999-12-31").cast("timestamp")), "state.version"
    )
    last = F.last("state", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    valid = F.col("at").isNotNull() & (F.col("last.until").isNull() | (F.col("at") < F.col("last.until")))
    found = united.withColumn("last", last).where(F.col("kind") == FACT)
    return found.select("fact.*", *[F.when(valid, F.col("last.version")[name]).alias(name) for name in attributes])
