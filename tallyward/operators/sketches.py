"""Distinct counts, quantiles, histograms and text lengths per country and day, in a form that adds up.

They are columns of the stored base, made in the aggregate that writes it. Any coarser period, or the whole table, is read off by merging
them, without another look at the rows. Distinct counts are HyperLogLog sketches, quantiles KLL sketches; histograms and lengths are
exact. A sketch has a bounded size, and is small where a country-day has few values.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, NumericType, StringType, StructType

from tallyward.functions.frames import rows_from_aggregate
from tallyward.operators.observability import LOOKBACK, MINIMUM_HISTORY, number

# 2 ** 12 registers: one standard error is 1.6 percent.
REGISTERS_LOG2 = 12
DISTINCT_ERROR = 1.04 / 2 ** (REGISTERS_LOG2 / 2)
# The rank of a quantile is right to about one percent.
KLL_SIZE = 400
RANK_TOLERANCE = 0.03
QUANTILES = (0.0, 0.25, 0.5, 0.75, 0.95, 1.0)
# A histogram counts values from one edge up to the next; the first class holds all below 1, the last is open.
EDGES = tuple(2**n for n in range(15))

# Above this the population stability index counts as a shift; the Kolmogorov-Smirnov distance must be significant at one percent.
SHIFT = 0.2
SIGNIFICANT = 1.63
PERIODS = {"day": "date", "month": "cast(trunc(date, 'month') as date)"}


def _as_text(column: str, schema: StructType) -> Column:
    """A value as text for a sketch of different values; both zeros of a double are one. Sketches pass over empty texts, hence the mark."""
    value = F.col(column)
    return F.concat(F.lit("="), (value + F.lit(0.0) if schema[column].dataType.typeName() == "double" else value).cast("string"))


def _tails(value: Column) -> Column:
    """How many values there are, and how many from each edge up.

    They are counted by class, by one aggregate: a histogram with a bin for each class merges none, so it is exact, and it costs far less
    than a count for each edge.
    """
    of_class = reduce(lambda a, b: a + b, [F.when(value >= edge, 1).otherwise(0) for edge in EDGES])
    bins = F.histogram_numeric(F.when(value.isNotNull(), of_class.cast("double")), F.lit(len(EDGES) + 1))
    classes = F.sequence(F.lit(0), F.lit(len(EDGES)))
    tails = F.transform(classes, lambda c: F.aggregate(bins, F.lit(0.0), lambda n, b: n + F.when(b["x"] >= c - 0.5, b["y"]).otherwise(0.0)))
    return F.transform(tails, lambda n: F.coalesce(n, F.lit(0.0)).cast("bigint"))


def sketch_columns(schema: StructType, columns: Iterable[str]) -> list[Column]:
    """The aggregates to add to the base for the named staged columns, by their types."""
    found = []
    for name in columns:
        value, kind = F.col(name), schema[name].dataType
        found.append(F.hll_sketch_agg(_as_text(name, schema), F.lit(REGISTERS_LOG2)).alias(f"distinct_{name}"))
        if isinstance(kind, NumericType):
            found.append(F.kll_sketch_agg_double(value.cast("double"), F.lit(KLL_SIZE)).alias(f"quantiles_{name}"))
            found.append(_tails(value).alias(f"tails_{name}"))
        elif isinstance(kind, StringType):
            length = F.length(value)
            found.append(
                F.struct(
                    F.count(value).alias("count"),
                    F.count_if(value == "").alias("empty"),
                    F.sum(length).alias("sum"),
                    F.min(length).alias("least"),
                    F.max(length).alias("largest"),
                ).alias(f"lengths_{name}")
            )
    return found


def sketched(base: DataFrame, kind: str) -> list[str]:
    """The columns for which the base holds sketches of a kind: distinct, quantiles, tails or lengths."""
    return [name.removeprefix(f"{kind}_") for name in base.columns if name.startswith(f"{kind}_")]


def _by(base: DataFrame, period: str) -> DataFrame:
    return base.withColumn("period", F.expr(PERIODS[period]))


def distinct_by(base: DataFrame, period: str = "day") -> DataFrame:
    """(period, column_name, distinct_estimate) of every column that has a sketch."""
    rows = [
        {"column_name": F.lit(name), "distinct_estimate": F.hll_sketch_estimate(F.hll_union_agg(f"distinct_{name}"))}
        for name in sketched(base, "distinct")
    ]
    return rows_from_aggregate(_by(base, period), rows, ["period"])


def quantiles_by(base: DataFrame, period: str = "day", quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(period, column_name, value_count, quantile, value); those of 0 and 1 are exact, and a column without values has none."""
    rows = [
        {"column_name": F.lit(name), "sketch": F.kll_merge_agg_double(f"quantiles_{name}", F.lit(KLL_SIZE))}
        for name in sketched(base, "quantiles")
    ]
    merged = rows_from_aggregate(_by(base, period), rows, ["period"])
    counted = merged.withColumn("value_count", F.kll_sketch_get_n_double("sketch")).where("value_count > 0")
    each = F.array(*[F.struct(F.lit(q).alias("quantile"), F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("value")) for q in quantiles])
    return counted.select("period", "column_name", "value_count", F.inline(each))


def lengths_by(base: DataFrame, period: str = "day") -> DataFrame:
    """(period, column_name, metric, value): count, empty_count and least, largest and average length of each text column."""
    rows = []
    for name in sketched(base, "lengths"):
        part = F.col(f"lengths_{name}")
        metrics = {
            "value_count": F.sum(part["count"]),
            "empty_count": F.sum(part["empty"]),
            "min_length": F.min(part["least"]),
            "max_length": F.max(part["largest"]),
            "average_length": F.try_divide(F.sum(part["sum"]), F.sum(part["count"])),
        }
        rows += [{"column_name": F.lit(name), "metric": F.lit(m), "value": number(v)} for m, v in metrics.items()]
    return rows_from_aggregate(_by(base, period), rows, ["period"])


def histograms_by(base: DataFrame, period: str = "day") -> DataFrame:
    """(period, column_name, counts): how many values lie in each class of :data:`EDGES`."""
    rows = []
    for name in sketched(base, "tails"):
        tails = [F.sum(F.col(f"tails_{name}")[i]) for i in range(len(EDGES) + 1)]
        counts = [a - b for a, b in zip(tails, tails[1:], strict=False)] + [tails[-1]]
        rows.append({"column_name": F.lit(name), "counts": F.array(*counts)})
    return rows_from_aggregate(_by(base, period), rows, ["period"])


def distribution_anomalies(
    histograms: DataFrame,
    lookback: int = LOOKBACK,
    minimum: int = MINIMUM_HISTORY,
    shift: float = SHIFT,
    significant: float = SIGNIFICANT,
) -> DataFrame:
    """(date, column_name, value_count, history_days, history_count, psi, ks, is_anomalous) from daily histograms.

    Each day is compared with all values of the ``lookback`` days before it. ``psi``, the population stability index, says how much has
    moved (half a value is added to each class, so that empty ones count); ``ks``, the largest distance of the two cumulated shares, says
    whether that can be chance for so many values. A day is anomalous if both speak for it and ``minimum`` days lie before.
    """
    classes = histograms.select("column_name", F.col("period").alias("date"), F.posexplode("counts").alias("class", "n"))
    earlier = Window.partitionBy("column_name", "class").orderBy(F.unix_date("date")).rangeBetween(-lookback, -1)
    moved = classes.withColumns({"before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "days": F.count("n").over(earlier)})
    day = Window.partitionBy("column_name", "date")
    upto = day.orderBy("class")
    moved = moved.withColumns({"total": F.sum("n").over(day), "total_before": F.sum("before").over(day), "size": F.count("n").over(day)})
    now = (F.col("n") + 0.5) / (F.col("total") + F.col("size") * 0.5)
    then = (F.col("before") + 0.5) / (F.col("total_before") + F.col("size") * 0.5)
    gap = F.abs(F.try_divide(F.sum("n").over(upto), F.col("total")) - F.try_divide(F.sum("before").over(upto), F.col("total_before")))
    distances = moved.withColumns({"term": (now - then) * F.ln(now / then), "gap": gap})
    compared = distances.groupBy("date", "column_name").agg(
        F.first("total").alias("value_count"),
        F.first("days").alias("history_days"),
        F.first("total_before").alias("history_count"),
        number(F.sum("term")).alias("psi"),
        number(F.max("gap")).alias("ks"),
    )
    chance = F.lit(significant) * F.sqrt(F.try_divide(F.col("value_count") + F.col("history_count"), F.col("value_count") * F.col("history_count")))
    enough = F.col("history_days") >= minimum
    return compared.select(
        "date",
        "column_name",
        "value_count",
        "history_days",
        "history_count",
        F.when(enough, F.col("psi")).alias("psi"),
        F.when(enough, F.col("ks")).alias("ks"),
        F.coalesce(enough & (F.col("psi") > shift) & (F.col("ks") > chance), F.lit(False)).alias("is_anomalous"),
    )


# --- checks against the rows -----------------------------------------------------------------------------------------


def _long(rows: DataFrame, columns: Iterable[str], period: str) -> DataFrame:
    """(period, column_name, value) of each row and column."""
    pairs = F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(name).cast("double").alias("value")) for name in columns])
    return _by(rows, period).select("period", F.inline(pairs))


def _typed(column: str, schema: StructType) -> Column:
    """A value in the field of its kind, null in the others: equal ones are those that are equal as texts, but cheaper to compare."""
    value, kind = F.col(column), schema[column].dataType
    field = "whole" if isinstance(kind, IntegralType) else "real" if isinstance(kind, DoubleType) else "text"
    fields = {"whole": value.cast("bigint"), "real": value, "text": _as_text(column, schema)}
    none = {"whole": "bigint", "real": "double", "text": "string"}
    return F.struct(*[(fields[name] if name == field else F.lit(None).cast(none[name])).alias(name) for name in none])


def distinct_counts(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(kind, period, column_name, distinct_count): the exact counts of all :data:`PERIODS`, in one pass over the rows.

    The rows are exchanged as the different values of a month, with the days that each occurs on as bits, equal values of a task once.
    """
    columns = list(columns)
    values = F.array(*[F.struct(F.lit(n).alias("place"), _typed(name, rows.schema).alias("value")) for n, name in enumerate(columns)])
    on = F.expr("shiftleft(1, day(date) - 1)")
    each = rows.select(F.expr(PERIODS["month"]).alias("month"), on.alias("day"), F.inline(values))
    different = each.select("month", "day", "place", "value.*").groupBy("month", "place", "whole", "real", "text")
    different = different.agg(F.bit_or("day").alias("days"))
    present = F.coalesce(F.col("whole").isNotNull() | F.col("real").isNotNull() | F.col("text").isNotNull(), F.lit(False))
    daily = F.array(*[F.count_if(present & (F.col("days").bitwiseAND(F.lit(1 << n)) != 0)) for n in range(31)])
    counted = different.groupBy("month", "place").agg(F.bit_or("days").alias("days"), F.count_if(present).alias("monthly"), daily.alias("daily"))
    name = F.element_at(F.array(*[F.lit(name) for name in columns]), F.col("place") + 1).alias("column_name")
    monthly = F.array(F.struct(F.lit("month").alias("kind"), F.col("month").alias("period"), F.col("monthly").alias("distinct_count")))
    # A day without a row of its own has no count; one whose values are all missing has 0.
    days = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda n: F.getbit("days", n) == 1)
    of_days = F.transform(
        days, lambda n: F.struct(F.lit("day").alias("kind"), F.date_add("month", n).alias("period"), F.get("daily", n).alias("distinct_count"))
    )
    return counted.select(name, F.inline(F.concat(monthly, of_days))).select("kind", "period", "column_name", "distinct_count")


def distinct_checks(base: DataFrame, rows: DataFrame, tolerance: float = 4 * DISTINCT_ERROR) -> DataFrame:
    """(kind, period, column_name, distinct_count, is_close) of all periods: the exact count of the rows, and whether the sketches of the
    base agree. The rows are counted as whole, in one pass for all periods.
    """
    counts = distinct_counts(rows, sketched(base, "distinct"))
    estimates = by_periods({kind: distinct_by(base, kind) for kind in PERIODS})
    close = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= F.lit(tolerance) * F.col("distinct_count")
    joined = counts.join(estimates, ["kind", "period", "column_name"])
    return joined.select("kind", "period", "column_name", "distinct_count", close.alias("is_close"))


def distinct_checks_by(base: DataFrame, rows: DataFrame, period: str = "day", tolerance: float = 4 * DISTINCT_ERROR) -> DataFrame:
    """(period, column_name, distinct_count, is_close) of one kind of period."""
    return distinct_checks(base, rows, tolerance).where(F.col("kind") == period).drop("kind")


def quantile_checks_by(base: DataFrame, rows: DataFrame, period: str = "day", tolerance: float = RANK_TOLERANCE) -> DataFrame:
    """(period, column_name, quantile, value_count, extreme, is_close): whether as many rows lie below each estimate as should.

    ``extreme`` is the value of the quantiles 0 and 1. The rows meet the few estimates of their period and column.
    """
    estimates = quantiles_by(base, period)
    values = _long(rows, sketched(base, "quantiles"), period).where("value is not null")
    distinct = values.groupBy("period", "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    paired = distinct.join(estimates.withColumnRenamed("value", "estimate"), ["period", "column_name"])
    ranked = paired.groupBy("period", "column_name", "quantile", "value_count", "estimate").agg(
        F.sum(F.when(F.col("value") < F.col("estimate"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("value") <= F.col("estimate"), F.col("n")).otherwise(0)).alias("upto"),
        F.sum("n").alias("counted"),
    )
    allowed = F.lit(tolerance) * F.col("counted") + 1
    wanted = F.col("quantile") * F.col("counted")
    close = (F.col("counted") == F.col("value_count")) & (F.col("below") <= wanted + allowed) & (F.col("upto") >= wanted - allowed)
    extreme = F.when(F.col("quantile").isin(0.0, 1.0), F.col("estimate"))
    return ranked.select("period", "column_name", "quantile", "value_count", extreme.alias("extreme"), close.alias("is_close"))


def by_periods(build: Mapping[str, DataFrame]) -> DataFrame:
    """Results of several periods as one frame, with the kind of period."""
    return reduce(DataFrame.unionByName, [frame.select(F.lit(kind).alias("kind"), "*") for kind, frame in build.items()])
