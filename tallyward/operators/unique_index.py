"""Uniqueness over increments: a new batch is checked against all keys there have been without shuffling these again.

Beside the table lies an index of its keys: a hash of each, bucketed by it. The keys of a batch are counted (equal ones of a task
combined first), exchanged once into as many parts as there are buckets, and meet the index bucket by bucket where it lies. The same pass
writes the batch's keys to the index and counts what it finds. A batch that is run again replaces itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tallyward.operators.column_checks import verdict
from tallyward.session import settings
from tallyward.sources import versions

BUCKETS = 64
SUMMARY = "batch bigint, row_count bigint, key_count bigint, repeated bigint, seen_before bigint, passed boolean"


class KeyIndex:
    """The keys of a table, by batch: (key_hash, the key's columns, row_count, seen_before, batch).

    ``name`` is the catalog entry over the files in ``path``, which other sessions make anew. ``buckets`` stays as it is first chosen; the
    keys of a bucket, and of a batch that falls in it, should fit in a task.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, keys: Sequence[str], buckets: int = BUCKETS):
        if clashing := {"key_hash", "row_count", "seen_before", "batch"} & set(keys):
            raise ValueError(f"the index has columns of these names: {sorted(clashing)}")
        self.spark, self.name, self.path, self.keys, self.buckets = spark, name, path, list(keys), buckets

    def _create(self, name: str, key_types: str, place: str) -> None:
        self.spark.sql(
            f"CREATE TABLE {name} (key_hash binary, {key_types}, row_count bigint, seen_before boolean, batch bigint) USING parquet"
            f" PARTITIONED BY (batch) CLUSTERED BY (key_hash) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    def _register(self, key_types: str) -> None:
        """Make the entry point to the newest version of the files, if it does not."""
        place = versions.current(self.spark, self.path)
        if place == self.path:
            # Its partitions are replaced one by one, so the first version is complete from the start.
            first = versions.attempt(self.path)
            versions.complete(self.spark, first)
            versions.publish(self.spark, first, self.path)
            place = versions.current(self.spark, self.path)
        if self.spark.catalog.tableExists(self.name):
            there = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Location'").first()
            if there["data_type"].rstrip("/").endswith(place.lstrip("/")):
                return
            self.spark.sql(f"DROP TABLE {self.name}")
        self._create(self.name, key_types, place)
        self.spark.catalog.recoverPartitions(self.name)

    def _key_types(self, rows: DataFrame) -> str:
        return ", ".join(f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in self.keys)

    def _forget(self, batch: int) -> None:
        """Remove what an earlier, perhaps broken, run of the batch has left."""
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (batch = {int(batch)})")
        versions.delete(self.spark, f"{versions.current(self.spark, self.path)}/batch={int(batch)}")

    def checked(self, rows: DataFrame, batch: int) -> DataFrame:
        """The keys of a batch: (key_hash, *keys, row_count, seen_before). Missing parts of a key are equal to each other."""
        self._register(self._key_types(rows))
        # Absent fields are the missing ones, so different keys have different texts.
        hashed = F.unhex(F.md5(F.to_json(F.struct(*self.keys))))
        counted = rows.select(hashed.alias("key_hash"), *self.keys).groupBy("key_hash").agg(
            *[F.first(name).alias(name) for name in self.keys], F.count(F.lit(1)).alias("row_count")
        )
        known = self.spark.table(self.name).where((F.col("batch") != batch) & ~F.col("seen_before"))
        # A hint, as the statistics of a young index would have it broadcast and exchange the batch for nothing later.
        known = known.select("key_hash", F.lit(True).alias("known")).hint("shuffle_merge")
        joined = counted.join(known, "key_hash", "left")
        return joined.select(
            "key_hash", *self.keys, "row_count", F.coalesce("known", F.lit(False)).alias("seen_before")
        )

    def settings(self):
        """Settings under which the batch is exchanged into the buckets of the index."""
        parts = str(self.buckets)
        return settings(
            self.spark,
            spark__sql__shuffle__partitions=parts,
            spark__sql__adaptive__coalescePartitions__initialPartitionNum=parts,
            spark__sql__sources__bucketing__autoBucketedScan__enabled="true",
        )

    def add(self, rows: DataFrame, batch: int) -> Row:
        """Check a batch and add its keys: (batch, row_count, key_count, repeated, seen_before, passed).

        ``repeated`` counts the keys that come more than once in the batch, ``seen_before`` those that an earlier batch had.
        """
        with self.settings():
            seen = Observation()
            found = self.checked(rows, batch).observe(
                seen,
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
                F.count(F.lit(1)).alias("key_count"),
                F.count_if(F.col("row_count") > 1).alias("repeated"),
                F.count_if("seen_before").alias("seen_before"),
                F.count_if((F.col("row_count") > 1) | F.col("seen_before")).alias("failures"),
            )
            self._forget(batch)
            found.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("append").insertInto(self.name)
        counts = seen.get
        result = {name: counts[name] for name in ("row_count", "key_count", "repeated", "seen_before")}
        return Row(batch=batch, **result, passed=counts["failures"] == 0)

    def failures(self, batch: int) -> DataFrame:
        """The keys that made a batch fail: (*keys, row_count, seen_before)."""
        stored = self.spark.table(self.name).where(F.col("batch") == batch)
        return stored.where((F.col("row_count") > 1) | F.col("seen_before")).select(*self.keys, "row_count", "seen_before")

    def test(self, model: str, batch: int) -> DataFrame:
        """The verdict on a batch in the form of the column tests."""
        broken = self.failures(batch).agg(F.count(F.lit(1)).alias("n"))
        row = verdict(F.lit(model), "unique_over_increments", F.lit(", ".join(self.keys)), F.col("n"))
        return broken.select(*[value.alias(name) for name, value in row.items()])

    def compact(self) -> None:
        """Bring the keys of all batches into one file per bucket, as those of the latest batch; which batch a key came with is forgotten.

        The files are written beside the old ones and the entry is pointed to them; a reader that has begun can finish.
        """
        table = self.spark.table(self.name)
        latest = table.agg(F.max("batch")).first()[0]
        if latest is None:
            return
        place, types, beside = versions.attempt(self.path), self._key_types(table), f"{self.name}_compact"
        self.spark.sql(f"DROP TABLE IF EXISTS {beside}")
        self._create(beside, types, place)
        # Each task reads a bucket of all batches, which nothing in the plan asks for.
        with settings(self.spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
            kept = table.where(~F.col("seen_before")).withColumn("batch", F.lit(latest))
            kept.write.mode("overwrite").insertInto(beside)
        self.spark.sql(f"DROP TABLE {beside}")
        versions.complete(self.spark, place)
        versions.publish(self.spark, place, self.path)
        self._register(types)
        versions.prune(self.spark, self.path)
