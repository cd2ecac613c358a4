"""Slowly changing dimensions: keep every version of a row with the days it was valid."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.sources import storage, versions


def first_snapshot(current: DataFrame, valid_from: date) -> DataFrame:
    """History with a single open version of every row: (*columns, valid_from, valid_to)."""
    return current.withColumns({"valid_from": F.lit(valid_from), "valid_to": F.lit(None).cast("date")})


def renewed_versions(open_versions: DataFrame, current: DataFrame, keys: Sequence[str], as_of: date) -> DataFrame:
    """The open versions brought up to date with ``current``, one row per key, and those that this closes.

    A changed row closes its open version on ``as_of`` and opens a new one; a row that is gone keeps its open
    version. Keys and attributes compare NULL-safe.
    """
    attributes = [name for name in current.columns if name not in keys]
    open_rows = open_versions.alias("old")
    same_key: Column = reduce(
        lambda left, right: left & right, [F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}")) for name in keys]
    )
    paired = open_rows.join(current.withColumn("_present", F.lit(True)).alias("new"), same_key, "full")

    def version(side: str, valid_from: Column, valid_to: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{name}").alias(name) for name in (*keys, *attributes)],
            valid_from.alias("valid_from"),
            valid_to.cast("date").alias("valid_to"),
        )

    moment, never = F.lit(as_of), F.lit(None)
    kept = version("old", F.col("old.valid_from"), never)
    closed = version("old", F.col("old.valid_from"), moment)
    opened = version("new", moment, never)
    unchanged = F.struct(*[F.col(f"old.{name}") for name in attributes]).eqNullSafe(
        F.struct(*[F.col(f"new.{name}") for name in attributes])
    )
    versions = (
        F.when(F.col("old.valid_from").isNull(), F.array(opened))
        .when(F.col("new._present").isNull() | unchanged, F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    return paired.select(F.inline(versions))


def apply_snapshot(history: DataFrame, current: DataFrame, keys: Sequence[str], as_of: date) -> DataFrame:
    """All versions after a run, from all versions before it. :class:`SnapshotTable` stores them without rewriting closed ones."""
    renewed = renewed_versions(history.where(F.col("valid_to").isNull()), current, keys, as_of)
    return history.where(F.col("valid_to").isNotNull()).unionByName(renewed)


class SnapshotTable:
    """Versions in two folders: the open ones, replaced by each run, and the closed ones, to which a run adds those it closes.

    A run costs as much as there are open versions, however long the history is. Repeating a run changes nothing: what it
    closes replaces its own partition, and only then the open versions are switched.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.keys = spark, list(keys)
        self.open_path, self.closed_path = f"{path}/open", f"{path}/closed"

    def apply(self, current: DataFrame, as_of: date) -> None:
        if not versions.exists(self.spark, self.open_path):
            storage.write_version(first_snapshot(current, as_of), self.open_path)
            return
        renewed = renewed_versions(storage.read_version(self.spark, self.open_path), current, self.keys, as_of)
        closed = renewed.where(F.col("valid_to").isNotNull()).withColumn("closed_on", F.col("valid_to"))
        storage.write_counted(closed, self.closed_path, ["closed_on"], replace="partitions")
        storage.write_version(renewed.where(F.col("valid_to").isNull()), self.open_path)

    def read(self) -> DataFrame:
        found = storage.read_version(self.spark, self.open_path)
        if not versions.exists(self.spark, self.closed_path):
            return found
        closed = self.spark.read.schema(found.schema).parquet(self.closed_path)
        return found.unionByName(closed.select(*found.columns))


def country_profile(government: DataFrame) -> DataFrame:
    """The latest policy levels and population of each country, one row per code and name."""
    columns = ("school_closing", "stay_at_home_requirements", "international_travel_controls", "population")
    return government.groupBy("country_code", "country_name").agg(
        *[F.max_by(name, "date").alias(name) for name in columns]
    )
