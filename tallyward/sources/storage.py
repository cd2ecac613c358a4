"""Sources, the raw zone, warehouse tables and the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyward.sources import versions


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without it; there every task runs on this machine and a temporary folder serves.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.gettempdir()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")


_SESSION_FOLDERS: dict[tuple[str, str], str] = {}


def session_folder(spark: SparkSession) -> str:
    """A folder for what is stored on the way, below the shared one; it is deleted when the application ends."""
    key = (spark.sparkContext.applicationId, shared_folder(spark))
    if key not in _SESSION_FOLDERS:
        path = f"{key[1]}/tallyward/{key[0]}-{uuid.uuid4().hex[:8]}"
        system, place = versions.folder(spark, path)
        system.mkdirs(place)
        system.deleteOnExit(place)
        _SESSION_FOLDERS[key] = path
    return _SESSION_FOLDERS[key]


def new_path(spark: SparkSession, purpose: str) -> str:
    """A path nobody has written to yet, for an intermediate result."""
    return f"{session_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def read_source(
    spark: SparkSession, source: str, source_format: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    """All columns of the source, lazily. ``table`` reads a catalog table, any other format a path.

    Connector formats that take their table as an option are given an empty ``source``.
    """
    if source_format == "table":
        return spark.table(source)
    reader = spark.read.format(source_format).options(**(options or {}))
    return reader.load(source) if source else reader.load()


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together before a partitioned write, without one task per partition.

    A rebalance, unlike ``repartition``, lets adaptive execution cut a large partition into several tasks, so a day
    holding a third of the rows is still written in parallel, and merge the small ones.
    """
    return df.hint("rebalance", *[F.col(name) for name in columns])


def write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = (), replace: str = "all") -> int:
    """Write Parquet and return the number of rows written, in a single pass over ``df``.

    ``replace="partitions"`` overwrites only the partitions that occur in ``df``. The count is taken in the writing
    stage itself, where Spark counts each task once however often it is retried.
    """
    if partition_by:
        df = clustered(df, partition_by)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("row_count")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    writer.parquet(path)
    return seen.get["row_count"]


def read_raw_zone(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of the raw zone, or the files as they lie there."""
    return read_version(spark, path)


def save_table(df: DataFrame, name: str, path: str | None = None, source_format: str = "parquet") -> int:
    """Replace a warehouse table by ``df``; returns the row count of the same pass."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("row_count")).write.format(source_format).mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return seen.get["row_count"]


def write_sink(df: DataFrame, sink_format: str, options: Mapping[str, str] | None = None) -> int:
    """Replace the target of a connector by ``df``; its options name the target. Returns the row count."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("row_count"))
    counted.write.format(sink_format).options(**(options or {})).mode("overwrite").save()
    return seen.get["row_count"]


def register_table(spark: SparkSession, name: str, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Make Parquet files readable as a table without copying them.

    A copy of the raw zone would write the whole data a second time. An entry over files with the same columns is pointed to
    the new files in one step; one with other columns or partitions is made anew. Dropping an entry never deletes files, and a
    managed table, which would lose its own, is refused.
    """
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType == "MANAGED":
            raise ValueError(f"{name} is a managed table; registering files in its place would delete its data")
        if not partition_by and spark.table(name).schema == spark.read.parquet(path).schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return spark.table(name)
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write the next version of the folder; readers switch to it when it is complete. Returns the row count."""
    spark, attempt = df.sparkSession, versions.attempt(path)
    try:
        rows = write_counted(df, attempt, partition_by)
        versions.publish(spark, attempt, path)
    except BaseException:
        versions.delete(spark, attempt)
        raise
    versions.prune(spark, path)
    return rows


def read_version(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(versions.current(spark, path))


def materialize(df: DataFrame, name: str, how: str = "view", path: str = "") -> DataFrame:
    """Publish a model as a temporary view, recomputed on every read, or as a table.

    With a ``path`` the table's files are versions below it, outside the warehouse: another session without a lasting catalog can
    read and replace them. Without one the catalog manages them.
    """
    spark = df.sparkSession
    if how == "view":
        view = name.rsplit(".", 1)[-1]
        df.createOrReplaceTempView(view)
        return spark.table(view)
    if how == "table":
        if path:
            write_version(df, path)
            return register_table(spark, name, versions.current(spark, path))
        save_table(df, name)
        return spark.table(name)
    raise ValueError(f"unknown materialization {how!r}")
