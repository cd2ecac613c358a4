"""Continuous ingestion: new raw files are taken in as they arrive and the days they touch are refreshed.

Daily figures are corrected long after the day, so nothing here has a lateness limit but :func:`closed_days`. There are two kinds of
sources. One that only appends is stored as partial aggregates per batch, day and country, which a refresh adds up
(:func:`refresh_appended`). One that sends a row again to correct it is stored as it arrived, and the newest arrival of each row
counts (:func:`refresh_corrected`); a batch is exchanged once, when it is stored. Both keep rows of days that are still to come; readers of the base say up to which day they read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, FloatType, LongType, StructType

from tallyward.operators.marts import AVERAGES, GRAIN, MAXIMA, SUMS, daily_country_base, measures
from tallyward.operators.staging import stage
from tallyward.session import settings
from tallyward.sources import versions
from tallyward.sources.days import replace_days
from tallyward.sources.storage import write_counted

FOREVER = date(9999, 12, 31)
MONTH = "year(date) * 100 + month(date)"
# A bucket of stored arrivals gets about so many rows of the first batch, few enough to be sorted in memory; there are so many at least.
ROWS_PER_BUCKET = 500_000
LEAST_BUCKETS = 8
BUCKETS = "buckets="


def raw_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Rows of the raw files under ``path``, as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def staged_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    as_of: date | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Staged rows of the raw files under ``path``, as they arrive; the same cleaning as in batch."""
    return stage(raw_stream(spark, path, schema, files_per_batch), as_of)


# --- append-only sources: partial aggregates ---------------------------------------------------------------------


def partial_base(staged: DataFrame) -> DataFrame:
    """The measures per country and day in a form that adds up: an average as its sum and count."""
    columns = [F.sum(source).alias(name) for name, source in SUMS.items()]
    columns += [F.max(source).alias(name) for name, source in MAXIMA.items()]
    for name, source in AVERAGES.items():
        columns += [F.sum(F.col(source).cast("double")).alias(f"{name}_sum"), F.count(source).alias(f"{name}_count")]
    return staged.groupBy(*GRAIN).agg(*columns)


def _sums_of_partials() -> list[Column]:
    columns = [F.sum(name).alias(name) for name in SUMS] + [F.max(name).alias(name) for name in MAXIMA]
    for name in AVERAGES:
        columns += [F.sum(f"{name}_sum").alias(f"{name}_sum"), F.sum(f"{name}_count").alias(f"{name}_count")]
    return columns


def merged_base(partials: DataFrame) -> DataFrame:
    """The base from any number of partial ones."""
    averages = [F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count")).alias(name) for name in AVERAGES]
    others = [F.sum(name).alias(name) for name in SUMS] + [F.max(name).alias(name) for name in MAXIMA]
    return partials.groupBy(*GRAIN).agg(*others, *averages)


def of_touched_days(stored: DataFrame, batch_id: int, by: Sequence[str] = ("date",)) -> DataFrame:
    """What is stored of the days that batch ``batch_id`` brought rows for.

    ``by`` holds the column that partitions the files, so Spark prunes the scan by the touched days. These are a bounded number of
    calendar days, whatever the size of the batch that they are read from, so they are always broadcast: no stored row is exchanged.
    """
    touched = stored.where(F.col("batch_id") == batch_id).select(*by).distinct()
    return stored.join(F.broadcast(touched), list(by), "left_semi")


def _run(stream: DataFrame, refresh, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def refresh_appended(arriving: DataFrame, partials_path: str, base_path: str, checkpoint: str) -> StreamingQuery:
    """Add what has arrived to the base, then stop. Start again with the same ``checkpoint`` to carry on.

    For sources that never send a row twice. A batch writes a partial row per country-day it touches, in its own (month, batch_id)
    partitions (a day's partial rows alone would be a very small file), so running it again after a failure replaces them instead of
    adding them; the days it touched are added up from their partial rows and replaced in the base in one step.
    :func:`compact` keeps the partial rows few.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        partial = partial_base(stage(batch, FOREVER)).withColumns({"month": F.expr(MONTH), "batch_id": F.lit(batch_id).cast("bigint")})
        write_counted(partial, partials_path, partition_by=["month", "batch_id"], replace="partitions")
        stored = spark.read.schema(partial.schema).parquet(partials_path)
        touched = of_touched_days(stored, batch_id, ["month", "date"])
        replace_days(merged_base(touched), base_path)

    return _run(arriving, refresh, checkpoint)


def compact(spark: SparkSession, partials_path: str) -> None:
    """Add up the partial rows of each month to one file, as those of batch -1. Run it while the stream is stopped.

    The sums are written beside, then each month's folder is exchanged; an exchange that was cut off is finished by the next call.
    """
    stored = spark.read.parquet(partials_path)
    beside = f"{partials_path}_compact"
    if not versions.exists(spark, f"{beside}/_SUCCESS"):
        first = stored.groupBy(*GRAIN).agg(*_sums_of_partials())
        first = first.withColumns({"month": F.expr(MONTH), "batch_id": F.lit(-1).cast("bigint")})
        write_counted(first, beside, partition_by=["month", "batch_id"])
    system, place = versions.folder(spark, beside)
    for entry in system.listStatus(place):
        name = entry.getPath().getName()
        if name.startswith("month="):
            versions.delete(spark, f"{partials_path}/{name}")
            system.rename(entry.getPath(), versions.folder(spark, f"{partials_path}/{name}")[1])
    versions.delete(spark, beside)


# --- sources that correct: newest arrival of each row --------------------------------------------------------------


def newest_arrivals(stored: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """Of the rows with the same key the one that came with the latest batch; within a batch, the largest."""
    columns = [name for name in stored.columns if name not in (*row_key, "batch_id")]
    latest = stored.groupBy(*row_key).agg(F.max(F.struct("batch_id", *columns)).alias("_newest"))
    return latest.select(*row_key, "_newest.*")


def _bucket_columns(schema: StructType, row_key: Sequence[str]) -> list[str]:
    """Columns of the key that buckets go by. Grouping takes both zeros of a double for one, which the hash of a bucket does not."""
    return [name for name in row_key if not isinstance(schema[name].dataType, DoubleType | FloatType)]


def _stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets that arrivals are stored in below ``path``; None before the first batch."""
    if not versions.exists(spark, path):
        return None
    system, place = versions.folder(spark, path)
    names = [entry.getPath().getName() for entry in system.listStatus(place)]
    return next((int(name.removeprefix(BUCKETS)) for name in sorted(names) if name.startswith(BUCKETS)), None)


@contextmanager
def _arrivals(spark: SparkSession, path: str, schema: StructType, by: Sequence[str], buckets: int) -> Iterator[str]:
    """The name, while it is in use, of a table over the arrivals stored below ``path``, whatever session has stored them.

    A table, because Spark knows of its buckets: rows with the same key lie in the same one, so they meet without an exchange.
    """
    name = f"arrivals_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    keys = ", ".join(f"`{column}`" for column in by)
    system, place = versions.folder(spark, f"{path}/{BUCKETS}{buckets}")
    system.mkdirs(place)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, month INT, batch_id BIGINT) USING parquet OPTIONS (compression 'zstd')"
        f" PARTITIONED BY (month, batch_id) CLUSTERED BY ({keys}) SORTED BY (date) INTO {buckets} BUCKETS LOCATION '{place.toString()}'"
    )
    try:
        spark.catalog.recoverPartitions(name)
        yield name
    finally:
        # The files are not the table's own, so they stay.
        spark.sql(f"DROP TABLE {name}")


def refresh_corrected(
    arriving: DataFrame, arrivals_path: str, base_path: str, checkpoint: str, row_key: Sequence[str]
) -> StreamingQuery:
    """Bring the base up to date with rows that may replace earlier ones; then stop, as :func:`refresh_appended`.

    Rows are stored raw, so that a row that makes an earlier one invalid counts as well; ``row_key`` (which must hold ``date``)
    names a row. The days that a batch touches are aggregated again from the newest arrival of each of their rows, and a
    day without a valid row goes.

    Arrivals lie in folders by month and batch, and in these in buckets by their key. A batch is exchanged once, to the buckets;
    the newest arrivals of any number of batches are then found bucket by bucket, and only aggregates are exchanged again. The first
    batch's size says how many buckets there are.
    """
    if "date" not in row_key:
        raise ValueError("the key of a row must hold its date")
    schema, by = arriving.schema, _bucket_columns(arriving.schema, row_key)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        buckets = _stored_buckets(spark, arrivals_path) or max(LEAST_BUCKETS, -(-batch.count() // ROWS_PER_BUCKET))
        numbered = {"month": F.expr(MONTH), "batch_id": F.lit(batch_id).cast("bigint")}
        dated = batch.where(F.col("date").isNotNull()).withColumns(numbered)
        with _arrivals(spark, arrivals_path, schema, by, buckets) as name:
            # A batch that is run again after a failure replaces its own folders.
            with settings(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
                dated.repartition(buckets, *by).write.insertInto(name, overwrite=True)
            stored = spark.table(name)
            arrived = stored.where(F.col("batch_id") == batch_id).select(F.col("date").cast("string").alias("day")).distinct()
            touched = {row["day"] for row in arrived.collect()}
            rows = newest_arrivals(of_touched_days(stored, batch_id, ["month", "date"]).drop("month"), row_key)
            # All touched days are replaced, so those whose rows are all invalid now go in the same step.
            replace_days(daily_country_base(stage(rows, FOREVER)), base_path, touched.__contains__)

    return _run(arriving, refresh, checkpoint)


def closed_days(staged: DataFrame, lateness_days: int) -> DataFrame:
    """The base of each country-day, all measures, once it is no later than ``lateness_days`` behind the newest day.

    State is bounded by countries times lateness, so few state partitions will do (``spark.sql.shuffle.partitions`` when
    the stream is first started). Rows later than that are not counted; use the functions above where every correction must count.
    """
    reported = staged.withColumn("reported_at", F.col("date").cast("timestamp"))
    return (
        reported.withWatermark("reported_at", f"{lateness_days} days")
        .groupBy("reported_at", *[name for name in GRAIN if name != "date"])
        .agg(*measures())
        .withColumn("date", F.to_date("reported_at"))
        .drop("reported_at")
    )
