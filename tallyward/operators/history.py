"""Run history: results of many runs in append-only Parquet tables, one partition per run."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RUN_LOG_SCHEMA = (
    "run_id string, position int, stage string, status string, row_count bigint,"
    " started_at timestamp, ended_at timestamp, detail string"
)
MODEL_LOG_SCHEMA = "run_id string, model string, status string, row_count bigint, started_at timestamp, ended_at timestamp"


def append_run(
    results: DataFrame, path: str, run_id: str, parts: Sequence[str] = (), run_started: datetime | None = None
) -> None:
    """Store the results of a run. Storing the same run again replaces it, so a repeated run is not counted twice.

    ``parts`` names columns by which a run may be stored piece by piece. ``run_started`` puts runs in order; by default it is now.
    """
    started = F.current_timestamp() if run_started is None else F.lit(run_started)
    (
        results.withColumns({"run_id": F.lit(run_id), "run_started": started.cast("timestamp")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", *parts)
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All stored runs. Run ids stay text even where they look like numbers or dates."""
    found = spark.read.parquet(path).schema
    as_text = StructType([StructField("run_id", StringType()) if f.name == "run_id" else f for f in found.fields])
    return spark.read.schema(as_text).parquet(path)


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """What one run stored; only its folder is listed, however many runs there are."""
    found = spark.read.option("basePath", path).parquet(f"{path}/run_id={run_id}")
    return found.drop("run_id", "run_started")


def pass_rates(history: DataFrame, keys: Sequence[str], passed: str) -> DataFrame:
    """(*keys, runs, passes, pass_rate, last_run, last_passed) over the stored runs; the last is the one that started last."""
    good = F.col(passed)
    order = F.struct("run_started", "run_id")
    return history.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(good).alias("passes"),
        F.round(F.count_if(good) / F.count(F.lit(1)), 6).alias("pass_rate"),
        F.max_by("run_id", order).alias("last_run"),
        F.max_by(good, order).alias("last_passed"),
    )


def run_log_frame(spark: SparkSession, entries: Iterable[tuple]) -> DataFrame:
    """The log of one run: a row per stage."""
    return spark.createDataFrame(list(entries), RUN_LOG_SCHEMA)


def log_entry(
    run_id: str,
    position: int,
    stage: str,
    status: str,
    row_count: int | None,
    started_at: datetime | None,
    ended_at: datetime | None,
    detail: str | None = None,
) -> tuple:
    return (run_id, position, stage, status, row_count, started_at, ended_at, detail)


def run_before(history: DataFrame, run_id: str) -> str | None:
    """The run that started last before ``run_id`` did, of those stored."""
    runs = history.groupBy("run_id").agg(F.min("run_started").alias("started"))
    own = runs.where(F.col("run_id") == run_id).select(F.col("started").alias("own"))
    earlier = runs.where(F.col("run_id") != run_id).join(own, F.col("started") < F.col("own"))
    return earlier.agg(F.max_by("run_id", F.struct("started", "run_id"))).first()[0]


def stage_times(log: DataFrame, by: str = "stage") -> DataFrame:
    """(stage, runs, failures, mean_seconds, max_seconds, median_seconds, last_failed) over the logged runs.

    ``by="model"`` gives the same per model, from a log of models.
    """
    seconds = F.unix_micros("ended_at") - F.unix_micros("started_at")
    timed = log.withColumn("_seconds", seconds / 1e6)
    failed = F.col("status") == "failed"
    return timed.groupBy(by).agg(
        F.count("_seconds").alias("runs"),
        F.count_if(failed).alias("failures"),
        F.round(F.avg("_seconds"), 6).alias("mean_seconds"),
        F.max("_seconds").alias("max_seconds"),
        F.percentile_approx("_seconds", 0.5, 1_000_000).alias("median_seconds"),
        F.coalesce(F.max_by(failed, F.struct("started_at", "run_id")), F.lit(False)).alias("last_failed"),
    )
