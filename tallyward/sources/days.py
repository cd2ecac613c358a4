"""A table by day, some of whose days are replaced in one step: readers see all of a refresh or nothing of it.

Each refresh writes the days it concerns to a folder of its own. Which folder holds which day is a small list, itself a versioned
table: publishing the next list is the step. The files of a day hold its date, and lie in a folder per day, so that readers of some
days list only these.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyward.sources import storage, versions

LIST = "day string, folder string"


def _list(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    """The folder of each day in a version of the list: a row for each calendar day."""
    if not number:
        return {}
    return dict(spark.read.schema(LIST).parquet(f"{path}/days/{versions.PREFIX}{number}").collect())


def stored_days(spark: SparkSession, path: str) -> list[str]:
    """The days that there are, in order."""
    return sorted(_list(spark, path, versions.newest(spark, f"{path}/days")))


def replace_days(df: DataFrame, path: str, replaced: Callable[[str], bool] = lambda day: False) -> int:
    """Put the rows of ``df`` in the place of the stored days for which ``replaced`` holds, and of those that occur in it.

    Returns the number of rows. Which days occur is noted in the pass that writes them. Of two writers at once the second adds
    its days to the list of the first. Repeating a refresh is harmless; a reader of the table as it was before can finish.
    """
    spark, folder = df.sparkSession, uuid.uuid4().hex
    seen = Observation()
    daily = storage.clustered(df.withColumn("day", F.col("date").cast("string")), ["day"])
    counted = daily.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set("day").alias("days"))
    counted.write.partitionBy("day").parquet(f"{path}/data/{folder}")
    found = seen.get
    published = None
    while published is None:
        number = versions.newest(spark, f"{path}/days")
        days = {day: at for day, at in _list(spark, path, number).items() if not replaced(day)}
        days |= dict.fromkeys(found["days"], folder)
        attempt = versions.attempt(f"{path}/days")
        spark.createDataFrame(sorted(days.items()), LIST).coalesce(1).write.parquet(attempt)
        published = versions.publish(spark, attempt, f"{path}/days", after=number)
        if published is None:
            versions.delete(spark, attempt)
    _prune(spark, path)
    return found["rows"]


def _prune(spark: SparkSession, path: str) -> None:
    """Delete the lists before the last two, and the folders that only these named."""
    numbers = versions.complete_numbers(spark, f"{path}/days")
    named = {folder for number in numbers[-2:] for folder in _list(spark, path, number).values()}
    retired = {folder for number in numbers[:-2] for folder in _list(spark, path, number).values()}
    versions.prune(spark, f"{path}/days")
    for folder in retired - named:
        versions.delete(spark, f"{path}/data/{folder}")


def read_days(spark: SparkSession, path: str, last: date | None = None) -> DataFrame:
    """The rows of the stored days, up to ``last`` if given."""
    days = sorted(_list(spark, path, versions.newest(spark, f"{path}/days")).items())
    if not days:
        raise ValueError(f"no days are stored in {path}")
    folders = [f"{path}/data/{folder}/day={day}" for day, folder in days if last is None or day <= last.isoformat()]
    if not folders:
        day, folder = days[0]
        return spark.read.parquet(f"{path}/data/{folder}/day={day}").where("false")
    return spark.read.parquet(*folders)
