"""Column metrics, volume, freshness and their anomaly scores.

Metrics are rounded to six decimals: sums of doubles depend on the order of addition, and with it on how the data
was split, so unrounded values would differ from run to run.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tallyward.functions.frames import day, rows_from_aggregate

DIGITS = 6
LOOKBACK = 14
MINIMUM_HISTORY = 7
THRESHOLD = 3.0
# A spread that is smaller than this share of the mean is noise of the arithmetic.
LEAST_SPREAD = 1e-9


def number(value: Column) -> Column:
    return F.round(value.cast("double"), DIGITS)


def metrics_for(df: DataFrame, column: str) -> dict[str, Column]:
    """The statistics that suit the type of ``column``, as aggregates."""
    value = F.col(column)
    kind = df.schema[column].dataType
    rows = F.count(F.lit(1))
    missing = rows - F.count(value)
    metrics = {"row_count": rows, "null_count": missing, "null_percent": F.try_divide(missing, rows) * 100}
    if isinstance(kind, NumericType):
        metrics |= {
            "min": F.min(value),
            "max": F.max(value),
            "average": F.avg(value),
            "standard_deviation": F.stddev_samp(value),
            "zero_count": F.count_if(value == 0),
        }
    elif isinstance(kind, StringType):
        metrics |= {
            "min_length": F.min(F.length(value)),
            "max_length": F.max(F.length(value)),
            "average_length": F.avg(F.length(value)),
            "empty_count": F.count_if(value == ""),
        }
    return metrics


def column_metrics(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    by: Sequence[str] = (),
    only: Iterable[str] | None = None,
    columns_per_pass: int = 8,
) -> DataFrame:
    """Long form (*by, column_name, metric, value): statistics per column, optionally per day or other keys.

    A pass handles ``columns_per_pass`` columns so that its aggregation buffer stays within what Spark compiles
    into one stage (100 fields). On columnar files more passes do not read more: each reads its own columns.
    """
    names = [name for name in (df.columns if columns is None else columns) if name not in by]
    wanted = None if only is None else set(only)
    result = None
    for start in range(0, len(names), columns_per_pass):
        rows = [
            {"column_name": F.lit(name), "metric": F.lit(metric), "value": number(value)}
            for name in names[start : start + columns_per_pass]
            for metric, value in metrics_for(df, name).items()
            if wanted is None or metric in wanted
        ]
        part = rows_from_aggregate(df, rows, by)
        result = part if result is None else result.unionByName(part)
    return result


def distinct_estimates(df: DataFrame, columns: Iterable[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """(column_name, distinct_estimate) by sketches that merge on the map side."""
    return rows_from_aggregate(
        df,
        [
            {"column_name": F.lit(name), "distinct_estimate": F.approx_count_distinct(name, rsd)}
            for name in (df.columns if columns is None else columns)
        ],
    )


def distinct_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(column_name, distinct_count), exact: the values of all columns in one long frame, combined on the map side."""
    names = list(df.columns if columns is None else columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in names])
    values = df.select(F.explode(pairs).alias("_pair")).select("_pair.*").distinct()
    return values.groupBy("column_name").agg(F.count("value").alias("distinct_count"))


def distinct_checks(df: DataFrame, rsd: float = 0.05) -> DataFrame:
    """(column_name, distinct_count, is_close): whether the estimate is within three of its standard errors of the exact count."""
    joined = distinct_estimates(df, rsd=rsd).join(distinct_counts(df), "column_name")
    close = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= 3 * rsd * F.col("distinct_count")
    return joined.select("column_name", "distinct_count", close.alias("is_close"))


def arrivals(df: DataFrame, key: str = "country_code", date_column: str = "date") -> DataFrame:
    """(date, key, row_count): the small frame that volume and freshness can both be read from."""
    return df.groupBy(F.col(date_column).alias("date"), key).agg(F.count(F.lit(1)).alias("row_count"))


def daily_volume(df: DataFrame, table_name: str, weight: str | None = None) -> DataFrame:
    """(table_name, date, row_count); ``weight`` names the count where the rows were counted already."""
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    per_day = df.groupBy("date").agg(rows.alias("row_count"))
    return per_day.select(F.lit(table_name).alias("table_name"), "date", "row_count")


def on_every_day(volume: DataFrame, until: date | None = None, key: str = "table_name") -> DataFrame:
    """The same counts with a 0 for each day without rows, from the first day of the key to ``until`` (or its last day, if later).

    An outage leaves no rows, so without this a series would close over it. Counts without a day stay out.
    """
    dated = volume.where(F.col("date").isNotNull())
    last = F.greatest(F.max("date"), day(until))
    days = dated.groupBy(key).agg(F.explode(F.sequence(F.min("date"), last)).alias("date"))
    filled = days.join(dated, [key, "date"], "left")
    return filled.select(key, "date", F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"))


def anomaly_scores(
    series: DataFrame,
    keys: Sequence[str],
    bucket: str,
    value: str,
    lookback: int = LOOKBACK,
    minimum: int = MINIMUM_HISTORY,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Add (history_count, history_mean, anomaly_score, is_anomalous) against the ``lookback`` days before the bucket.

    The score is the distance from their mean in standard deviations; NULL with fewer than ``minimum`` of them or
    no spread. ``series`` holds one row per key and day, so a window group has as many rows as the table has days,
    whatever the size of the table.
    """
    earlier = Window.partitionBy(*keys).orderBy(F.unix_date(bucket)).rangeBetween(-lookback, -1)
    value_ = F.col(value).cast("double")
    spread = F.stddev_samp(value_).over(earlier)
    count = F.count(value_).over(earlier)
    mean = F.avg(value_).over(earlier)
    scored = series.withColumns({"history_count": count, "_mean": mean, "_spread": spread}).withColumn(
        "anomaly_score",
        F.when(
            (F.col("history_count") >= minimum)
            & (F.col("_spread") > LEAST_SPREAD * F.greatest(F.lit(1.0), F.abs("_mean"))),
            F.round((value_ - F.col("_mean")) / F.col("_spread"), DIGITS),
        ),
    )
    return scored.withColumns(
        {
            "history_mean": F.round("_mean", DIGITS),
            "is_anomalous": F.coalesce(F.abs("anomaly_score") > threshold, F.lit(False)),
        }
    ).drop("_mean", "_spread")


def metric_anomalies(metrics: DataFrame, bucket: str = "date") -> DataFrame:
    """Scores of each column metric over time."""
    return anomaly_scores(metrics, ("column_name", "metric"), bucket, "value")


def volume_anomalies(volume: DataFrame, trend_days: int = 7) -> DataFrame:
    """Scores of the daily row count, with its change, trailing mean and whether it fell ``trend_days`` times in a row.

    One window group per ``table_name``, with a row per day; see :func:`on_every_day` for days without rows.
    """
    ordered = Window.partitionBy("table_name").orderBy("date")
    recent = ordered.rowsBetween(1 - trend_days, 0)
    trend = volume.withColumn("change", F.col("row_count") - F.lag("row_count").over(ordered)).withColumns(
        {
            "trailing_mean": F.round(F.avg("row_count").over(recent), DIGITS),
            "is_declining": F.count_if(F.col("change") < 0).over(recent) == trend_days,
        }
    )
    return anomaly_scores(trend, ("table_name",), "date", "row_count")


def newest(scores: DataFrame, keys: Sequence[str], bucket: str = "date") -> DataFrame:
    """The last bucket of each key: the one that a check judges."""
    latest = scores.groupBy(*keys).agg(F.max_by(F.struct(*scores.columns), bucket).alias("_last"))
    return latest.select("_last.*")


def anomaly_tests(scores: DataFrame, keys: Sequence[str], bucket: str = "date") -> DataFrame:
    """Anomaly checks as tests: (*keys, scored, anomalies, last_bucket, passed).

    The newest bucket decides, so that a bad day fails the checks of its day only; the others are counted.
    """
    return scores.groupBy(*keys).agg(
        F.count("anomaly_score").alias("scored"),
        F.count_if("is_anomalous").alias("anomalies"),
        F.max(bucket).alias("last_bucket"),
        (~F.max_by("is_anomalous", bucket)).alias("passed"),
    )


def freshness(
    df: DataFrame, table_name: str, as_of: date | None = None, max_days: int = 1, key: str = "country_code"
) -> DataFrame:
    """Days since the last report, for the table (``level`` = table) and for each key (``level`` = key).

    The table row is rolled up from the per-key rows, so the data is read once. A table without rows has its row too, and is not fresh.
    """
    per_key = df.groupBy(key).agg(F.max("date").alias("last_date")).withColumn("_stands_in", F.lit(False))
    spark = df.sparkSession
    nothing = spark.range(1).select(
        F.lit(None).cast(df.schema[key].dataType).alias(key), F.lit(None).cast("date").alias("last_date"), F.lit(True).alias("_stands_in")
    )
    behind = F.datediff(day(as_of), F.col("last_date")).cast("bigint")
    return (
        per_key.unionByName(nothing)
        .rollup(key)
        .agg(
            F.max("last_date").alias("last_date"), F.grouping(key).alias("_total"), F.every("_stands_in").alias("_stands_in")
        )
        .where((F.col("_total") == 1) | ~F.col("_stands_in"))
        .select(
            F.lit(table_name).alias("table_name"),
            F.when(F.col("_total") == 1, "table").otherwise("key").alias("level"),
            key,
            "last_date",
            behind.alias("days_behind"),
            F.coalesce(behind <= max_days, F.lit(False)).alias("is_fresh"),
        )
    )


def has_rows_for_yesterday(df: DataFrame, as_of: date | None = None, date_column: str = "date") -> DataFrame:
    """One row (passed): whether the day before ``as_of`` has arrived. Reads the date column of that day only."""
    found = df.where(F.col(date_column) == F.date_sub(day(as_of), 1))
    return found.agg((F.count(F.lit(1)) > 0).alias("passed"))
