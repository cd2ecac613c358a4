"""The content of the monitoring report: one row per monitored area."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.operators.observability import newest


def area(results: DataFrame, name: str, good: Column) -> DataFrame:
    """(area, checked, failed, passed). An area in which nothing was checked has not passed."""
    failed = F.count_if(~F.coalesce(good, F.lit(False)))
    checked = F.count(F.lit(1))
    return results.agg(
        F.lit(name).alias("area"),
        checked.alias("checked"),
        failed.alias("failed"),
        ((failed == 0) & (checked > 0)).alias("passed"),
    )


def quality_report(
    tests: DataFrame,
    expectations: DataFrame,
    fresh: DataFrame,
    volume: DataFrame,
    metrics: DataFrame,
    contract: DataFrame,
    test_history: DataFrame | None = None,
    run_log: DataFrame | None = None,
    row_counts: DataFrame | None = None,
    run_times: DataFrame | None = None,
    drift: DataFrame | None = None,
    changes: DataFrame | None = None,
    distributions: DataFrame | None = None,
) -> DataFrame:
    """One row per area. Anomalies are judged by the newest day of each series; the rest of the series is history.

    The areas of run history are there where their frames are given: pass rates per test (the last run decides), the log of this
    run, rows per model (none is a failure), times per stage (a failure in the last run), and columns with their change since the run before. So are those of slow changes of the
    volume (one that goes on) and of distributions (the newest day).
    """
    areas = [
        area(tests, "column_tests", F.col("passed")),
        area(expectations, "expectations", F.col("success")),
        area(fresh, "freshness", F.col("is_fresh")),
        area(newest(volume, ["table_name"]), "volume_anomalies", ~F.col("is_anomalous")),
        area(newest(metrics, ["column_name", "metric"]), "metric_anomalies", ~F.col("is_anomalous")),
        area(contract, "schema_contract", F.col("status") == "ok"),
    ]
    if test_history is not None:
        areas.append(area(test_history, "test_history", F.col("last_passed")))
    if run_log is not None:
        areas.append(area(run_log, "run_log", F.col("status") != "failed"))
    if row_counts is not None:
        areas.append(area(row_counts, "model_row_counts", F.col("row_count") > 0))
    if run_times is not None:
        areas.append(area(run_times, "run_times", ~F.col("last_failed")))
    if drift is not None:
        areas.append(area(drift, "schema_changes", F.col("change").isNull()))
    if changes is not None:
        areas.append(area(newest(changes, ["table_name"]), "volume_changes", F.col("change").isNull()))
    if distributions is not None:
        areas.append(area(newest(distributions, ["column_name"]), "distributions", ~F.col("is_anomalous")))
    return reduce(DataFrame.unionByName, areas)
