"""The base of the marts with everything else that a run wants to know about the staged rows, in one aggregate.

Per country and day it holds the measures of the marts, the number of rows, the gaps of the tested columns, and for each staged
measure the sums from which its statistics follow for any coarser grouping. Written once, it serves marts, column tests, expectations,
arrivals, row counts and metrics, so that a run reads the raw rows only once for all of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.frames import rows_from_aggregate
from tallyward.operators.column_checks import NOT_NULL, not_null_rows, verdict
from tallyward.operators.marts import GRAIN, MARTS, measures
from tallyward.operators.observability import number
from tallyward.operators.sketches import sketch_columns
from tallyward.operators.staging import IDENTIFIERS, STAGED_COLUMNS
from tallyward.session import settings

MEASURES = tuple(name for name in STAGED_COLUMNS if name not in IDENTIFIERS)
TESTED = NOT_NULL["stg_covid19"]

# Name of a statistic in the base: what it is of a staged measure.
PARTIALS = ("count", "sum", "squares", "zeros", "least", "largest")


def _partials(name: str) -> dict[str, Column]:
    value = F.col(name)
    double = value.cast("double")
    return {
        "count": F.count(value),
        "sum": F.sum(value),
        "squares": F.sum(double * double),
        "zeros": F.count_if(value == 0),
        "least": F.min(value),
        "largest": F.max(value),
    }


def profiled_base(staged: DataFrame, sketches: Iterable[str] = ()) -> DataFrame:
    """The base with ``row_count``, ``gaps_<column>`` and ``<statistic>_<measure>``. Catalyst drops what is not asked for.

    ``sketches`` names staged columns whose distinct counts, quantiles, histograms or lengths it holds as well
    (:mod:`tallyward.operators.sketches`), from the same pass.
    """
    columns = [F.count(F.lit(1)).alias("row_count")]
    columns += [F.count_if(F.col(name).isNull()).alias(f"gaps_{name}") for name in TESTED]
    columns += [value.alias(f"{kind}_{name}") for name in MEASURES for kind, value in _partials(name).items()]
    # A measure of the base may be named as the staged column it is of; the sketches are of the staged one.
    with settings(staged.sparkSession, spark__sql__lateralColumnAlias__enableImplicitResolution="false"):
        return staged.groupBy(*GRAIN).agg(*measures(), *columns, *sketch_columns(staged.schema, sketches))


def _merged(name: str) -> dict[str, Column]:
    merge = {"least": F.min, "largest": F.max}
    return {kind: merge.get(kind, F.sum)(F.col(f"{kind}_{name}")) for kind in PARTIALS}


def metrics_from(profiled: DataFrame, name: str) -> dict[str, Column]:
    """The statistics of a staged measure as aggregates of its partial ones; all but the deviation are exact.

    The deviation comes from the sum of squares, which any grouping can add up; its last digits are lost where the values lie far
    from 0 compared with their spread.
    """
    rows = F.sum("row_count")
    part = _merged(name)
    n, total, squares = part["count"].cast("double"), part["sum"].cast("double"), part["squares"]
    variance = (n * squares - total * total) / F.when(n > 1, n * (n - 1))
    return {
        "row_count": rows,
        "null_count": rows - part["count"],
        "null_percent": F.try_divide(rows - part["count"], rows) * 100,
        "min": part["least"],
        "max": part["largest"],
        "average": F.try_divide(total, n),
        "standard_deviation": F.sqrt(F.greatest(variance, F.lit(0.0)) * F.when(variance.isNotNull(), 1.0)),
        "zero_count": part["zeros"],
    }


def daily_metrics(profiled: DataFrame) -> DataFrame:
    """(date, column_name, metric, value): every statistic of every staged measure, by day."""
    rows = [
        {"column_name": F.lit(name), "metric": F.lit(metric), "value": number(value)}
        for name in MEASURES
        for metric, value in metrics_from(profiled, name).items()
    ]
    return rows_from_aggregate(profiled, rows, ["date"])


def declared_tests(profiled: DataFrame) -> DataFrame:
    """All 36 declared tests in one aggregate over the base."""
    staged = [
        verdict(F.lit("stg_covid19"), "not_null", F.lit(name), F.coalesce(F.sum(f"gaps_{name}"), F.lit(0))) for name in TESTED
    ]
    of_marts = [row for model, columns in NOT_NULL.items() if model != "stg_covid19" for row in not_null_rows(model, columns)]
    return rows_from_aggregate(profiled, [*staged, *of_marts])


def arrivals(profiled: DataFrame) -> DataFrame:
    """(date, country_code, row_count) of the staged rows."""
    return profiled.groupBy("date", "country_code").agg(F.sum("row_count").alias("row_count"))


def model_row_counts(profiled: DataFrame) -> DataFrame:
    """(model, row_count). The marts are projections of the base, so they share its count."""
    staged = {"model": F.lit("stg_covid19"), "row_count": F.coalesce(F.sum("row_count"), F.lit(0))}
    marts = [{"model": F.lit(name), "row_count": F.count(F.lit(1))} for name in ("daily_country_base", *MARTS)]
    return rows_from_aggregate(profiled, [staged, *marts])
