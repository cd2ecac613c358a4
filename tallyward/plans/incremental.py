"""Refresh the stored base of the marts for some days only.

A refresh reads the raw rows of the days concerned (a partition filter when the raw zone is partitioned by day), aggregates them and
replaces exactly those days, all in one step; days that have lost all their rows go. Repeating it is harmless.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tallyward.operators.marts import daily_country_base
from tallyward.operators.staging import stage
from tallyward.plans.dashboards import page_filter
from tallyward.sources import days
from tallyward.sources.days import stored_days  # noqa: F401


def refresh_base(
    raw: DataFrame, path: str, first: date | None = None, last: date | None = None, as_of: date | None = None
) -> int:
    """Recompute the base for the days from ``first`` to ``last`` and return the rows written.

    Without bounds the base is rebuilt whole. With bounds the days in between are replaced, and those for which no valid row is left are
    gone. A reader sees the base before the refresh or after it.
    """
    base = daily_country_base(stage(page_filter(raw, first=first, last=last), as_of))

    def in_range(day: str) -> bool:
        return (first is None or day >= first.isoformat()) and (last is None or day <= last.isoformat())

    return days.replace_days(base, path, in_range)


def read_base(spark: SparkSession, path: str, as_of: date | None = None) -> DataFrame:
    """The stored base, up to ``as_of`` if given."""
    return days.read_days(spark, path, as_of)
