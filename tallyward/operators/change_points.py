"""Slow changes of a daily volume: when did it begin to fall or rise?

A score looks at one day at a time and against days that may already be part of the change, so a decline of a few percent a day never
stands out. Here each day is compared with the same weekday of the weeks before, in units of how much days usually differ, and these
differences are summed up: a cumulative sum leaves 0 only while they lean to one side, and the day after it last was 0 is the day
on which the change began.

The sum that is cut off at 0, S = max(0, S + x), is the running total less its smallest value so far, so ordered windows
compute it. It is kept in whole millionths, which add up alike in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.observability import number

WEEKS = 4
SPREAD_DAYS = 28
MINIMUM_DAYS = 14
# In units of the usual difference: what a day may lean without counting, the most it counts (so that no single day makes a change),
# and the sum at which a change is found. With these a year of usual weeks brings one false change in a hundred, and of a decline of 3
# percent a day the beginning is found to within a day or two, three to six days later (simulated at 2 to 5 percent of noise).
SLACK = 1.0
MOST = 3.0
FOUND = 5.0
# Days are taken to differ by a hundredth at least.
LEAST_SPREAD = 0.01

MILLION = 1_000_000


def expected_volume(volume: DataFrame, weeks: int = WEEKS) -> DataFrame:
    """Add ``expected``, the mean of the same weekday in the weeks before, and ``deviation``, the share by which the day differs from it.

    ``volume`` has a row for each key and day (:func:`tallyward.operators.observability.on_every_day`).
    """
    same_weekday = Window.partitionBy("table_name", F.weekday("date")).orderBy("date").rowsBetween(-weeks, -1)
    expected = F.avg("row_count").over(same_weekday)
    return volume.withColumn("expected", expected).withColumn(
        "deviation", (F.col("row_count") - F.col("expected")) / F.greatest(F.col("expected"), F.lit(1.0))
    )


def change_points(
    volume: DataFrame,
    weeks: int = WEEKS,
    slack: float = SLACK,
    most: float = MOST,
    found: float = FOUND,
    spread_days: int = SPREAD_DAYS,
    minimum_days: int = MINIMUM_DAYS,
) -> DataFrame:
    """(table_name, date, row_count, expected, score, fall, rise, change, began) for each day of each key.

    ``score`` is the deviation in units of the usual one of the days before, cut off at ``most``; NULL with fewer than ``minimum_days`` of
    them. ``fall`` and ``rise`` are the cumulative sums. Where one is at ``found`` or more, ``change`` names the larger and ``began`` the
    day on which it left 0. A window holds a key's days, whatever the size of the table.
    """
    ordered = Window.partitionBy("table_name").orderBy("date")
    before = ordered.rowsBetween(-spread_days, -1)
    compared = expected_volume(volume, weeks).withColumns(
        {"_spread": F.stddev_samp("deviation").over(before), "_days": F.count("deviation").over(before)}
    )
    units = F.round(F.col("deviation") / F.greatest(F.col("_spread"), F.lit(LEAST_SPREAD)) * MILLION)
    limit = int(most * MILLION)
    scored = compared.withColumn(
        "_score",
        F.when(F.col("_days") >= minimum_days, F.greatest(F.lit(-limit), F.least(F.lit(limit), units.cast("bigint")))).cast("bigint"),
    )
    allowed = F.lit(int(slack * MILLION)).cast("bigint")
    leans = {"fall": -F.col("_score") - allowed, "rise": F.col("_score") - allowed}
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    for name, lean in leans.items():
        scored = scored.withColumn(f"_total_{name}", F.sum(F.coalesce(lean, F.lit(0).cast("bigint"))).over(upto))
    for name in leans:
        least = F.least(F.lit(0).cast("bigint"), F.min(f"_total_{name}").over(upto))
        scored = scored.withColumn(f"_{name}", F.col(f"_total_{name}") - least)
    for name in leans:
        last_zero = F.max(F.when(F.col(f"_{name}") == 0, F.col("date"))).over(upto)
        first = F.min("date").over(upto)
        scored = scored.withColumn(f"_began_{name}", F.coalesce(F.date_add(last_zero, 1), first))
    high = int(found * MILLION)
    fell = (F.col("_fall") >= high) & (F.col("_fall") >= F.col("_rise"))
    rose = F.col("_rise") >= high
    return scored.select(
        "table_name",
        "date",
        "row_count",
        number(F.col("expected")).alias("expected"),
        (F.col("_score") / F.lit(float(MILLION))).alias("score"),
        (F.col("_fall") / F.lit(float(MILLION))).alias("fall"),
        (F.col("_rise") / F.lit(float(MILLION))).alias("rise"),
        F.when(fell, "fall").when(rose, "rise").alias("change"),
        F.when(fell, F.col("_began_fall")).when(rose, F.col("_began_rise")).alias("began"),
    )


def change_episodes(points: DataFrame) -> DataFrame:
    """(table_name, change, began, found, last_day, days, lowest, highest): a row for each change that was found, with its extent."""
    changes = points.where(F.col("change").isNotNull())
    return changes.groupBy("table_name", "change", "began").agg(
        F.min("date").alias("found"),
        F.max("date").alias("last_day"),
        F.count(F.lit(1)).alias("days"),
        F.min("row_count").alias("lowest"),
        F.max("row_count").alias("highest"),
    )
