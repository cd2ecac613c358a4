"""Change points: a slow decline that scores miss, the cumulative sum step by step, single days that are no change."""

from __future__ import annotations

import random
from datetime import timedelta
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from tallyward.operators import change_points as cp
from tallyward.operators import observability
from tests.frames import MARCH

WEEKDAY = [1.0, 1.05, 1.0, 0.95, 1.1, 0.6, 0.5]


def volume(spark, counts, name="t"):
    rows = [(name, MARCH + timedelta(days=n), int(count)) for n, count in enumerate(counts)]
    return spark.createDataFrame(rows, "table_name string, date date, row_count bigint")


def weekly(days, seed=1, noise=0.03, factor=lambda n: 1.0, level=10_000):
    rnd = random.Random(seed)
    return [level * WEEKDAY[n % 7] * factor(n) * rnd.gauss(1, noise) for n in range(days)]


@pytest.mark.parametrize("seed", range(4))
def test_a_decline_of_three_percent_a_day(spark, seed):
    start = 70
    frame = volume(spark, weekly(84, seed, factor=lambda n: 0.97 ** max(0, n - start + 1)))
    assert observability.volume_anomalies(frame).where("is_anomalous").count() == 0
    points = cp.change_points(frame)
    assert points.where(F.col("change").isNotNull() & (F.col("date") < MARCH + timedelta(days=start))).count() == 0
    falls = cp.change_episodes(points).where("change = 'fall'").collect()
    assert len(falls) == 1
    began, found = ((day - MARCH).days for day in (falls[0].began, falls[0].found))
    assert abs(began - start) <= 3 and found <= start + 7


def test_a_rise_and_its_end(spark):
    """A step of 15 percent is found and ends when the weeks before have become like it."""
    frame = volume(spark, weekly(140, factor=lambda n: 1.15 if n >= 60 else 1.0))
    (rise,) = cp.change_episodes(cp.change_points(frame)).where("change = 'rise'").collect()
    assert abs((rise.began - MARCH).days - 60) <= 1 and (rise.found - MARCH).days <= 63
    assert (rise.last_day - MARCH).days < 125


def test_no_change_in_usual_weeks(spark):
    frames = [volume(spark, weekly(200, seed, noise=0.05), f"t{seed}") for seed in range(5)]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    assert cp.change_points(union).where("change is not null").groupBy("table_name").count().count() <= 1


def test_one_odd_day_is_no_change(spark):
    for odd in (0.0, 5.0):
        frame = volume(spark, weekly(90, factor=lambda n, odd=odd: odd if n == 75 else 1.0))
        scored = cp.change_points(frame).where(F.col("date") == MARCH + timedelta(days=75)).first()
        assert abs(scored.score) == 3.0 and scored.change is None


def plain(counts):
    """Day by day, as the definition says."""
    deviations, rows, fall, rise, fall_since, rise_since = [], [], 0.0, 0.0, 0, 0
    for n, count in enumerate(counts):
        same = counts[max(0, n - 28) : n][::-1][6::7][:4]
        expected = mean(same) if same else None
        usual = [d for d in deviations[-28:] if d is not None]
        deviation = None if expected is None else (count - expected) / max(expected, 1.0)
        score = None
        if deviation is not None and len(usual) >= 14:
            score = round(max(-3.0, min(3.0, deviation / max(stdev(usual), 0.01))), 6)
            fall, rise = max(0.0, fall - score - 1.0), max(0.0, rise + score - 1.0)
        fall_since, rise_since = (n + 1 if fall < 1e-9 else fall_since), (n + 1 if rise < 1e-9 else rise_since)
        change = "fall" if fall >= 5 and fall >= rise else "rise" if rise >= 5 else None
        rows.append((expected, score, fall, rise, change, {"fall": fall_since, "rise": rise_since}.get(change)))
        deviations.append(deviation)
    return rows


def test_against_the_definition(spark):
    counts = [int(c) for c in weekly(150, 8, noise=0.2, factor=lambda n: 0.9 if 60 < n < 80 else 1.3 if n > 110 else 1.0, level=300)]
    counts[40:43] = [0, 0, 0]
    found = cp.change_points(volume(spark, counts)).sort("date").collect()
    for row, (expected, score, fall, rise, change, since) in zip(found, plain(counts), strict=True):
        assert row.expected == (None if expected is None else pytest.approx(expected, abs=1e-6))
        assert row.score == (None if score is None else pytest.approx(score, abs=2e-6))
        assert row.fall == pytest.approx(fall, abs=1e-4) and row.rise == pytest.approx(rise, abs=1e-4)
        assert row.change == change
        assert (None if row.began is None else (row.began - MARCH).days) == since


def test_keys_are_apart_and_short_series_have_no_score(spark):
    both = volume(spark, weekly(90), "a").unionByName(volume(spark, [5, 0, 7], "b"))
    points = cp.change_points(both)
    assert points.where("table_name = 'b' and (score is not null or change is not null)").count() == 0
    alone = cp.change_points(volume(spark, weekly(90), "a"))
    assert points.where("table_name = 'a'").exceptAll(alone).count() == 0
    assert cp.change_points(both.limit(0)).count() == 0
