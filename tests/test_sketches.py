"""Sketches in the base: what they say of days and months, and distributions that move."""

from __future__ import annotations

import math
import random
from collections import Counter
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyward.operators import history, observability, profile, sketches
from tallyward.operators.staging import stage
from tallyward.plans.daily_run import DailyRun
from tests.frames import AS_OF, MARCH, raw_rows, row
from tests.test_plans import executed, exchanges
from tests.test_runs import config  # noqa: F401

COLUMNS = ("subregion1_name", "new_confirmed", "hospital_beds_per_1000", "population")


@pytest.fixture(scope="module")
def staged(spark):
    """Two months, two countries, gaps; one column without any value."""
    rnd = random.Random(4)
    rows = []
    for n in range(1200):
        region = None if n % 7 == 0 else "" if n % 11 == 0 else f"R{rnd.randrange(40)}"
        cells = {"hospital_beds_per_1000": rnd.choice([None, 0.0, -0.0, rnd.random()])}
        rows.append(row(MARCH + timedelta(days=n % 60), "AB"[n % 2] * 2, "x", rnd.randrange(500), subregion1_name=region, **cells))
    return stage(raw_rows(spark, *rows), AS_OF)


@pytest.fixture(scope="module")
def base(staged, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("base") / "b")
    profile.profiled_base(staged, COLUMNS).write.parquet(path)
    return staged.sparkSession.read.parquet(path)


def test_kinds_follow_the_types(base):
    assert sketches.sketched(base, "distinct") == list(COLUMNS)
    assert sketches.sketched(base, "lengths") == ["subregion1_name"]
    assert sketches.sketched(base, "quantiles") == sketches.sketched(base, "tails") == list(COLUMNS[1:])


@pytest.mark.parametrize("period", ["day", "month"])
def test_periods_add_up(staged, base, period):
    rows = staged.collect()
    when = (lambda d: d) if period == "day" else (lambda d: d.replace(day=1))
    groups = {}
    for r in rows:
        groups.setdefault(when(r.date), []).append(r)
    checked = sketches.distinct_checks_by(base, staged, period).collect()
    assert {(r.period, r.column_name): r.distinct_count for r in checked} == {
        (p, c): len({str(r[c] + 0.0) if isinstance(r[c], float) else r[c] for r in found if r[c] is not None})
        for p, found in groups.items()
        for c in COLUMNS
    }
    assert all(r.is_close for r in checked)
    quantiles = sketches.quantile_checks_by(base, staged, period).collect()
    assert all(r.is_close for r in quantiles)
    # A column without values has no quantile.
    assert {r.column_name for r in quantiles} == {"new_confirmed", "hospital_beds_per_1000"}
    for r in quantiles:
        values = [x[r.column_name] for x in groups[r.period] if x[r.column_name] is not None]
        assert r.value_count == len(values)
        assert r.extreme == {0.0: min(values), 1.0: max(values)}.get(r.quantile)
    lengths = {(r.period, r.metric): r.value for r in sketches.lengths_by(base, period).collect()}
    for p, found in groups.items():
        texts = [r.subregion1_name for r in found if r.subregion1_name is not None]
        assert lengths[p, "value_count"] == len(texts) and lengths[p, "empty_count"] == texts.count("")
        assert lengths[p, "max_length"] == max(map(len, texts)) and lengths[p, "min_length"] == min(map(len, texts))
    for r in sketches.histograms_by(base, period).collect():
        values = [x[r.column_name] for x in groups[r.period] if x[r.column_name] is not None]
        classes = Counter(0 if v < 1 else min(int(math.log2(v)) + 1, 15) for v in values)
        assert r.counts == [classes[i] for i in range(16)]


def test_estimates_of_many_values(spark):
    """Beyond the size up to which sketches are exact: within their errors, whatever the grouping."""
    rows = spark.range(200_000).selectExpr(
        "date'2021-03-01' + cast(id % 40 as int) as date", "concat('C', id % 5) as country_code", "'x' as country_name", "id * 7 % 90001 as v"
    )
    grouped = rows.groupBy("date", "country_code", "country_name").agg(*sketches.sketch_columns(rows.schema, ["v"]))
    for period in sketches.PERIODS:
        assert sketches.distinct_checks_by(grouped, rows, period).where("not is_close").count() == 0
        assert sketches.quantile_checks_by(grouped, rows, period).where("not is_close").count() == 0
    wrong = rows.withColumn("v", F.expr("v % 100"))
    assert sketches.distinct_checks_by(grouped, wrong, "month").where("is_close").count() == 0
    assert sketches.quantile_checks_by(grouped, wrong, "month").where("quantile = 0.5 and is_close").count() == 0


def test_the_base_with_sketches_is_one_scan_and_one_exchange(staged, tmp_path):
    staged.write.parquet(str(tmp_path / "s"))
    made = profile.profiled_base(staged.sparkSession.read.parquet(str(tmp_path / "s")), COLUMNS)
    assert executed(made).count("FileScan") == 1 and exchanges(made) == ["hashpartitioning"]
    plain = profile.profiled_base(staged.sparkSession.read.parquet(str(tmp_path / "s")))
    assert "hll" not in executed(plain)


def test_all_periods_are_counted_in_one_pass(spark, tmp_path):
    """Both zeros and all that are no numbers are one value; a day whose values are all missing has none, a day without rows no count."""
    cells = [(0, 1, 0.0, "a"), (0, 1, -0.0, ""), (0, 2, float("nan"), None), (0, None, float("nan"), "a"), (1, 1, 1.5, "a"), (2, None, None, None)]
    cells += [(30, 3, 1.5, "b"), (31, 1, 0.0, "a")]
    rows = [(MARCH + timedelta(days=day), "AA", "aa", *values) for day, *values in cells]
    spark.createDataFrame(rows, "date date, country_code string, country_name string, n int, x double, s string").write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    assert exchanges(sketches.distinct_counts(stored, ["n", "x", "s"]))[0] == "hashpartitioning"
    assert executed(sketches.distinct_counts(stored, ["n", "x", "s"])).count("FileScan") == 1
    base = stored.groupBy("date", "country_code", "country_name").agg(*sketches.sketch_columns(stored.schema, ["n", "x", "s"]))
    found = sketches.distinct_checks(base, stored).collect()
    assert all(r.is_close for r in found)
    april = (MARCH + timedelta(days=31)).replace(day=1)
    expected = {("month", MARCH): (3, 3, 3), ("month", april): (1, 1, 1)}
    expected |= {("day", MARCH + timedelta(days=d)): n for d, n in {0: (2, 2, 2), 1: (1, 1, 1), 2: (0, 0, 0), 30: (1, 1, 1), 31: (1, 1, 1)}.items()}
    assert {(r.kind, r.period, r.column_name): r.distinct_count for r in found} == {
        (*when, name): n for when, counts in expected.items() for name, n in zip("nxs", counts, strict=True)
    }


def test_tails_are_exact_and_one_aggregate(spark):
    """However many tasks have a part of a group; values at the edges, above the last one, negative, missing and no numbers."""
    rows = spark.range(0, 60_000, 1, 64).selectExpr(
        "date'2021-03-01' as date", "concat('C', id % 2) as country_code", "'x' as country_name",
        "case when id % 11 = 0 then null when id % 13 = 0 then double('nan') when id % 7 = 0 then -1.0d"
        " else pow(2, id % 17) - id % 3 end as v", "cast(null as bigint) as none",
    )
    tails = sketches.sketch_columns(rows.schema, ["v", "none"])
    found = rows.groupBy("date", "country_code", "country_name").agg(*tails)
    assert executed(found).count("histogram_numeric") and "partial_count(CASE" not in executed(found)
    values = {}
    for r in rows.collect():
        values.setdefault(r.country_code, []).append(r.v)
    for r in found.collect():
        here = [v for v in values[r.country_code] if v is not None]
        assert r.tails_v == [len(here), *[sum(v >= edge or v != v for v in here) for edge in sketches.EDGES]]
        assert r.tails_none == [0] * 16


def daily_histograms(spark, days):
    """Days of values as a frame of histograms."""
    rows = []
    for n, values in enumerate(days):
        classes = Counter(0 if v < 1 else min(int(math.log2(v)) + 1, 15) for v in values)
        rows.append((MARCH + timedelta(days=n), "v", [classes[i] for i in range(16)]))
    return spark.createDataFrame(rows, "period date, column_name string, counts array<bigint>")


def test_a_shape_that_moves_with_mean_and_spread_unchanged(spark):
    """Half of the values at 90 and half at 110, then a tenth at 77.6 and a tenth at 122.4 around 100 (same mean, same deviation)."""
    usual = [90] * 400 + [110] * 400
    odd = [100 - 22.3607] * 80 + [100] * 640 + [100 + 22.3607] * 80
    mean = lambda values: sum(values) / len(values)
    spread = lambda values: math.sqrt(mean([(v - mean(values)) ** 2 for v in values]))
    assert mean(usual) == pytest.approx(mean(odd)) and spread(usual) == pytest.approx(spread(odd), rel=1e-3)
    scaled = lambda values: [v * 1.28 for v in values]  # noqa: E731  115 and 141: the edge at 128 lies between
    days = [scaled(usual)] * 12 + [scaled(odd)] + [scaled(usual)] * 2
    found = {r.date: r for r in sketches.distribution_anomalies(daily_histograms(spark, days)).collect()}
    odd_day = MARCH + timedelta(days=12)
    assert [d for d, r in sorted(found.items()) if r.is_anomalous] == [odd_day]
    averages = spark.createDataFrame([(MARCH + timedelta(days=n), "v", "average", mean(v)) for n, v in enumerate(days)], "date date, column_name string, metric string, value double")
    assert observability.metric_anomalies(averages).where("is_anomalous").count() == 0


def test_distances_by_their_formulas(spark):
    rnd = random.Random(9)
    days = [[rnd.expovariate(0.01 * (1 + n)) for _ in range(rnd.randrange(1, 60))] for n in range(20)]
    days[5] = []
    frame = daily_histograms(spark, days)
    counts = [r.counts for r in frame.sort("period").collect()]
    for n, r in enumerate(sketches.distribution_anomalies(frame).sort("date").collect()):
        before = [sum(c) for c in zip(*counts[max(0, n - 14) : n], strict=True)] if n else [0] * 16
        total, earlier = sum(counts[n]), sum(before)
        assert (r.value_count, r.history_count, r.history_days) == (total, earlier, min(n, 14))
        if n < 7:
            assert r.psi is None and r.ks is None and not r.is_anomalous
            continue
        p, q = [(x + 0.5) / (total + 8) for x in counts[n]], [(x + 0.5) / (earlier + 8) for x in before]
        psi = sum((a - b) * math.log(a / b) for a, b in zip(p, q, strict=True))
        ks = max(abs(sum(counts[n][: i + 1]) / total - sum(before[: i + 1]) / earlier) for i in range(16))
        assert r.psi == pytest.approx(psi, abs=1e-6) and r.ks == pytest.approx(ks, abs=1e-6)
        assert r.is_anomalous == (psi > 0.2 and ks > 1.63 * math.sqrt((total + earlier) / (total * earlier)))


def test_few_values_are_no_drift(spark):
    """Three values can look very different from a thousand by chance."""
    days = [[10, 100, 1000] * 300] * 10 + [[10, 10, 10]]
    (last,) = sketches.distribution_anomalies(daily_histograms(spark, days)).where(F.col("date") == MARCH + timedelta(days=10)).collect()
    assert last.psi > 0.2 and not last.is_anomalous


def test_a_run_stores_what_the_sketches_say(spark, config):  # noqa: F811
    run = DailyRun(spark, replace(config, sketches=("subregion1_name", "new_confirmed"))).execute()
    assert run.error is None
    for name, rows in (("distinct", 60), ("quantiles", 180), ("lengths", 150), ("distributions", 30)):
        assert history.read_run(spark, f"{config.history_path}/monitoring_{name}", run.run_id).count() == rows, name
    areas = {r.area: r.checked for r in history.read_run(spark, f"{config.history_path}/monitoring_report", run.run_id).collect()}
    assert areas["distributions"] == 1 and areas["volume_changes"] == 1
    plain = DailyRun(spark, config).execute()
    assert plain.error is None
    assert set(r.run_id for r in history.read_history(spark, f"{config.history_path}/monitoring_distinct").collect()) == {run.run_id}
    assert date(2021, 3, 31) == config.as_of
