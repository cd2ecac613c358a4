from __future__ import annotations

import math
from datetime import date, timedelta
from statistics import mean, stdev

from tallyward.operators import observability as obs
from tallyward.plans.report import quality_report

START = date(2020, 1, 1)


def series(spark, values, name="t"):
    rows = [(name, START + timedelta(days=n), value) for n, value in enumerate(values)]
    return spark.createDataFrame(rows, "table_name string, date date, row_count bigint")


def test_column_metrics_by_type(spark):
    frame = spark.createDataFrame(
        [(1, 0.0, "a", START), (3, 2.0, "", START), (None, 4.0, "ccc", None)], "n bigint, x double, s string, d date"
    )
    metrics = {(r.column_name, r.metric): r.value for r in obs.column_metrics(frame).collect()}
    assert metrics[("n", "row_count")] == 3
    assert metrics[("n", "null_count")] == 1
    assert metrics[("n", "null_percent")] == round(100 / 3, 6)
    assert (metrics[("n", "min")], metrics[("n", "max")], metrics[("n", "average")]) == (1, 3, 2)
    assert metrics[("n", "standard_deviation")] == round(math.sqrt(2), 6)
    assert metrics[("x", "zero_count")] == 1
    assert (metrics[("s", "min_length")], metrics[("s", "max_length")], metrics[("s", "empty_count")]) == (0, 3, 1)
    assert metrics[("d", "null_count")] == 1
    assert ("d", "average") not in metrics


def test_passes_do_not_change_metrics(spark):
    frame = spark.range(100).selectExpr("id as a", "id % 7 as b", "cast(id as string) as c", "id % 3 as day")
    one = obs.column_metrics(frame, by=["day"], columns_per_pass=3).collect()
    many = obs.column_metrics(frame, by=["day"], columns_per_pass=1).collect()
    assert sorted(one, key=str) == sorted(many, key=str)


def test_distinct_estimates_are_close(spark):
    frame = spark.range(10_000).selectExpr("id as a", "id % 100 as b")
    estimates = {r.column_name: r.distinct_estimate for r in obs.distinct_estimates(frame).collect()}
    assert abs(estimates["a"] - 10_000) < 1500
    assert abs(estimates["b"] - 100) < 15


def test_scores_against_plain_python(spark):
    values = [(n * 37) % 23 + (200 if n == 20 else 0) for n in range(40)]
    scored = obs.anomaly_scores(series(spark, values), ["table_name"], "date", "row_count").sort("date").collect()
    for n, row in enumerate(scored):
        earlier = values[max(0, n - 14) : n]
        assert row.history_count == len(earlier)
        if len(earlier) < 7:
            assert row.anomaly_score is None
        else:
            assert math.isclose(row.anomaly_score, (values[n] - mean(earlier)) / stdev(earlier), abs_tol=1e-6)
    assert [n for n, row in enumerate(scored) if row.is_anomalous] == [20]


def test_constant_series_has_no_score(spark):
    scored = obs.anomaly_scores(series(spark, [5] * 20), ["table_name"], "date", "row_count").collect()
    assert all(row.anomaly_score is None and not row.is_anomalous for row in scored)


def test_declining_week(spark):
    values = [50, 51, *range(50, 40, -1), 60]
    rows = obs.volume_anomalies(series(spark, values)).sort("date").collect()
    assert [row.is_declining for row in rows] == [False] * 8 + [True] * 4 + [False]
    assert rows[0].change is None
    assert rows[-1].trailing_mean == round(mean(values[-7:]), 6)


def test_volume_from_counted_rows(spark):
    frame = spark.range(300).selectExpr("date_add(date '2020-01-01', cast(id % 9 as int)) as date", "id % 4 as country_code")
    direct = obs.daily_volume(frame, "t").sort("date").collect()
    assert obs.daily_volume(obs.arrivals(frame), "t", "row_count").sort("date").collect() == direct


def test_freshness(spark):
    frame = spark.createDataFrame(
        [(date(2020, 12, 30), "AA"), (date(2020, 12, 1), "AA"), (date(2020, 12, 20), "BB"), (None, "CC")],
        "date date, country_code string",
    )
    rows = {(r.level, r.country_code): (r.days_behind, r.is_fresh) for r in obs.freshness(frame, "t", date(2020, 12, 31)).collect()}
    assert rows == {
        ("table", None): (1, True),
        ("key", "AA"): (1, True),
        ("key", "BB"): (11, False),
        ("key", "CC"): (None, False),
    }


def test_an_empty_table_is_not_fresh(spark):
    frame = spark.createDataFrame([], "date date, country_code string")
    rows = obs.freshness(frame, "t", date(2020, 12, 31)).collect()
    assert [(r.level, r.last_date, r.days_behind, r.is_fresh) for r in rows] == [("table", None, None, False)]


def test_a_key_that_is_missing_stays_beside_the_table(spark):
    frame = spark.createDataFrame([(date(2020, 12, 30), None), (date(2020, 12, 1), "AA")], "date date, country_code string")
    rows = {(r.level, r.country_code): r.days_behind for r in obs.freshness(frame, "t", date(2020, 12, 31)).collect()}
    assert rows == {("table", None): 1, ("key", None): 1, ("key", "AA"): 30}


def test_an_outage_is_seen(spark):
    """40 days of which three are absent in the middle and two at the end."""
    values = [(n, 100 + n % 5) for n in range(40) if n not in (20, 21, 22, 38, 39)]
    rows = [("t", START + timedelta(days=n), v) for n, v in values]
    counts = spark.createDataFrame(rows, "table_name string, date date, row_count bigint")
    scored = obs.volume_anomalies(obs.on_every_day(counts, START + timedelta(days=39))).sort("date").collect()
    assert len(scored) == 40
    assert {n for n, row in enumerate(scored) if row.is_anomalous} >= {20, 38}
    assert [scored[n].row_count for n in (20, 21, 22, 38, 39)] == [0] * 5


def test_scores_look_back_days_not_rows(spark):
    """A gap of a month leaves no history."""
    rows = [("t", START + timedelta(days=n + (30 if n >= 10 else 0)), n % 4) for n in range(20)]
    series_ = spark.createDataFrame(rows, "table_name string, date date, row_count bigint")
    scored = obs.anomaly_scores(series_, ["table_name"], "date", "row_count").sort("date").collect()
    assert [row.history_count for row in scored] == [*range(10), *range(10)]


def test_the_newest_day_is_judged(spark):
    values = [10 + n % 3 for n in range(30)]
    values[15] = 500
    scored = obs.volume_anomalies(series(spark, values))
    verdict = obs.anomaly_tests(scored, ["table_name"]).first()
    assert (verdict.anomalies, verdict.passed, verdict.last_bucket) == (1, True, START + timedelta(days=29))
    bad = obs.volume_anomalies(series(spark, [*values, 900]))
    assert obs.anomaly_tests(bad, ["table_name"]).first().passed is False
    assert obs.newest(bad, ["table_name"]).first().row_count == 900


def test_profile_of_the_base_has_the_metrics_of_the_rows(spark):
    from tallyward.operators import profile
    from tallyward.operators.staging import stage
    from tests.frames import AS_OF, edge_rows

    staged = stage(edge_rows(spark), AS_OF)
    base = profile.profiled_base(staged)
    found = {(r.date, r.column_name, r.metric): r.value for r in profile.daily_metrics(base).collect()}
    direct = obs.column_metrics(staged, profile.MEASURES, by=["date"])
    expected = {(r.date, r.column_name, r.metric): r.value for r in direct.collect()}
    assert found == expected
    assert len({name for _, name, _ in found}) == 30
    assert obs.arrivals(staged).exceptAll(profile.arrivals(base)).count() == 0


def test_exact_and_estimated_distinct_counts(spark):
    frame = spark.range(5000).selectExpr("id as a", "id % 10 as b", "if(id < 0, id, null) as c")
    rows = {r.column_name: (r.distinct_count, r.is_close) for r in obs.distinct_checks(frame).collect()}
    assert rows == {"a": (5000, True), "b": (10, True), "c": (0, True)}


def test_gate(spark):
    frame = spark.createDataFrame([(date(2021, 12, 30),)], "date date")
    assert obs.has_rows_for_yesterday(frame, date(2021, 12, 31)).first().passed is True
    assert obs.has_rows_for_yesterday(frame, date(2021, 12, 30)).first().passed is False
    assert obs.has_rows_for_yesterday(frame).first().passed is False


def test_report(spark):
    tests = spark.createDataFrame([], "passed boolean")
    rules = spark.createDataFrame([(False,)], "success boolean")
    fresh = spark.createDataFrame([(True,)], "is_fresh boolean")
    scores = spark.createDataFrame(
        [("t", "c", "m", START, True), ("t", "c", "m", START + timedelta(days=1), False), ("u", "d", "m", START, True)],
        "table_name string, column_name string, metric string, date date, is_anomalous boolean",
    )
    contract = spark.createDataFrame([("ok",)], "status string")
    areas = {r.area: (r.checked, r.failed, r.passed) for r in quality_report(tests, rules, fresh, scores, scores, contract).collect()}
    assert areas == {
        "column_tests": (0, 0, False),
        "expectations": (1, 1, False),
        "freshness": (1, 0, True),
        "volume_anomalies": (2, 1, False),
        "metric_anomalies": (2, 1, False),
        "schema_contract": (1, 0, True),
    }
