"""What the plans must look like for the jobs to hold at scale."""

from __future__ import annotations

import contextlib
import io
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyward.operators import column_checks, expectations, profile
from tallyward.plans import dashboards
from tallyward.plans.models import build_models
from tallyward.sources import storage
from tallyward.sources.star_schema import TEST_DAY, raw_observations
from tallyward.streaming import daily_stream

DIRECTORY = "/root/testdata/sf0.001"


def executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def formatted(frame):
    """The plan with untruncated filters and schemas."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


def exchanges(frame):
    return re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)", executed(frame))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """A stored raw zone with unused columns, as in production."""
    path = str(tmp_path_factory.mktemp("raw") / "zone")
    wide = raw_observations(spark, DIRECTORY).selectExpr("*", *[f"{n} as unused_{n}" for n in range(40)])
    storage.write_counted(wide, path, partition_by=["date"])
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def models(raw):
    return build_models(raw, TEST_DAY)


def test_each_mart_reads_only_its_columns(models):
    wanted = {
        "country_metrics": {
            "new_confirmed",
            "new_deceased",
            "new_recovered",
            "cumulative_confirmed",
            "cumulative_deceased",
            "population",
        },
        "impact": {
            "new_confirmed",
            "new_deceased",
            "new_recovered",
            "cumulative_confirmed",
            "cumulative_deceased",
            "new_hospitalized_patients",
            "current_hospitalized_patients",
            "current_intensive_care_patients",
            "current_ventilator_patients",
            "hospital_beds_per_1000",
            "population",
        },
    }
    for mart, measures in wanted.items():
        read = re.search(r"ReadSchema: struct<(.*?)>", formatted(getattr(models, mart))).group(1)
        assert {column.split(":")[0] for column in read.split(",")} == measures | {"country_code", "country_name"}


def test_one_exchange_with_partial_aggregation(models):
    for mart in (models.base, models.country_metrics, models.impact, models.vaccination, models.government):
        assert exchanges(mart) == ["hashpartitioning"]
        assert "partial_sum" in executed(mart)
        assert "SortAggregate" not in executed(mart)


def test_staging_filters_reach_the_scan(models):
    plan = executed(models.staged)
    assert "PartitionFilters: [isnotnull(date" in plan
    for pushed in ("IsNotNull(new_confirmed)", "IsNotNull(new_deceased)", "IsNotNull(country_code)"):
        assert pushed in plan
    assert "Exchange" not in plan


def test_page_filter_passes_below_the_aggregate(models):
    page = dashboards.page_filter(models.impact, ["AN"], date(2020, 3, 1), date(2020, 3, 31))
    scan = re.search(r"PartitionFilters: \[(.*)\]", formatted(page)).group(1)
    assert "2020-03-01" in scan
    assert "2020-03-31" in scan


def test_all_checks_of_a_frame_are_one_aggregate(models):
    tests = column_checks.declared_tests(models.staged, models.base)
    assert executed(tests).count("FileScan") == 2
    rules = expectations.validate(models.impact, expectations.IMPACT_SUITE)
    assert executed(rules).count("FileScan") == 1
    assert exchanges(rules) == ["SinglePartition", "hashpartitioning"]


def test_evidence_of_all_rules_is_one_scan_cut_before_it_is_exchanged(models):
    found = executed(expectations.evidence(models.impact, expectations.IMPACT_SUITE, limit=3))
    assert found.count("FileScan") == 1
    assert found.count("WindowGroupLimit") == 2


def test_the_profile_of_a_run_is_one_scan_and_one_exchange(models):
    base = profile.profiled_base(models.staged)
    assert executed(base).count("FileScan") == 1
    assert exchanges(base) == ["hashpartitioning"]
    counts = executed(profile.model_row_counts(base))
    assert counts.count("FileScan") == 1 and "sum(cast" not in counts
    assert executed(profile.declared_tests(base)).count("FileScan") == 1


def test_uniqueness_of_the_grain_needs_no_second_shuffle(models):
    """The mart is already partitioned by its grain; only the one-row total is exchanged again."""
    grain = column_checks.unique(models.impact, "mart_pandemic_impact", ["date", "country_code", "country_name"])
    assert exchanges(grain) == ["SinglePartition", "hashpartitioning"]


def test_latest_values_use_hash_aggregates(models):
    assert "SortAggregate" not in executed(dashboards.policy_scorecards(models.government))
    assert "SortAggregate" not in executed(dashboards.coverage_scorecard(models.vaccination))


def test_top_list_is_not_a_full_sort(models):
    assert "TakeOrderedAndProject" in executed(dashboards.top_fatality_rates(models.impact))


def test_dimensions_are_broadcast_only_below_the_threshold(spark):
    raw = raw_observations(spark, DIRECTORY)
    assert executed(raw).count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unhinted = raw_observations(spark, DIRECTORY)
        assert executed(unhinted).count("SortMergeJoin") == 2
        assert unhinted.count() == raw.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stream_refresh_prunes_to_the_touched_days(spark, models, tmp_path):
    path = str(tmp_path / "stored")
    batches = models.staged.selectExpr("*", "0L as batch_id").unionByName(
        models.staged.where("date = date '2020-05-05'").selectExpr("*", "1L as batch_id")
    )
    storage.write_counted(batches, path, partition_by=["date", "batch_id"])
    touched = daily_stream.of_touched_days(spark.read.parquet(path), 1)
    assert "dynamicpruningexpression(date" in formatted(touched)
    assert [r.date for r in touched.select("date").distinct().collect()] == [date(2020, 5, 5)]
    assert touched.count() == 2 * models.staged.where("date = date '2020-05-05'").count()


def test_no_stored_row_is_exchanged_to_find_its_newest_arrival(spark, raw, tmp_path):
    """Neither by the join with the touched days, however large the batch that they are read from, nor by the key."""
    arrivals, stored, base, checkpoint = (str(tmp_path / name) for name in ("arrivals", "stored", "base", "checkpoint"))
    key = ["date", "population", "gdp_per_capita_usd", "stringency_index"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = spark.read.parquet(raw.inputFiles()[0].rsplit("/date=", 1)[0]).selectExpr("*", "0L as batch_id")
        assert "SortMergeJoin" not in executed(daily_stream.of_touched_days(plain, 0))
        raw.where("date is not null").write.parquet(arrivals)
        stream = daily_stream.raw_stream(spark, arrivals, raw.schema)
        daily_stream.refresh_corrected(stream, stored, base, checkpoint, key).awaitTermination()
        by = daily_stream._bucket_columns(raw.schema, key)
        assert by == key[:3]
        with daily_stream._arrivals(spark, stored, raw.schema, by, daily_stream._stored_buckets(spark, stored)) as name:
            touched = daily_stream.of_touched_days(spark.table(name), 0, ["month", "date"])
            rows = daily_stream.newest_arrivals(touched.drop("month"), key)
            assert touched.count() == raw.where("date is not null").count()
            # Only the touched days are exchanged.
            assert set(re.findall(r"Exchange (\w+\(\w+)#", executed(rows))) == {"hashpartitioning(month"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_supplier_is_split_when_the_join_is_sorted(spark, tmp_path):
    """A third of all line items belong to one supplier, and no side may be broadcast."""
    items = spark.read.parquet(f"{DIRECTORY}/lineitem.parquet").withColumn(
        "l_suppkey", F.expr("if(l_orderkey % 3 = 0, 1L, l_suppkey)")
    )
    items.repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    for table in ("supplier", "nation"):
        spark.read.parquet(f"{DIRECTORY}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    plain = build_models(raw_observations(spark, str(tmp_path)), TEST_DAY).base.collect()
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        base = build_models(raw_observations(spark, str(tmp_path)), TEST_DAY).base
        assert sorted(base.collect(), key=str) == sorted(plain, key=str)
        assert "skew=true" in executed(base)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
