"""Files by interleaved bits: the same rows, few files for each filter, odd columns."""

from __future__ import annotations

import glob
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyward.operators import layout
from tallyward.plans.dashboards import page_filter
from tests.test_runs import DailyRun, config, history  # noqa: F401


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    """A hundred countries over two years, in an order that helps neither filter."""
    path = str(tmp_path_factory.mktemp("mart") / "m")
    rows = spark.range(100 * 730).selectExpr(
        "date'2020-01-01' + cast(id % 730 as int) as date",
        "concat(chr(65 + cast(id div 730 % 26 as int)), chr(65 + cast(id div 730 div 4 as int))) as country_code",
        "id as total_new_cases",
        "'x' as code",
    )
    rows.orderBy(F.xxhash64("total_new_cases")).write.parquet(path)
    return spark.read.parquet(path)


def files_with(path, column, low, high):
    """Of all files those whose statistics let the range in."""
    files = glob.glob(f"{path}/*.parquet")
    found = 0
    for file in files:
        meta = pq.read_metadata(file)
        place = meta.schema.to_arrow_schema().names.index(column)
        stats = [meta.row_group(g).column(place).statistics for g in range(meta.num_row_groups)]
        found += any(s.min <= high and s.max >= low for s in stats)
    return found, len(files)


def scanned(frame):
    """Rows that the scan gave, after the statistics had left out the rest."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_few_files_for_a_country_and_for_a_day(spark, mart, tmp_path):
    path = str(tmp_path / "laid")
    layout.clustered_by(mart, ["country_code", "date"], 64).write.parquet(path)
    laid = spark.read.parquet(path)
    assert laid.columns == mart.columns and laid.exceptAll(mart).count() == 0 and laid.count() == mart.count()
    code = mart.first().country_code
    of_country, files = files_with(path, "country_code", code, code)
    of_day, _ = files_with(path, "date", date(2020, 5, 20), date(2020, 5, 20))
    # Eight by eight: a filter on either side should meet about an eighth of them.
    assert files == 64 and of_country <= 16 and of_day <= 16
    country, day = page_filter(laid, [code]), page_filter(laid, first=date(2020, 5, 20), last=date(2020, 5, 20))
    assert country.count() == 730 and day.count() == 100
    assert scanned(country) <= 0.3 * 73_000 and scanned(day) <= 0.3 * 73_000
    by_day = str(tmp_path / "by_day")
    mart.repartitionByRange(64, "date").write.parquet(by_day)
    assert files_with(by_day, "country_code", code, code)[0] > 32


def test_odd_columns(spark, tmp_path):
    rows = spark.range(1000).selectExpr(
        "if(id % 10 = 0, null, id % 7) as a",
        "if(id % 9 = 0, null, if(id % 3 = 0, '', concat('é', id))) as row",
        "timestamp_seconds(id * 1000) as code",
        "cast(null as date) as d",
    )
    for columns in (["a"], ["row", "code"], ["d", "a", "row"]):
        laid = layout.clustered_by(rows, columns, 4)
        assert laid.columns == rows.columns
        assert laid.exceptAll(rows).count() == 0 and laid.count() == 1000
    assert layout.clustered_by(rows.limit(0), ["a", "row"], 4).count() == 0
    with pytest.raises(ValueError):
        layout.clustered_by(rows.select(F.array("a").alias("x")), ["x"], 4)


def test_codes_order_within_a_column(spark):
    """Of a single column the code never falls as its values rise."""
    for column in ("cast(id as string)", "id * id", "date'2020-01-01' + cast(id as int)"):
        rows = spark.range(3000).selectExpr(f"{column} as v")
        code = layout.interleaved(rows, layout.cut_points(rows, ["v"], 4), 4)
        codes = [r.code for r in rows.select("v", code.alias("code")).sort("v").collect()]
        assert codes == sorted(codes) and len(set(codes)) == 16


def test_a_run_lays_out_its_tables(spark, config):  # noqa: F811
    from dataclasses import replace

    database = f"laid_{config.raw_table}"
    spark.sql(f"create database {database}")
    run = DailyRun(spark, replace(config, materialized="table", cluster_files=3, database=database)).execute()
    assert run.error is None
    table = spark.table(f"{database}.mart_pandemic_impact")
    assert table.count() == 60 and table.select(F.input_file_name()).distinct().count() <= 3
    assert table.schema["case_fatality_rate"].metadata["comment"]
