"""Renamed columns: found by their values, unlike ones left alone, rows that came or went in between."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyward.operators import renames
from tests.test_plans import executed


@pytest.fixture(scope="module")
def before(spark):
    return spark.range(5000).selectExpr(
        "id as k",
        "if(id % 9 = 0, null, concat('n', id % 700)) as name",
        "id % 4 as level",
        "id % 4 + (id % 50 = 0)::int as nearly",
        "cast(id % 13 as double) / 4 as share",
        "cast(null as string) as empty",
        "date'2021-01-01' + cast(id % 300 as int) as day",
    )


def found(before, after, keys=("k",), **options):
    return {(r.removed, r.added): r for r in renames.column_matches(before, after, keys, **options).collect()}


def test_renames_among_columns_of_a_kind(before):
    after = before.withColumnsRenamed({c: f"new_{c}" for c in before.columns if c != "k"})
    matches = found(before, after)
    assert {pair for pair, r in matches.items() if r.is_rename} == {
        (c, f"new_{c}") for c in ("name", "level", "nearly", "share", "day")
    }
    # Kinds: three numbers, two texts and a date meet their like only.
    assert len(matches) == 9 + 4 + 1
    assert matches["level", "new_nearly"].common > 0.9 and not matches["level", "new_nearly"].is_rename
    assert matches["empty", "new_empty"].common == 0.0
    assert renames.renamed_columns(before, after, ["k"]).count() == 5


def test_unlike_columns_are_not_matched(before):
    after = before.withColumn("other", F.expr("(id % 4 + 1) % 4".replace("id", "k"))).drop("level")
    assert not found(before, after)["level", "other"].is_rename
    # Without keys the two have the same few values, which proves nothing.
    assert found(before, after, keys=())["level", "other"].common == 1.0
    assert not found(before, after, keys=())["level", "other"].is_rename
    shuffled = before.withColumn("title", F.expr("concat('n', (k * 7 + 3) % 700)")).drop("name")
    assert not found(before, shuffled)["name", "title"].is_rename


def test_rows_that_came_and_went(before):
    more = before.where("k >= 1000").unionByName(before.where("k >= 1000").withColumn("k", F.col("k") + 5000))
    assert found(before, more.withColumnRenamed("name", "title"))["name", "title"].common == pytest.approx(4000 / 5000, abs=0.03)
    fewer = before.where("k % 3 = 0").withColumnRenamed("name", "title")
    assert found(before, fewer)["name", "title"].is_rename
    grown = before.unionByName(before.withColumn("k", F.col("k") + 5000)).withColumnRenamed("name", "title")
    assert found(before, grown)["name", "title"].is_rename


def test_a_wider_type_is_still_the_column(before):
    after = before.withColumn("grade", F.col("level").cast("double")).drop("level")
    assert found(before, after)["level", "grade"].is_rename


def test_many_values(spark):
    before = spark.range(300_000).selectExpr("id as k", "id * 31 % 99991 as v")
    after = before.withColumnRenamed("v", "w").withColumn("x", F.expr("if(k % 4 = 0, w + 1, w)"))
    matches = found(before, after)
    assert matches["v", "w"].is_rename and not matches["v", "x"].is_rename
    assert matches["v", "x"].common == pytest.approx(0.75, abs=0.03)


def test_nothing_renamed_reads_nothing(before):
    assert renames.column_matches(before, before.drop("name")).collect() == []
    assert "Range" not in executed(renames.column_matches(before, before.withColumn("z", F.lit(1))))


def test_one_aggregate_for_each_state(spark, before, tmp_path):
    before.write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    plan = executed(renames.column_matches(stored, stored.withColumnsRenamed({"name": "a", "level": "b", "day": "c"}), ["k"]))
    assert plan.count("FileScan") == 2 and "share" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
