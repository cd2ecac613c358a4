"""The as-of join: against a comparison of every fact with every version, at any cutting of the keys."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest

from tallyward.operators.as_of import as_of_join
from tests.frames import MARCH
from tests.test_plans import executed

FACTS = "k string, j int, date date, n int, kind string, range string, key string"
VERSIONS = "k string, j int, valid_from date, valid_to date, level string, state string, last string"


def plain(facts, versions):
    """Every fact with the version that holds at its time; of those that begin together the one that ends last."""
    found = []
    for fact in facts:
        mine = [v for v in versions if v[:2] == fact[:2] and v[2] is not None and fact[2] is not None and v[2] <= fact[2]]
        last = max(mine, key=lambda v: (v[2], v[3] or date.max, v[4]), default=None)
        holds = last is not None and (last[3] is None or fact[2] < last[3])
        found.append((*fact, *(last[2:] if holds else (None,) * 5)))
    return Counter(found)


def made(seed):
    rnd = random.Random(seed)
    keys = [("a", 1), ("a", None), (None, 1), ("b", 2), ("c", 3)]
    day = lambda: MARCH + timedelta(days=rnd.randrange(-200, 200))
    facts = [(*rnd.choice(keys[:4]), rnd.choice([None, day(), day(), day()]), n % 50, "f", "r", "k") for n in range(400)]
    versions = []
    for key in keys:
        at = day()
        for n in range(rnd.randrange(1, 12)):
            end = rnd.choice([None, at + timedelta(days=rnd.randrange(0, 60))])
            versions.append((*key, rnd.choice([at, at, at, None]), end, f"v{n}", "s", "l"))
            at += timedelta(days=rnd.randrange(0, 80))
    return facts, versions


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(("every", "spread"), [("day", 1), ("month", 1), ("year", 7)])
def test_against_every_version(spark, seed, every, spread):
    facts, versions = made(seed)
    left, right = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    found = as_of_join(left, right, ["k", "j"], "date", every=every, spread=spread)
    assert found.columns == [*left.columns, "valid_from", "valid_to", "level", "state", "last"]
    assert Counter(tuple(row) for row in found.collect()) == plain(facts, versions)


def test_times_of_day_and_open_ends(spark):
    t = lambda hour: datetime(2021, 3, 1, hour)
    facts = spark.createDataFrame([("a", t(h)) for h in range(0, 24, 3)], "k string, at timestamp")
    versions = spark.createDataFrame([("a", t(6), "x"), ("a", t(13), "y")], "k string, since timestamp, v string")
    found = as_of_join(facts, versions, ["k"], "at", "since", None, every="day").sort("at").collect()
    assert [row.v for row in found] == [None, None, "x", "x", "x", "y", "y", "y"]


def test_no_versions_no_facts_and_names_that_clash(spark):
    facts = spark.createDataFrame([("a", 1, MARCH, 5, "f", "r", "k")], FACTS)
    versions = spark.createDataFrame([("a", 1, MARCH, None, "v", "s", "l")], VERSIONS)
    assert as_of_join(facts, versions.limit(0), ["k", "j"], "date").first().level is None
    assert as_of_join(facts.limit(0), versions, ["k", "j"], "date").collect() == []
    assert as_of_join(facts, versions, ["k", "j"], "date").first().level == "v"
    with pytest.raises(ValueError):
        as_of_join(facts, versions.withColumnRenamed("level", "n"), ["k", "j"], "date")
    with pytest.raises(ValueError):
        as_of_join(facts, versions, ["k", "j"], "date", every="century")


def test_no_join_at_all(spark, tmp_path):
    facts, versions = made(0)
    for name, rows, schema in (("f", facts, FACTS), ("v", versions, VERSIONS)):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
    plan = executed(as_of_join(spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "v")), ["k", "j"], "date"))
    assert "Join" not in plan and "Cartesian" not in plan


def test_a_hot_key_is_cut(spark):
    """A key with nearly all rows: no group of the ordered rows holds more than a small part of them."""
    facts = spark.range(40_000).selectExpr(
        "if(id % 50 = 0, 'b', 'a') as k", "date'2020-01-01' + cast(id % 720 as int) as date", "id as n"
    )
    versions = spark.createDataFrame([("a", date(2020, 1, 1), "x"), ("a", date(2021, 1, 1), "y")], "k string, since date, v string")
    found = as_of_join(facts, versions, ["k"], "date", "since", None, every="month", spread=4)
    assert found.count() == 40_000
    assert found.where("k = 'a' and v <> if(date < date'2021-01-01', 'x', 'y')").count() == 0
    assert found.where("k = 'b' and v is not null").count() == 0
