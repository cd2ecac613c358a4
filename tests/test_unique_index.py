"""The index of keys: verdicts over increments, no exchange of what is stored, repeated and broken batches, other sessions."""

from __future__ import annotations

import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyward.operators.unique_index import KeyIndex
from tests.test_plans import executed

SCHEMA = "day date, code string, n int, known int"


@pytest.fixture
def index(spark, tmp_path):
    return KeyIndex(spark, f"keys_{uuid.uuid4().hex}", str(tmp_path / "index"), ["code", "n"], buckets=4)


def rows(spark, keys):
    return spark.createDataFrame([(None, code, n, 1) for code, n in keys], SCHEMA)


def add(index, spark, keys, batch):
    found = index.add(rows(spark, keys), batch)
    return (found.row_count, found.key_count, found.repeated, found.seen_before, found.passed)


def test_verdicts_over_increments(spark, index):
    rnd = random.Random(5)
    seen = set()
    for batch in range(4):
        keys = [(rnd.choice(["a", "b", None, ""]), rnd.choice([None, *range(12)])) for _ in range(25)]
        counts = Counter(keys)
        repeated, before = sum(n > 1 for n in counts.values()), len(seen & set(counts))
        assert add(index, spark, keys, batch) == (25, len(counts), repeated, before, not repeated and not before)
        failing = {(r.code, r.n, r.row_count, r.seen_before) for r in index.failures(batch).collect()}
        assert failing == {(*key, n, key in seen) for key, n in counts.items() if n > 1 or key in seen}
        test = index.test("t", batch).first()
        assert (test.test, test.column_name, test.failures) == ("unique_over_increments", "code, n", len(failing))
        seen |= set(counts)
    assert spark.table(index.name).where("not seen_before").count() == len(seen)


def test_a_batch_that_is_run_again_replaces_itself(spark, index):
    assert add(index, spark, [("a", 1), ("b", 1)], 0) == (2, 2, 0, 0, True)
    assert add(index, spark, [("b", 1), ("c", 1)], 1) == (2, 2, 0, 1, False)
    assert add(index, spark, [("b", 2), ("c", 1)], 1) == (2, 2, 0, 0, True)
    assert add(index, spark, [("a", 1)], 0) == (1, 1, 0, 0, True)
    assert add(index, spark, [], 1) == (0, 0, 0, 0, True)
    assert add(index, spark, [("b", 2), ("c", 1), ("a", 1)], 2) == (3, 3, 0, 1, False)


def test_only_the_new_rows_are_exchanged(spark, index):
    add(index, spark, [("a", n) for n in range(100)], 0)
    add(index, spark, [("b", n) for n in range(100)], 1)
    with index.settings():
        frame = index.checked(rows(spark, [("a", 5), ("c", 1)] * 20), 2)
        assert frame.where("seen_before").count() == 1
        plan = executed(frame)
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert "partial_count" in plan.replace("partial_count(1)", "partial_count")


def test_another_session_goes_on(spark, index):
    add(index, spark, [("a", 1), ("b", 1)], 0)
    spark.sql(f"DROP TABLE {index.name}")
    other = KeyIndex(spark, f"keys_{uuid.uuid4().hex}", index.path, ["code", "n"], buckets=4)
    assert add(other, spark, [("a", 1), ("c", 1)], 1) == (2, 2, 0, 1, False)


def test_compacted_keys_stay_known(spark, index, tmp_path):
    for batch in range(3):
        add(index, spark, [("a", 10 * batch + n) for n in range(10)] + [("b", 1)], batch)
    index.compact()
    table = spark.table(index.name)
    assert table.count() == 31 and table.select("batch").distinct().count() == 1
    assert table.select(F.input_file_name()).distinct().count() <= 4
    assert add(index, spark, [("a", 3), ("b", 1), ("z", 1)], 3) == (3, 3, 0, 2, False)
    other = KeyIndex(spark, f"keys_{uuid.uuid4().hex}", index.path, ["code", "n"], buckets=4)
    assert add(other, spark, [("a", 29), ("z", 1)], 4) == (2, 2, 0, 2, False)


def test_a_key_with_most_rows_is_combined_first(spark, index):
    many = spark.range(50_000).selectExpr("'a' as code", "cast(if(id % 100 = 0, id, 0) as int) as n")
    found = index.add(many, 0)
    assert (found.row_count, found.key_count, found.repeated) == (50_000, 500, 1)


def test_names_that_clash(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyIndex(spark, "keys", str(tmp_path), ["batch"])
