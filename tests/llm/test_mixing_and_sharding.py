"""Mixing and sharding against plain versions and SQL, odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tallyward.llm import mixing, sharding
from tests.compare import connect, differences


@pytest.mark.parametrize("name", ["op1_exact_search", "op7_mixing", "op8_sharding"])
def test_queries_against_their_statements(spark, name):
    directory = "/root/testdata/sf0.001"
    assert differences(entry_points.queries()[name](spark, directory), name, connect(directory)) is None


def test_the_mix_runs_no_python(spark):
    frame = entry_points.queries()["op7_mixing"](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def words(text: str | None) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes: dict) -> dict:
    """Shared out again and again, as long as a target is above what its source can give."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {name: 1 + i % 3 for i, name in enumerate(names)}
    full: set = set()
    total = sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[n] for n in full)
        sharing = sum(weight[n] for n in names if n not in full)
        share = {n: 3 * sizes[n] if n in full else left * weight[n] / sharing for n in names}
        above = {n for n in names if share[n] > 3 * sizes[n]}
        if not above - full:
            return share
        full |= above


CASES = [
    [(i, "w " * (5 + i % 7), f"s{i % 4}") for i in range(200)] + [(900 + i, "w " * 900, "hot") for i in range(20)] + [(1000, "one two", "tiny")],
    [(1, "a b c", None), (2, None, None), (3, "", "x"), (None, "a b", "x"), (4, "a b", "x"), (4, "a b", "x"), (5, "w " * 50_000, "long")],
    [(1, None, "a"), (2, " \t", None)],
    [],
    [(1, "word", "a")],
]


@pytest.mark.parametrize("rows", CASES)
def test_mix_meets_its_targets(spark, rows):
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, size int")
    found = mixing.mix_documents(docs).collect()
    sizes: dict = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
    targets = plain_targets(sizes)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in found) == Counter(
        (i, words(text), sizes[source], round(targets[source], 6)) for i, text, source in rows
    )
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    source_of = {(r[0], words(r[1])): r[2] for r in rows}
    got: dict = defaultdict(int)
    for r in found:
        got[source_of[r.doc_id, r.size]] += r.taken
    assert {s: got[s] for s in sizes} == {s: int(targets[s] + 1e-9) for s in sizes}
    again = mixing.mix_documents(docs).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_schedule_is_even(spark):
    """Each tenth of the schedule is close to the targets, and no word of a source is skipped or doubled within a round."""
    rows = [(i, "w " * (20 + i % 9), f"s{i % 5}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    frames = mixing.mix(mixing.counted(docs), "_words", identity=("doc_id", "_digest"), carry=("source", "doc_id"))
    targets = {r.source: r.target for r in frames[0].select("row.source", "target").distinct().collect()}
    total = sum(targets.values())
    source = {r.row_id: r.source for r in frames[0].select("row_id", "row.source").collect()}
    pieces = frames[1].collect()
    slots = max(p.slot for p in pieces) + 1
    shares: dict = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        shares[p.slot * 10 // slots][source[p.row_id]] += p.length
    for tenth in shares.values():
        for name, target in targets.items():
            assert abs(tenth[name] - target / 10) <= 0.25 * target / 10 + 64, (name, total)
    used: dict = defaultdict(Counter)
    for p in pieces:
        used[p.row_id].update(range(p.start, p.start + p.length))
    for name in targets:
        counts = {n for row, c in used.items() if source[row] == name for n in c.values()}
        assert max(counts) - min(counts) <= 1


@pytest.mark.parametrize(("sources", "size"), [(4, 5), (1000, 20)])
def test_sources_of_few_words_are_all_met(spark, sources, size):
    docs = spark.createDataFrame([(i, "w " * size, f"s{i:04}") for i in range(sources)], "doc_id long, text string, source string")
    found = mixing.mix_documents(docs).collect()
    targets = plain_targets({f"s{i:04}": size for i in range(sources)})
    assert {r.doc_id: r.taken for r in found} == {i: int(targets[f"s{i:04}"] + 1e-9) for i in range(sources)}


@pytest.mark.parametrize("count", [1, 2, 5, 1000, 2**20, 3 * 2**20, 2**22])
def test_points_leave_no_gap_of_three_blocks(count):
    points = np.sort(np.arange(count) * mixing.GOLDEN % mixing.POINTS)
    assert np.diff(points, append=mixing.POINTS).max() * count <= 2 * mixing.POINTS


def test_documents_of_the_mix(spark):
    docs = spark.createDataFrame(CASES[0], "doc_id long, text string, source string").withColumn("extra", F.lit(1))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    expected: Counter = Counter()
    copies: Counter = Counter()
    for r in mixing.mix_documents(docs).collect():
        expected[r.doc_id] += r.taken
        copies[r.doc_id] += -(-r.taken // r.size) if r.size else 0
    got: Counter = Counter()
    for r in mixed.collect():
        got[r.doc_id] += words(r.text)
    assert Counter(r.doc_id for r in mixed.collect()) == +copies and got == +expected


def test_a_source_of_one_long_document_stays(spark):
    """Its target is below half of the document."""
    rows = [(0, "w " * 1200, "a"), *((i, "w " * 10, "bc"[i % 2]) for i in range(1, 201))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert 0 < next(r.taken for r in mixing.mix_documents(docs).collect() if r.doc_id == 0) < 600
    assert [r.doc_id for r in mixing.mixed_documents(docs).collect() if r.source == "a"] == [0]


def test_documents_come_in_the_order_of_the_mix(spark):
    docs = spark.createDataFrame([(i, "w " * (20 + i % 9), f"s{i % 5}") for i in range(500)], "doc_id long, text string, source string")
    frame, mixed = mixing.mix(mixing.counted(docs), "_words", identity=("doc_id", "_digest"), carry=("doc_id",))
    doc = {r.row_id: (r.doc_id, r.size) for r in frame.select("row_id", "row.doc_id", "size").collect()}
    pieces: dict = defaultdict(list)
    for p in mixed.collect():
        pieces[p.row_id, p["round"]].append((p.slot, p.length))
    fine = sorted(pieces, key=lambda key: (min(pieces[key])[0], *key))
    found = mixing.mixed_documents(docs).collect()
    assert [r.doc_id for r in found] == [doc[row][0] for row, _ in fine]
    assert [words(r.text) for r in found] == [sum(n for _, n in pieces[key]) for key in fine]
    unordered = mixing.mixed_documents(docs, ordered=False)
    assert Counter(map(tuple, unordered.collect())) == Counter(map(tuple, found))
    assert "rangepartitioning" not in unordered._jdf.queryExecution().executedPlan().toString()


def test_a_document_is_cut_behind_a_word(spark):
    texts = ["  a  bb\tccc\n d ", "one", "é ß　x y", "a" * 50]
    frame = spark.createDataFrame([(t, n) for t in texts for n in range(1, 1 + words(t))], "t string, n bigint")
    for r in frame.select("t", "n", mixing.first_words(F.col("t"), F.col("n")).alias("cut")).collect():
        assert r.t.startswith(r.cut) and words(r.cut) == r.n and not r.cut[-1:].isspace()


@pytest.mark.parametrize(("sources", "size"), [(4, 5), (60, 20)])
def test_the_statement_takes_from_sources_of_few_words(spark, tmp_path, sources, size):
    rows = [(i, "w " * size, f"s{i:04}") for i in range(sources)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents/*.parquet')")
    found = mixing.mix_documents(docs)
    expected = connection.execute(mixing.MIX_SQL).fetchall()
    assert Counter(map(tuple, found.collect())) == Counter(expected)


def plain_shards(rows, shards):
    """Sort by fractional rank and cut into equal counts."""

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    by_source: dict = defaultdict(list)
    for i, text, source in rows:
        key = md5("shards:" + md5("" if i is None else str(i)) + md5(md5(text or "")))
        by_source[source].append((key, i, text))
    line = []
    for source, own in by_source.items():
        for rank, (key, i, text) in enumerate(sorted(own, key=lambda x: x[0])):
            line.append(((rank + 0.5) / len(own), source is None, source or "", key, i, text))
    line.sort(key=lambda x: x[:4])
    cuts = [i * len(line) // shards for i in range(shards + 1)]
    out = Counter()
    for shard, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        for slot, (*_, i, text) in enumerate(line[low:high]):
            body = (text or "").encode()
            out[i, len(body) + 1, zlib.crc32(body), shard, slot] += 1
    return out


@pytest.mark.parametrize("rows", CASES)
def test_shards_against_a_plain_version(spark, rows):
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, shard int")
    found = sharding.shard_documents(docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found) == plain_shards(rows, 16)
    assert {(r.law, r.grown_shard) for r in found} <= {("rows", None)}


def test_each_shard_has_the_mixture(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    lined = sharding.interleave(docs, 8, carry=("source",)).groupBy("shard", "row.source").count().collect()
    whole = Counter(r[2] for r in rows)
    assert all(abs(r["count"] - whole[r.source] / 8) <= 2 for r in lined)


def test_written_shards_hold_whole_rows(spark, tmp_path):
    docs = spark.createDataFrame(CASES[0], "doc_id long, text string, source string")
    sharding.write_shards(docs, str(tmp_path / "shards"), 4, rows_per_file=20)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter(map(tuple, back.select("row.*").collect())) == Counter(CASES[0])
    assert {r["shard"]: r["n"] for r in back.groupBy("shard").agg(F.count("slot").alias("n")).collect()} == {0: 55, 1: 55, 2: 55, 3: 56}
