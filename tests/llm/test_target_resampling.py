"""Resampling: against SQL and the plain formulas; quickselect against sorting; ties, repeated and odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tallyward.llm import quickselect, target_resampling
from tallyward.llm.queries import QUERIES
from tests.compare import connect, differences

SCHEMA = "doc_id bigint, text string, row string, number string, score string, part string, buckets string"


def test_query_agrees_with_sql(spark):
    directory = "/root/testdata/sf0.001"
    found = QUERIES["op13_target_resampling"](spark, directory)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert differences(found, "op13_target_resampling", connect(directory)) is None


@pytest.mark.parametrize("text", ["", "Ünder_score AB9 c-d\x00e\x7ff", "a  b\tc", "日本 ÀÉ 'x' 12.5", "ß ß   z", None])
def test_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    expected = [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)]
    assert target_resampling.words_of(None if text is None else text.encode()) == expected


def test_features_are_runs_of_words():
    words = [b"a", b"b", b"c"]
    assert target_resampling.features_of(words) == words
    assert Counter(target_resampling.features_of(words, 3)) == Counter([*words, b"a b", b"b c", b"a b c"])
    assert target_resampling.features_of([], 2) == []


def plain(docs, target, percent=10, least=20, buckets=10_000, longest=1):
    """The formulas, document by document: {position: (doc_id, n, weight, score)} and the ids drawn, in order."""

    def bucketed(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(run.encode()) % buckets for run in runs]

    arrays = [bucketed(text) for _, text in docs]
    own, aim = Counter(b for _, a in arrays for b in a), Counter(b for text in target for b in bucketed(text)[1])
    s, t = sum(own.values()), sum(aim.values())
    rows = []
    for (doc_id, _), (n_words, a) in zip(docs, arrays, strict=True):
        gains = [math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets)))) for b in a]
        weight = sum(gains) // len(a) if a else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, n_words, len(a), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = order[: len(order) * percent // 100]
    return Counter((r[0], *r[2:]) for r in rows), [(r[0], *r[2:]) for r in drawn]


def check(found, docs, target, **settings):
    rows, drawn = plain(docs, target, **settings)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in found) == rows
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.n_features, r.weight, r.score) for r in ranked] == drawn


def made(n, seed):
    rnd = random.Random(seed)
    return [(i, " ".join(rnd.choices(["the", "of", "Rare", "é", "x9", "zz"], k=rnd.randrange(15, 40)))) for i in range(n)]


def frame(spark, docs):
    return spark.createDataFrame([(i, text, "r", "n", "s", "p", "b") for i, text in docs], SCHEMA)


@pytest.mark.parametrize("settings", [{}, {"percent": 50, "least": 1}, {"longest": 2, "buckets": 97}])
def test_draw_follows_the_formulas(spark, settings):
    docs, target = made(300, 1), ["the rare rare", "zz"]
    named = {"least": "least_words"}
    wanted = spark.createDataFrame([(text,) for text in target], "text string")
    found = target_resampling.resample(frame(spark, docs), wanted, **{named.get(k, k): v for k, v in settings.items()}).collect()
    check(found, docs, target, **settings)


def test_odd_rows(spark):
    many = "word " * 30
    docs = [(1, many)] * 40 + [(None, many)] * 3 + [(7, None), (8, ""), (9, " \t!?"), (10, "w" * 3_000_000), (11, "a " * 300_000)]
    docs += [(12, many + "other"), (13, "é " * 19), (14, "é " * 20)]
    benchmark = spark.createDataFrame([(None,), ("word",)], "text string")
    found = target_resampling.resample(frame(spark, docs), benchmark, percent=40, carry=["text", "row", "number"]).collect()
    check(found, docs, [None, "word"], percent=40)
    assert all(r.row.row == "r" and r.row.number == "n" for r in found)
    assert Counter((r.doc_id, r.row.text) for r in found) == Counter(docs)
    nothing = target_resampling.resample(frame(spark, docs).limit(0), benchmark)
    assert nothing.collect() == []
    without_target = target_resampling.resampled_documents(frame(spark, docs), benchmark.limit(0)).collect()
    check(without_target, docs, [])
    short = target_resampling.resampled_documents(frame(spark, docs[43:46]), benchmark).collect()
    assert [r["rank"] for r in short] == [None] * 3


@pytest.mark.parametrize("pivots", [1, 2, 31])
def test_quickselect(spark, pivots):
    rnd = random.Random(pivots)
    values = [(rnd.randrange(-20, 20), rnd.randrange(5)) for _ in range(200)]
    rows = spark.createDataFrame(values, "a bigint, b bigint")
    for k in (1, 77, 200):
        assert tuple(quickselect.kth_key(rows, ["a", "b"], k, pivots=pivots)) == sorted(values)[k - 1]
    same = spark.range(500).selectExpr("1L as a", "2L as b")
    assert tuple(quickselect.kth_key(same, ["a", "b"], 400)) == (1, 2)
    for k in (0, 201):
        with pytest.raises(ValueError):
            quickselect.kth_key(rows, ["a", "b"], k)


def test_counts_are_three_way(spark):
    rows = spark.createDataFrame([(i // 2,) for i in range(20)], "a bigint")
    pivots = rows.where("a in (3, 7)").distinct().orderBy("a").collect()
    assert quickselect.partition_counts(rows, ["a"], pivots) == [6, 2, 6, 2, 4]
