"""Features and fitting against plain forms, held-out quality, odd rows."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import toxicity
from tallyward.llm.queries import QUERIES


def plain_features(text: str) -> set:
    words = re.findall(r"[a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    found: set = {(w,) for w in words}
    found |= {(gap, a, b) for gap in (1, 2) for a, b in zip(words, words[gap:], strict=False)}
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB é1.", max_size=15), min_size=1, max_size=6))
def test_features_are_words_pairs_and_skip_pairs(texts):
    found = toxicity.features(pa.array(texts, pa.string()), 60)
    assert [len(f) for f in found] == [len(plain_features(t)) for t in texts]
    for f, a in zip(found, texts, strict=True):
        for g, b in zip(found, texts, strict=True):
            assert len(np.intersect1d(f, g)) == len(plain_features(a) & plain_features(b))


def plain_fit(examples, rate=3.0, l1=8.0, l2=0.1, rounds=5):
    """Coordinate by coordinate."""
    positive = sum(label for _, label in examples)
    heavier = math.sqrt((len(examples) - positive) / positive)
    z, n = {}, {}

    def weight(i):
        if i != "bias" and abs(z.get(i, 0)) <= l1:
            return 0.0
        pull = z.get(i, 0) - (0 if i == "bias" else math.copysign(l1, z.get(i, 0)))
        return -pull / ((1 + math.sqrt(n.get(i, 0))) / rate + l2)

    for _ in range(rounds):
        for found, label in examples:
            at = [*found, "bias"]
            now = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(now.values()))) - label
            g *= heavier if label else 1.0
            for i in at:
                before = n.get(i, 0)
                n[i] = before + g * g
                z[i] = z.get(i, 0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / rate * now[i]
    return {i: weight(i) for i in z if weight(i)}


def test_fit_is_that_of_the_plain_form():
    rng = np.random.default_rng(3)
    examples = []
    for _ in range(120):
        label = int(rng.random() < 0.3)
        found = sorted({int(x) for x in rng.integers(0, 30, 6)} | ({40} if label else {41}))
        examples.append((found, label))
    model = toxicity.fit([np.array(f) for f, _ in examples], np.array([y for _, y in examples]))
    expected = plain_fit(examples)
    assert math.isclose(model.bias, expected.pop("bias"), rel_tol=1e-9)
    assert dict(zip(model.places.tolist(), model.weights.round(9), strict=True)) == {i: round(w, 9) for i, w in sorted(expected.items())}


def test_held_out_quality(spark):
    directory = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{directory}/labels.parquet").collect()}
    found = QUERIES["op5_toxicity"](spark, directory).collect()
    assert len(found) == spark.read.parquet(f"{directory}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    unseen = [(labels[r.doc_id], r.predicted, r.score) for r in found if r.held_out and r.doc_id in labels]
    toxic = [x for x in unseen if x[0]]
    assert sum(x[1] for x in toxic) >= 0.8 * len(toxic)
    assert sum(x[0] == x[1] for x in unseen) >= 0.97 * len(unseen)


def test_nothing_of_a_held_out_row_is_learned(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = spark.createDataFrame([(i, "idiot") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in ids] + [(None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert not len(model.places) and toxicity.toxic_documents(docs, labels).where("predicted = 1").count() == 0


def test_odd_rows(spark):
    rows = [(i, "you nasty fool " + "x" * (i % 7), "c") for i in range(100)] + [(i, "a kind word " + "x" * (i % 5), "c") for i in range(100, 200)]
    rows += [(300, None, "c"), (301, "", "c"), (None, "nasty fool", "c"), (302, "kind " * 200_000, "c"), (5, "you nasty fool", "c"), (5, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    pairs = [(i, int(i < 100), 1) for i in range(200)] + [(5, 0, 1), (7, None, 1), (None, 1, 1), (999, 1, 1)]
    labels = spark.createDataFrame(pairs, "doc_id long, toxic int, text int")
    found = toxicity.toxic_documents(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.predicted for r in found if r.doc_id != 5}
    assert by_id[0] == by_id[None] == 1 and by_id[150] == by_id[302] == 0
    assert toxicity.toxic_documents(docs.where("false"), labels).count() == 0
    assert toxicity.toxic_documents(docs, labels.where("false")).where("score > 0.01").count() == 0
