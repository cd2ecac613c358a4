"""Groups against a comparison of all pairs, signatures, components, odd rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import near_duplicates
from tallyward.llm.components import components
from tallyward.llm.queries import QUERIES
from tallyward.llm.shingles import shingle_sets
from tallyward.llm.superminhash import lanes, signatures
from tests.compare import connect, differences


def plain_set(text: str | None, words: int) -> frozenset:
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def plain_groups(docs: list[tuple[int, str | None]], words: int) -> dict[int, tuple[int, int]]:
    """Size of the set and least id of the component, by comparing every pair that shares a shingle."""
    sets = {i: plain_set(text, words) for i, text in docs}
    root = {i: i for i in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    by_shingle: dict = {}
    for i, own in sets.items():
        for shingle in own:
            by_shingle.setdefault(shingle, []).append(i)
    for a, own in sets.items():
        shared: dict[int, int] = {}
        for shingle in own:
            for b in by_shingle[shingle]:
                if b < a:
                    shared[b] = shared.get(b, 0) + 1
        for b, common in shared.items():
            if 100 * common >= 80 * (len(own) + len(sets[b]) - common):
                first, second = sorted((find(a), find(b)))
                root[second] = first
    return {i: (len(own), find(i)) for i, own in sets.items()}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB é\t\x0b日", max_size=20)), min_size=1, max_size=8), st.integers(1, 4))
def test_shingles_are_those_of_the_words(texts, words):
    elements, offsets = shingle_sets(pa.array(texts, pa.string()), words)
    for i, text in enumerate(texts):
        own = elements[offsets[i] : offsets[i + 1]]
        assert len(own) == len(set(own.tolist())) == len(plain_set(text, words))
        assert (np.diff(own.astype(object)) > 0).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("aB \n", max_size=8), min_size=2, max_size=8))
def test_equal_sets_have_equal_shingles(texts):
    elements, offsets = shingle_sets(pa.array(texts, pa.string()), 2)
    hashed = [tuple(elements[offsets[i] : offsets[i + 1]].tolist()) for i in range(len(texts))]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (hashed[i] == hashed[j]) == (plain_set(a, 2) == plain_set(b, 2))


def plain_signature(elements: np.ndarray, size: int) -> list[int]:
    """Element by element, with a list that is shuffled from the front."""
    from tallyward.llm.shingles import mix

    out = [2**64 - 1] * size
    for element in elements:
        places = list(range(size))
        for step in range(size):
            random_number = int(mix(np.array([element], np.uint64), 100 + step)[0])
            chosen = step + ((random_number >> 32) * (size - step) >> 32)
            places[step], places[chosen] = places[chosen], places[step]
            out[places[step]] = min(out[places[step]], (step << 32) | (random_number & 0xFFFFFFFF))
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**63), unique=True, max_size=30), min_size=1, max_size=4))
def test_signatures_are_those_of_the_plain_form(sets):
    elements = np.array([x for s in sets for x in s], np.uint64)
    offsets = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int64)
    found = signatures(elements, offsets, 16)
    for row, own in zip(found, sets, strict=True):
        assert row.tolist() == plain_signature(np.array(own, np.uint64), 16)


def test_estimates_have_less_variance_than_independent_ones():
    rng, errors = np.random.default_rng(1), []
    for _ in range(300):
        both = rng.integers(0, 2**63, 110).astype(np.uint64)
        pair = signatures(np.concatenate([both[:100], both[10:]]), np.array([0, 100, 200]), 128)
        agree = (lanes(pair)[0] == lanes(pair)[1]).mean()
        errors.append(agree - 90 / 110)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.85 * np.sqrt(90 / 110 * 20 / 110 / 128)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1080)] + [(2000 + i, 2000) for i in range(90)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        first, second = sorted((find(a), find(b)))
        root[second] = first
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: find(x) for x in touched}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def as_rows(frame) -> dict:
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_query_over_whole_table(spark):
    directory = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{directory}/documents.parquet").collect()]
    found = QUERIES["op9_near_duplicates"](spark, directory).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == plain_groups(docs, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def variants(rng: random.Random, base: list[str], count: int, edits: int) -> list[str]:
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_large_groups_lose_no_link(spark, monkeypatch):
    """Near copies around the threshold, in groups larger than a cell."""
    monkeypatch.setattr(near_duplicates, "SIGNATURE_CELL", 16)
    monkeypatch.setattr(near_duplicates, "TEXT_CELL", 8)
    monkeypatch.setattr(near_duplicates, "BROADCAST_ROWS", 0)
    rng, texts = random.Random(5), []
    for group, edits in enumerate((3, 8, 12, 20, 30)):
        texts += variants(rng, [f"g{group}x{i}" for i in range(80)], 60, edits)
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert as_rows(near_duplicates.duplicate_groups(frame, 2)) == plain_groups(docs, 2)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, long), (7, long + " x"), (8, "a b c"), (8, "a b c"), (9, "b c a"), (10, "É é")]
    rows += [(i, "same text here") for i in range(20, 60)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n string")
    found = near_duplicates.duplicate_groups(docs, 2)
    assert as_rows(found) == plain_groups(rows, 2)
    assert found.count() == len(rows)
    assert near_duplicates.duplicate_groups(docs.where("false"), 2).count() == 0
    unknown = spark.createDataFrame([(None, "a b c"), (None, "x y z"), (5, "a b c"), (None, None)], "doc_id long, text string")
    named = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates.duplicate_groups(unknown, 2).collect()}
    assert named == {(None, 5, False), (None, None, True), (5, 5, True)}


def test_longer_shingles(spark):
    docs = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i k"), (3, "a b c d"), (4, "a B c d"), (5, "a b c")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert as_rows(near_duplicates.duplicate_groups(frame)) == plain_groups(docs, 5)


def test_query_agrees_with_its_statement(spark):
    directory = "/root/testdata/sf0.001"
    assert differences(QUERIES["op9_near_duplicates"](spark, directory), "op9_near_duplicates", connect(directory)) is None
