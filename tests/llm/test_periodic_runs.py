"""Runs: against the definition, word by word; the texts left over; odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import periodic_runs
from tallyward.llm.queries import QUERIES


def plain_runs(words, least_length=24, least_power=3):
    """By the definition: every stretch of every period, without those that have a smaller one."""
    found = []
    for q in range(1, len(words) // least_power + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            part = words[start : i + q]
            smaller = any(all(a == b for a, b in zip(part, part[d:], strict=False)) for d in range(1, q))
            if len(part) >= max(least_length, least_power * q) and not smaller:
                found.append((start, len(part), q))
    return sorted(found)


@st.composite
def repetitive(draw):
    """Words of a small vocabulary with some stretches repeated."""
    words = []
    for _ in range(draw(st.integers(1, 4))):
        part = draw(st.lists(st.integers(0, 3), min_size=1, max_size=12))
        words += part * draw(st.integers(1, 6)) + part[: draw(st.integers(0, len(part)))]
    return words


@settings(max_examples=400, deadline=None)
@given(repetitive(), st.sampled_from([(24, 3), (6, 3), (1, 2), (9, 4), (5, 2)]))
def test_runs_are_those_of_the_definition(words, limits):
    assert periodic_runs.runs(words, *limits) == plain_runs(words, *limits)
    as_bytes = [str(word).encode() for word in words]
    assert periodic_runs.runs_of_words(as_bytes, *limits) == plain_runs(words, *limits)


@settings(max_examples=200, deadline=None)
@given(repetitive())
def test_each_recolouring_is_the_longest_agreement_with_a_last_occurrence(words):
    for end, before, longest in periodic_runs.recolourings(words):
        assert words[end - longest : end] == words[before - longest : before]
        further = end - longest - 1
        assert before == longest or words[further] != words[before - longest - 1]


def test_stretches_leave_out_only_words_without_a_run():
    words = np.array([*range(100), *[1007, 1008, 1009, 1010] * 10, *range(200, 300), *range(200, 230)])
    assert periodic_runs.stretches(words) == [(100, 140), (140, 170), (240, 270)]
    assert periodic_runs.stretches(np.arange(1000)) == []
    assert periodic_runs.stretches(np.arange(5)) == []


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0 and n:
        a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    rest = " ".join(word for i, word in enumerate(words) if i not in gone)
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    best = (None,) * 3
    for run in found:
        if best[0] is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())


def test_query_agrees_with_the_definition(spark):
    directory = "/root/testdata/sf0.001"
    found = {row.doc_id: tuple(row) for row in QUERIES["op11_periodic_runs"](spark, directory).collect()}
    docs = spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    short = [row for row in docs if len((row.text or "").split()) < 2000]
    assert len(short) > 0.9 * len(docs)
    for row in short:
        assert found[row.doc_id] == expected(row.doc_id, row.text)
    assert sum(row[1] > 0 for row in found.values()) >= 10


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, runs string, _words string, key string"
    planted = next(i for i in range(100, 1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    long = next(i for i in range(100, 1000) if zlib.crc32(str(i).encode()) % 10)
    texts = [
        (planted, "one two three four five six seven eight nine ten " * 9),
        (planted, "one two three four five six seven eight nine ten " * 9),
        (planted, ""),
        (planted, None),
        (None, "a b " * 30),
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (4, "x y z " * 30),
        (5, "é É " * 40 + "end"),
        (long, ("word " * 50_000) + "other " * 50_000),
        (7, "w" * 2_000_000),
        (8, "a b c " * 8),
    ]
    docs = spark.createDataFrame([(i, text, "r", "w", "k") for i, text in texts], schema)
    found = sorted((tuple(row) for row in periodic_runs.run_documents(docs).collect()), key=str)
    assert [row for row in found if row[0] != long] == sorted((expected(i, t) for i, t in texts if i != long), key=str)
    (two,) = [row for row in found if row[0] == long]
    assert two[1:6] == (2, 0, 50_000, 1, 50_000_000)
    assert periodic_runs.run_documents(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, least_power=1)


def test_operator_returns_runs_and_rest(spark):
    docs = spark.createDataFrame([("a", "x " + "la li " * 6 + "y")], "name string, body string")
    (row,) = periodic_runs.find_runs(docs, "name", "body", least_length=6).collect()
    assert row.name == "a" and row.n_words == 14 and row.collapsed == "x la li y"
    assert [tuple(run) for run in row.runs] == [(1, 12, 2)]
