"""Packing: exact round trip, mixture of the windows, the layout against a round-robin that is run step by step."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm import packing
from tallyward.llm.queries import QUERIES

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected_ids(text: str | None) -> list[int]:
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("text", ["", None, "a" * 5000, " \n\t  x", "<|endoftext|> and <|endo", "日本 é 😀 12,5", "it's we'LL", " 　"])
def test_ids_equal_those_of_the_tokenizer(text):
    assert packing.token_ids(text).tolist() == expected_ids(text)


def step_by_step(totals: list[int], window: int, quantum: int) -> list[tuple[int, int]]:
    """(queue, token) of the stream, by counters of what each queue has earned and given."""
    stream, given, total = [], [0] * len(totals), sum(totals)
    rounds = -(-total // window)
    for r in range(1, rounds + 1):
        for q, size in enumerate(totals):
            earned = r * window * size / total
            upto = size if r == rounds or earned >= size else int(earned / quantum + 1e-9) * quantum
            stream += [(q, t) for t in range(given[q], upto)]
            given[q] = upto
    return stream


@settings(max_examples=300, deadline=None)
@example([145] * 5, (64, 8))  # five rounds earn 64 exactly
@given(st.lists(st.integers(0, 900), min_size=1, max_size=6).filter(sum), st.sampled_from([(64, 8), (32, 32), (128, 1)]))
def test_layout_is_that_of_the_round_robin(totals, sizes):
    window, quantum = sizes
    rounds = packing.Rounds([*totals, 0], None, window, quantum)
    stream = step_by_step([*totals, 0], window, quantum)
    place_of = {token: i for i, token in enumerate(stream)}
    queues, at, n = [], [], []
    for q, size in enumerate(totals):
        cuts = sorted({0, size, size // 3, size // 2})
        for low, high in zip(cuts, cuts[1:], strict=False):
            queues.append(q), at.append(low), n.append(high - low)
    row, start, length, sequence, offset = packing.place(rounds, np.array(queues), np.array(at), np.array(n), window)
    for r, s, count, seq, off in zip(row, start, length, sequence, offset, strict=True):
        for i in range(count):
            assert place_of[(queues[r], at[r] + s + i)] == seq * window + off + i
    assert length.sum() == sum(totals)


def test_other_weights_hold_until_a_source_is_empty():
    rounds = packing.Rounds([10_000, 1_000], [1.0, 1.0], 100, 10)
    assert rounds.before(0, np.array([10]))[0] == rounds.before(1, np.array([10]))[0] == 500
    assert rounds.before(1, np.array([20]))[0] == 1000
    assert rounds.before(0, np.array([21]))[0] - rounds.before(0, np.array([20]))[0] == 100
    with pytest.raises(ValueError):
        packing.Rounds([5, 5], [1.0, 0.0])


def check(pieces, docs, window=2048):
    """Each id in exactly one piece, sequences without gaps, all full but the last, checksums of the ids."""
    ids = {i: expected_ids(text) for i, text in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append((p.start, p.length))
        by_sequence[p.sequence_id].append((p.offset, p.length))
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes())
    for doc_id, tokens in ids.items():
        at = 0
        for start, length in sorted(by_doc[doc_id]):
            assert start == at and length > 0
            at += length
        assert at == len(tokens)
    for number, parts in by_sequence.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or number == max(by_sequence) and at <= window
    assert set(by_sequence) == set(range(max(by_sequence) + 1))


def test_query_over_whole_table(spark):
    directory = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    pieces = QUERIES["op2_packing"](spark, directory).collect()
    check(pieces, [(r.doc_id, r.text) for r in docs.collect()])
    # Every window but the last has each source's share, up to a quantum and the neighbouring round's.
    source = {r.doc_id: r.source for r in docs.collect()}
    share, got = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for p in pieces:
        share[source[p.doc_id]] += p.length
        got[p.sequence_id][source[p.doc_id]] += p.length
    total = sum(share.values())
    for name, tokens in share.items():
        carried = 0.0
        for number in range(max(got)):
            carried += got[number][name] - 2048 * tokens / total
            assert abs(carried) <= 2048 * tokens / total + 2 * packing.QUANTUM + 64


def test_odd_rows_and_sequences(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "x " * 6000, None), (4, "y", "a"), (5, "y", "a"), (6, "<|endoftext|>", "b")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, start string")
    pieces = packing.pack(docs.repartition(3), with_ids=True)
    check(pieces.collect(), [r[:2] for r in rows])
    whole = packing.sequences(pieces).orderBy("sequence_id").collect()
    stream = np.concatenate([np.frombuffer(bytes(r.ids), "<u2") for r in whole])
    assert sorted(stream.tolist()) == sorted(sum((expected_ids(r[1]) for r in rows), []))
    assert packing.pack(docs.where("false")).count() == 0
    unknown = docs.select(F.lit(None).cast("bigint").alias("doc_id"), "text", "source")
    assert packing.pack(unknown).agg(F.sum("length")).first()[0] == len(stream)


def test_many_sources_share_a_queue(spark, monkeypatch):
    monkeypatch.setattr(packing, "QUEUES", 3)
    rows = [(i, "word " * (i + 1), f"s{i % 9}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(packing.pack(docs, window=256).collect(), [r[:2] for r in rows], 256)


def test_a_thousand_sources_keep_their_weights(spark):
    rows = [(i, "word " * 150, f"s{i % 1000:04}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {f"s{i:04}": 1.0 + i % 3 for i in range(1000)}
    pieces = packing.pack(docs, weights, quantum=8).collect()
    check(pieces, [r[:2] for r in rows])
    # Until the first sources are empty each class of weights has its share of the stream.
    total = sum(p.length for p in pieces)
    got: dict = defaultdict(int)
    for p in pieces:
        if p.sequence_id * 2048 < total // 2:
            got[1 + p.doc_id % 1000 % 3] += p.length
    first = sum(got.values())
    whole = sum(weights.values())
    for weight, tokens in got.items():
        share = sum(w for w in weights.values() if w == weight) / whole
        assert abs(tokens / first - share) < 0.03


def test_weights_that_could_not_hold_are_refused(spark, monkeypatch):
    monkeypatch.setattr(packing, "QUEUES", 3)
    docs = spark.createDataFrame([(i, "word", f"s{i}") for i in range(4)], "doc_id long, text string, source string")
    with pytest.raises(ValueError, match="sources"):
        packing.pack(docs, {f"s{i}": 1.0 for i in range(4)})
    assert packing.pack(docs.where("doc_id < 3"), {f"s{i}": 1.0 for i in range(3)}).count() == 3


def test_ids_are_not_exchanged(spark):
    docs = spark.createDataFrame([(i, "word " * i, f"s{i % 3}") for i in range(50)], "doc_id long, text string, source string")
    plan = packing.pack(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
