"""Mixture-controlled packing: deficit round-robin over source queues into windows of one sequence each.

In each round every source queue earns its share of the window and gives what it has earned, in quanta; what is short of a quantum
stays as its deficit for the next rounds. The tokens of all rounds in order are the stream that is cut into sequences, so only the last
sequence has padding. Since the earnings are linear in the round, the place of a token follows from its place in its queue and the
totals of the queues: tasks need no state of each other, and deficits carry over windows and partitions alike.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import pieces_of, stored, with_running_total

WINDOW = 2048
QUANTUM = 64
# The largest sources have queues of their own, all others share one more.
QUEUES = 1024
# Quanta of all queues that are placed at once.
PLACED = 1 << 20
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
END = 1
PIECE_BYTES = 1 << 20


@functools.cache
def encoder(vocabulary: str) -> tiktoken.Encoding:
    """The byte-level vocabulary in the form that encodes fastest; ids equal those of its other forms."""
    with open(public_tokenizers.path(vocabulary)) as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(str.split, lines)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The ids of a text (none for a missing one) and the one that ends a document."""
    ids = encoder(vocabulary).encode_to_numpy(text or "", allowed_special="all")
    return np.append(ids, END).astype("<u2")


TOKENS = "part int, slot int, source string, doc_id bigint, before bigint, n bigint, ids binary"


def tokenized(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Ids of each document (16 bits each), and its place among the tokens that its task has seen of its source."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[str | None, list[int]] = {}
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            rows = []
            sources, texts = batch.column("source").to_pylist(), batch.column("text")
            for source, doc_id, text in zip(sources, batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = token_ids(text.as_py(), vocabulary)
                state = seen.setdefault(source, [len(seen), 0])
                rows.append((part, state[0], source, doc_id, state[1], len(ids), ids.tobytes()))
                state[1] += len(ids)
            types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ("part", "slot", "source", "doc_id", "before", "n", "ids")
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    texts = docs.select(
        F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.col("text").cast("string")
    )
    return texts.mapInArrow(encode, TOKENS)


class Rounds:
    """How many tokens each queue has given before each round, for totals and weights of the queues.

    By default the weights are the totals: all queues end together. With other weights a queue that is empty drops out and the
    others share its part. ``times`` and ``given`` are the corners of the lines that the queues' earnings follow.
    """

    def __init__(self, totals: list[int], weights: list[float] | None = None, window: int = WINDOW, quantum: int = QUANTUM):
        self.totals = np.array(totals, float)
        self.quantum = quantum
        left, earned = self.totals.copy(), np.zeros(len(totals))
        share = np.array(totals if weights is None else weights, float)
        if (share[self.totals > 0] <= 0).any():
            raise ValueError("a source with tokens needs a weight above 0")
        times, given = [0.0], [earned.copy()]
        while (left > 0).any():
            speed = np.where(left > 0, share, 0)
            speed *= window / speed.sum()
            lasts = np.min(left[left > 0] / speed[left > 0])
            ended = (left > 0) & (left <= speed * lasts * (1 + 1e-12))
            left = np.where(ended, 0, left - speed * lasts).clip(min=0)
            earned = self.totals - left
            times.append(times[-1] + lasts)
            given.append(earned.copy())
        self.times, self.corners = np.array(times), np.array(given)
        self.rounds = int(np.ceil(self.times[-1]))

    def before(self, queue: int, rounds: np.ndarray) -> np.ndarray:
        """Tokens that the queue has given before each of the rounds: whole quanta, or all it has.

        What is a whole quantum but for the rounding of the arithmetic counts as one.
        """
        total = self.totals[queue]
        earned = np.interp(rounds, self.times, self.corners[:, queue])
        whole = np.floor(earned / self.quantum + 1e-9) * self.quantum
        return np.where((earned >= total) | (rounds >= self.rounds), total, whole).astype(np.int64)

    def round_of(self, queue: int, tokens: np.ndarray) -> np.ndarray:
        """The round in which the queue gives each of the tokens (numbered from 0)."""
        wanted = np.minimum((tokens // self.quantum + 1) * self.quantum, self.totals[queue])
        rounds = np.ceil(np.interp(wanted, self.corners[:, queue], self.times)).astype(np.int64) - 1
        rounds = rounds.clip(0, max(self.rounds - 1, 0))
        while (late := self.before(queue, rounds + 1) <= tokens).any():
            rounds += late
        while (early := self.before(queue, rounds) > tokens).any():
            rounds -= early
        return rounds


def place(rounds: Rounds, queues: np.ndarray, at: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Cut documents at their places ``at`` in their queues: row number, start, length, sequence and offset of each piece."""
    quantum = rounds.quantum
    first, last = at // quantum, (at + n - 1) // quantum
    row = np.repeat(np.arange(len(at)), last - first + 1)
    number = np.arange(len(row)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1)
    begin = np.maximum((first[row] + number) * quantum, at[row])
    turn = np.empty(len(row), np.int64)
    for queue in np.unique(queues):
        mine = queues[row] == queue
        turn[mine] = rounds.round_of(queue, begin[mine])
    # Quanta that a document gives in the same round are one piece.
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (turn[1:] != turn[:-1])
    row, begin, turn = row[new], begin[new], turn[new]
    end = (at + n)[row]
    follows = row[1:] == row[:-1]
    end[:-1][follows] = begin[1:][follows]

    position = np.empty(len(row), np.int64)
    distinct, index = np.unique(turn, return_inverse=True)
    step = max(1, PLACED // len(rounds.totals))
    for low in range(0, len(distinct), step):
        some = distinct[low : low + step]
        before = np.stack([rounds.before(q, some) for q in range(len(rounds.totals))], axis=1)
        after = np.stack([rounds.before(q, some + 1) for q in range(len(rounds.totals))], axis=1)
        quota = after - before
        # The round starts after all that was given before it; in it the queues follow each other.
        origin = before.sum(axis=1)[:, None] + np.cumsum(quota, axis=1) - quota - before
        chosen = (index >= low) & (index < low + step)
        position[chosen] = origin[index[chosen] - low, queues[row[chosen]]] + begin[chosen]

    length = end - begin
    cuts = (position + length - 1) // window - position // window + 1
    whole = np.repeat(np.arange(len(row)), cuts)
    nth = np.arange(len(whole)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    from_position = np.maximum(position[whole], (position[whole] // window + nth) * window)
    to_position = np.minimum((position + length)[whole], (position[whole] // window + nth + 1) * window)
    start = begin[whole] - at[row[whole]] + from_position - position[whole]
    return row[whole], start, to_position - from_position, from_position // window, from_position % window


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    window: int = WINDOW,
    quantum: int = QUANTUM,
    vocabulary: str = VOCABULARY,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents in sequences of ``window`` tokens; with ``with_ids`` also their ids (16 bits each).

    ``weights``: target proportions by source, by default those of the sources' tokens, which hold to the end; otherwise they hold
    until a source is empty; with them there may be no more than ``QUEUES`` sources, as the smallest of more would share a queue
    that weighs as many tokens as it has. A missing text is empty, so the document is its end token. Every row is packed, repeated ones too.
    """
    tokens = stored(tokenized(docs, vocabulary), "tokens")
    totals = tokens.groupBy("part", "slot", "source").agg(F.sum("n").alias("n"))
    totals = stored(totals.withColumn("range", F.expr("part div 1000")), "token-totals")
    sources = totals.groupBy("source").agg(F.sum("n").alias("tokens"))
    largest = sources.orderBy(F.desc("tokens"), F.col("source").asc_nulls_first()).limit(QUEUES).collect()
    names = docs.sparkSession.createDataFrame(
        [(row["source"], i) for i, row in enumerate(largest)], "name string, number int"
    )
    if weights is not None and len(largest) == QUEUES and sources.count() > QUEUES:
        raise ValueError(f"weights hold for {QUEUES} sources at most")
    rest = len(largest)
    queued = totals.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name")), "left")
    queued = stored(
        queued.select("part", "slot", "range", "n", F.coalesce("number", F.lit(rest)).alias("queue")), "token-queues"
    )
    shared = (queued.where(F.col("queue") == rest).agg(F.sum("n").alias("n")).first()["n"] or 0) if rest == QUEUES else 0
    each = [row["tokens"] for row in largest] + [shared]
    wanted = None if weights is None else [float(weights[row["source"]]) for row in largest] + [float(shared)]
    rounds = Rounds(each, wanted, window, quantum)

    bases = with_running_total(queued, "base", F.col("n"), ["queue"], "range", [F.col("part"), F.col("slot")])
    # A row for each task and source: as a table of known size it is broadcast if it is small, and then no ids are exchanged.
    bases = stored(bases.select("part", "slot", "queue", "base"), "token-bases")
    located = tokens.join(bases, ["part", "slot"])
    located = located.select("doc_id", "n", "ids", "queue", (F.col("base") + F.col("before")).alias("at"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "ids", PIECE_BYTES):
            queues, at, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("queue", "at", "n"))
            row, start, length, sequence, offset = place(rounds, queues, at, n, window)
            ids = [np.frombuffer(x.as_py(), "<u2") for x in batch.column("ids")]
            wide = [memoryview(x.astype("<u4")).cast("B") for x in ids]
            places = zip(row.tolist(), start.tolist(), (start + length).tolist(), strict=True)
            crc = [zlib.crc32(wide[r][4 * low : 4 * high]) for r, low, high in places]
            arrays = [batch.column("doc_id").take(pa.array(row))]
            arrays += [pa.array(x, pa.int64()) for x in (start, length, crc, n[row], sequence, offset)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                places = zip(row.tolist(), start.tolist(), (start + length).tolist(), strict=True)
                arrays.append(pa.array([ids[r][low:high].tobytes() for r, low, high in places], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return located.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


def sequences(pieces: DataFrame) -> DataFrame:
    """From pieces with ids one row for each sequence: ``sequence_id``, ``length``, ``ids`` (16 bits each, in order)."""
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    joined = F.unhex(F.array_join(F.transform("parts", lambda part: F.hex(part["ids"])), ""))
    return whole.select("sequence_id", "length", joined.alias("ids"))
