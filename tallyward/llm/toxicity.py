"""Toxicity by logistic regression over hashed words, word pairs and skip-pairs, learned by FTRL-proximal.

Each coordinate has its own learning rate, and the L1 part keeps a coordinate at exactly 0 until its gradients agree often enough, so that
a model of a million coordinates shrinks to a few thousand weights that go to every task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import pieces_of
from tallyward.llm.language import held_out
from tallyward.llm.shingles import hashed_words, mix, text_bytes

BITS = 20
PIECE_BYTES = 2 << 20
# The model is fitted on about so many labelled rows, chosen by a hash of the id.
LEARN_DOCUMENTS = 16_000
# Words are runs of letters; every byte of a letter outside ASCII counts as one.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _occurrences(texts: pa.StringArray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The text and the coordinate of each occurrence of a feature.

    Features are words, pairs of neighbouring words and pairs with one word between them, hashed to ``2 ** bits`` coordinates.
    """
    words, before = hashed_words(*text_bytes(texts), NO_LETTER)
    counts = np.diff(before)
    owner = np.repeat(np.arange(len(counts)), counts)
    found, of = [mix(words, 21)], [owner]
    for gap in (1, 2):
        inside = owner[:-gap] == owner[gap:] if len(owner) > gap else np.empty(0, bool)
        with np.errstate(over="ignore"):
            pairs = mix(mix(words[:-gap][inside], 21 + gap) + words[gap:][inside], 23 + gap)
        found.append(pairs)
        of.append(owner[:-gap][inside])
    return np.concatenate(of), (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)


def features(texts: pa.StringArray, bits: int = BITS) -> list[np.ndarray]:
    """The distinct features of each text, ascending."""
    owner, places = _occurrences(texts, bits)
    both = np.unique((owner << bits) | places)
    return np.split(both & ((1 << bits) - 1), np.searchsorted(both, np.arange(1, len(texts)) << bits))


@dataclass
class Model:
    """Weights other than 0 by coordinate, and the bias."""

    places: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.StringArray) -> np.ndarray:
        """The probability for each text; a feature counts once, however often it occurs."""
        weighted = np.zeros(1 << BITS, bool)
        weighted[self.places] = True
        owner, places = _occurrences(texts, BITS)
        of_use = weighted[places]
        both = np.unique((owner[of_use] << BITS) | places[of_use])
        weights = self.weights[np.searchsorted(self.places, both & ((1 << BITS) - 1))]
        return _probability(self.bias + np.bincount(both >> BITS, weights, len(texts)))


def _probability(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(
    found: list[np.ndarray], labels: np.ndarray, rate: float = 3.0, smooth: float = 1.0, l1: float = 8.0, l2: float = 0.1, rounds: int = 5,
    balance: float = 0.5,
) -> Model:
    """FTRL-proximal over the examples in their order. The last coordinate is the bias, which has no L1 part.

    The rarer label counts for more by the ratio of both to the power of ``balance``. With one label only, that is the answer; with no
    examples it is 0.
    """
    size = 1 << BITS
    positive = int(labels.sum())
    if positive in (0, len(labels)):
        return Model(np.empty(0, np.int64), np.empty(0), 35.0 if positive else -35.0)
    heavier = ((len(labels) - positive) / positive) ** balance
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        pull = z[at]
        least = np.where(at == size, 0.0, l1)
        shrunk = np.sign(pull) * np.maximum(np.abs(pull) - least, 0)
        return -shrunk / ((smooth + np.sqrt(n[at])) / rate + l2)

    for _ in range(rounds):
        for places, label in zip(found, labels, strict=True):
            at = np.append(places, size)
            w = weights(at)
            gradient = float(_probability(w.sum()) - label) * (heavier if label else 1.0)
            step = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / rate
            z[at] += gradient - step * w
            n[at] += gradient * gradient
    everything = weights(np.arange(size + 1))
    kept = np.flatnonzero(everything[:-1])
    return Model(kept, everything[kept], float(everything[-1]))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", documents: int = LEARN_DOCUMENTS) -> Model:
    """The model from about ``documents`` labelled rows that are not held out, chosen by a hash of the id.

    Features are made where the texts are; only the sample's features meet in one task, which is fitted in the order of the hash. Of
    several labels of an id the largest counts, of several texts the least.
    """
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out() & F.col(label).isNotNull())
    known = known.groupBy(F.col("doc_id").alias("id")).agg((F.max(label) > 0).cast("int").alias("label"))
    total = known.count()
    chance = F.crc32(F.concat(F.lit("toxicity:"), F.col("id").cast("string"))) / F.lit(2**32)
    sample = known.where(chance * total < documents)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id"))
    texts = texts.groupBy("id").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"), F.first("label").alias("label"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            found = pa.array([x.astype(np.int32) for x in features(batch.column("text"))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), found], ["id", "label", "found"])

    id_type = texts.schema["id"].dataType.simpleString()
    examples = texts.select("id", "label", "text").mapInArrow(describe, f"id {id_type}, label int, found array<int>")

    def train(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda i: (zlib.crc32(f"order:{ids[i]}".encode()), ids[i])), int)
        lists = group.column("found").combine_chunks()
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        found = [values[offsets[i] : offsets[i + 1]] for i in order]
        model = fit(found, group.column("label").to_numpy()[order])
        return pa.table(
            {"place": pa.array([*model.places.tolist(), -1], pa.int64()), "weight": pa.array([*model.weights.tolist(), model.bias], pa.float64())}
        )

    rows = examples.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(train, "place bigint, weight double").collect()
    weights = {row["place"]: row["weight"] for row in rows}
    bias = weights.pop(-1, -35.0)
    places = np.array(sorted(weights), np.int64)
    return Model(places, np.array([weights[p] for p in places.tolist()]), bias)


def scored(docs: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of each row as the struct ``row``, and ``score``. A missing text is an empty one, whose score is the bias'."""
    kept = docs.select(F.struct(*columns).alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.scores(batch.column("text")))], ["row", "score"])

    return kept.mapInArrow(score, f"row {kept.schema['row'].dataType.simpleString()}, score double")


def toxic_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    found = scored(documents, learn(documents, labels), ["doc_id"])
    return found.select(
        "row.doc_id", held_out("row.doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
