"""Language identification by rank-order profiles.

The profile of a language lists the n-grams (1 to 3 letters, word ends included) that are most frequent in its texts. A document's own
most frequent n-grams are compared with each profile by how far each is out of place; the least distance wins.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import pieces_of

# N-grams in a profile, of a language as well as of a document.
PROFILE = 300
# Profiles are learned from about so many documents of each language, chosen by a hash.
LEARN_DOCUMENTS = 2000
UNKNOWN = "und"
# Text in any learned language is well above this, text in another script or without words near 0.
LEAST_SCORE = 0.2
PIECE_BYTES = 1 << 20
BITS = 21  # of a code point
GAP = 0x110000  # between words; no code point


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """All n-grams of a text as numbers, in no order. What is no letter is a gap between words, and gaps belong to n-grams' ends only."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points[~_letters()[points]] = GAP
    points = points[(points != GAP) | np.append(True, points[:-1] != GAP)]
    single = points[points != GAP]
    if not len(single):
        return single
    first, second, third = points[:-2], points[1:-1], points[2:]
    double = (points[:-1] << BITS) | points[1:]
    triple = (first << 2 * BITS) | (second << BITS) | third
    return np.concatenate([single, double, triple[second != GAP]])


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in ascending order and how often each occurs."""
    found = np.sort(grams(text))
    starts = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.empty(0, np.int64)
    return found[starts], np.diff(np.append(starts, len(found)))


def ranked(text: str, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first; equally frequent ones by number."""
    distinct, counts = counted(text)
    return distinct[np.argsort(-counts, kind="stable")[:size]]


def held_out(identity: str = "doc_id") -> Column:
    """Whether nothing is learned from the row; a row without id is not held out, but not learned from either."""
    return F.coalesce(F.crc32(F.col(identity).cast("string")) % 5 == 0, F.lit(False))


class Profiles:
    """The learned languages in the order of their names, and the known n-grams in ascending order.

    The profiles that hold the i-th known n-gram, and its rank in each, are the entries ``starts[i]`` to ``starts[i + 1]`` of ``langs``
    and ``places``: as many entries as the profiles have together, for any number of languages.
    """

    def __init__(self, lists: dict[str, list[int]], size: int = PROFILE):
        self.names = sorted(lists)
        self.size = size
        listed = [np.array(lists[name], np.int64) for name in self.names]
        sizes = [len(x) for x in listed]
        every = np.concatenate([np.empty(0, np.int64), *listed])
        order = np.argsort(every, kind="stable")
        self.known, starts = np.unique(every[order], return_index=True)
        self.starts = np.append(starts, len(every))
        self.langs = np.repeat(np.arange(len(listed), dtype=np.int32), sizes)[order]
        self.places = np.concatenate([np.empty(0, np.int32), *(np.arange(n, dtype=np.int32) for n in sizes)])[order]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and closeness: 1 if every n-gram is in its place, 0 if none is in the profile. The first name wins a tie."""
        mine = ranked(text or "", self.size)
        if not len(mine) or not len(self.known):
            return UNKNOWN, 0.0
        at = np.searchsorted(self.known, mine).clip(max=len(self.known) - 1)
        rank = np.flatnonzero(self.known[at] == mine)
        first, last = self.starts[at[rank]], self.starts[at[rank] + 1]
        holding = last - first
        entries = np.arange(holding.sum()) + np.repeat(last - np.cumsum(holding), holding)
        closer = self.size - np.abs(self.places[entries] - np.repeat(rank, holding))
        # Sums of whole numbers, exact in doubles.
        away = len(mine) * self.size - np.bincount(self.langs[entries], closer, len(self.names))
        best = int(np.argmin(away))
        return self.names[best], 1.0 - float(away[best]) / (len(mine) * self.size)


def learn(
    docs: DataFrame, text: str = "text", lang: str = "lang", identity: str = "doc_id", documents: int = LEARN_DOCUMENTS
) -> Profiles:
    """Profiles from the documents that are not held out and have a language.

    Every language has a profile. Of each about ``documents`` are used, chosen by a hash of the id. Only the profiles, ``PROFILE``
    numbers for each language at most, come to the driver.
    """
    labelled = docs.where(F.col(identity).isNotNull() & ~held_out(identity) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    per_lang = labelled.groupBy(F.col(lang).alias("learned")).agg(F.count(F.lit(1)).alias("n"))
    labelled = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(identity).alias("identity"))
    # The row hash is spread evenly over the range, so comparing it with a share of the range keeps that share of the rows.
    chance = F.crc32(F.concat(F.lit("profile:"), F.col("identity").cast("string"))) / F.lit(2**32)
    sample = labelled.join(F.broadcast(per_lang), F.col("lang") == F.col("learned")).where(chance * F.col("n") < documents)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            of_lang: dict[str, list[str]] = {}
            for name, words in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                of_lang.setdefault(name, []).append(words)
            for name in sorted(of_lang):
                texts = " ".join(of_lang[name])
                distinct, counts = counted(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(distinct), pa.string()), pa.array(distinct), pa.array(counts, pa.int64())],
                    ["lang", "gram", "n"],
                )

    counts = sample.select("lang", "text").mapInArrow(count, "lang string, gram bigint, n bigint")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("place", F.row_number().over(best)).where(F.col("place") <= PROFILE)
    lists = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "gram")))["gram"].alias("grams"))
    return Profiles({row["lang"]: row["grams"] for row in lists.collect()})


def predicted(docs: DataFrame, profiles: Profiles, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of each row, and ``lang_pred`` and ``score``. A text that is missing or has no letter: ``und``, 0."""
    kept = docs.select(F.struct(*columns).alias("row"), F.col(text).cast("string").alias("text"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            found = [profiles.predict(x.as_py()) for x in batch.column("text")]
            names, scores = zip(*found, strict=True)
            arrays = [batch.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "lang_pred", "score"])

    row = kept.schema["row"].dataType.simpleString()
    return kept.mapInArrow(label, f"row {row}, lang_pred string, score double")


def identify_documents(documents: DataFrame) -> DataFrame:
    """The contract's columns."""
    found = predicted(documents, learn(documents), ["doc_id"])
    return found.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


def recognised_documents(documents: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents in a learned language, with their columns.

    Rejected are ``und`` and texts whose n-grams are so far out of place in every profile that the score is below ``least``.
    """
    profiles = learn(documents)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            found = (profiles.predict(x.as_py()) for x in batch.column("text"))
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
