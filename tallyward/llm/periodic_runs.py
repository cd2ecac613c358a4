"""Runs of repeated words: the stretches of a text that say the same words over and over with a fixed period.

The suffix automaton of the words read so far is kept, and over the tree of its suffix links a link-cut structure whose preferred
paths hold the nodes with the same last occurrence. Appending a word is an access: the path from the new prefix to the root is
recoloured, piece by piece. Where a piece ended ``d`` words ago and its longest string has at least ``d`` words, the two occurrences
touch: a square of period ``d``, which reaches back exactly as far as the two agree. The words that follow extend it to a run.

Words that cannot belong to a run are left out before, by a bound that loses none (see :func:`stretches`).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import pieces_of

LEAST_LENGTH = 24
LEAST_POWER = 3
PIECE_BYTES = 1 << 20
# Odd factors of a hash over windows of words; any would do.
MIX, SPREAD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

Run = tuple[int, int, int]  # start, length, period


def recolourings(words: Sequence[int]) -> Iterator[tuple[int, int, int]]:
    """For each appended word the pieces of the path that change their last occurrence: (words so far, ended before, longest string).

    State 0 is the root of automaton and tree. A preferred path is a splay tree ordered by depth; its root knows the last occurrence
    (``seen``), and its ``up`` is the node that the path hangs from. Pieces come from the longest string to the shortest, and those
    without an occurrence before are left out.
    """
    length, link, following = [0], [0], [{}]
    up, left, right, seen = [0], [0], [0], [0]

    def state(words_long: int, transitions: dict[int, int]) -> int:
        length.append(words_long)
        link.append(0)
        following.append(transitions)
        for values in (up, left, right, seen):
            values.append(0)
        return len(length) - 1

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = right[x]
            left[p], right[x] = inner, p
        else:
            inner = left[x]
            right[p], left[x] = inner, p
        if inner:
            up[inner] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def splay(x: int) -> None:
        """Make ``x`` the root of its path's tree."""
        root = x
        while (p := up[root]) and (left[p] == root or right[p] == root):
            root = p
        if x == root:
            return
        while (p := up[x]) and (left[p] == x or right[p] == x):
            if p != root:
                rotate(p if (left[up[p]] == p) == (left[p] == x) else x)
            rotate(x)
        seen[x] = seen[root]

    last = 0
    for end, word in enumerate(words, 1):
        new = state(end, {})
        at = last
        while word not in following[at]:
            following[at][word] = new
            if not at:
                at = -1
                break
            at = link[at]
        if at >= 0:
            same = following[at][word]
            if length[at] + 1 < length[same]:
                # The shorter strings of ``same`` get a node of their own, above it on the same path.
                upper = state(length[at] + 1, dict(following[same]))
                link[upper], link[same] = link[same], upper
                splay(same)
                above = left[same]
                left[same], up[upper], left[upper] = upper, same, above
                if above:
                    up[above] = upper
                while following[at].get(word) == same:
                    following[at][word] = upper
                    if not at:
                        break
                    at = link[at]
                same = upper
            link[new] = same
        last = new

        below, at = new, link[new]
        while at:
            splay(at)
            yield end, seen[at], length[at]
            if right[at]:
                seen[right[at]] = seen[at]
            right[at], up[below] = below, at
            below, at = at, up[at]
        seen[below] = end


def runs(words: Sequence[int], least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER) -> list[Run]:
    """All maximal runs of at least ``least_length`` words and ``least_power`` (2 or more) periods, by start, then period.

    While a run goes on, each of its words recolours a piece at the distance of its smallest period: any smaller distance
    would make that period smaller. So its last word is the last one that does.
    """
    ends: dict[tuple[int, int], int] = {}
    for end, before, longest in recolourings(words):
        period = end - before
        if longest >= (least_power - 1) * period:
            ends[end - longest - period, period] = end
    return sorted((start, end - start, period) for (start, period), end in ends.items() if end - start >= least_length)


def stretches(words: np.ndarray, least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER) -> list[tuple[int, int]]:
    """The ranges (start, end) of words outside of which there is no word of a run.

    A run of length L and period q has L - 2q >= L (1 - 2 / power), so each of its windows of that many words or fewer comes once more
    in it, q words before or after. Ranges are the unions of windows that come more than once in the text; a run lies in one of them,
    and no word beside the range could extend it. Equal hashes of unequal windows only make ranges longer.
    """
    size = max(1, least_length * (least_power - 2) // least_power)
    if len(words) < least_length:
        return []
    hashes = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        hashes = hashes * np.uint64(MIX) + words[i : i + len(hashes)].astype(np.uint64) * np.uint64(SPREAD)
    ordered = np.sort(hashes)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(repeated):
        return []
    flags = np.zeros(len(hashes) + 2, np.int8)
    flags[1:-1] = np.isin(hashes, repeated)
    edges = np.flatnonzero(np.diff(flags)).reshape(-1, 2)
    return [(start, end + size - 1) for start, end in edges.tolist() if end + size - 1 - start >= least_length]


def runs_of_words(words: Sequence[bytes], least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER) -> list[Run]:
    """:func:`runs` of a whole text."""
    if len(words) < least_length:
        return []
    numbers: dict[bytes, int] = {}
    numbered = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    found = []
    for first, end in stretches(numbered, least_length, least_power):
        part = runs(numbered[first:end].tolist(), least_length, least_power)
        found += [(first + start, length, period) for start, length, period in part]
    return sorted(found)


def collapsed(words: Sequence[bytes], found: Sequence[Run]) -> bytes:
    """The words, joined by one space, without those that a run contains after its first period."""
    if not found:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


RUNS = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def find_runs(
    texts: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER
) -> DataFrame:
    """(``key``, n_words, runs, collapsed) of each row: the runs by start and period, and the text without their repetitions.

    Words are what white space of ASCII separates. A missing text has no words. Rows are independent of each other: repeated rows, and
    rows without a key, each give their own row. A text is examined whole, in memory that grows with its longest repetitive stretch.
    """
    if least_power < 2:
        raise ValueError("a run has at least two periods")
    given = texts.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    kind = given.schema["key"].dataType.simpleString()

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            sizes, all_runs, rests = [], [], []
            for value in batch.column("text"):
                words = (value.as_py() or b"").split()
                found = runs_of_words(words, least_length, least_power)
                sizes.append(len(words))
                all_runs.append([dict(zip(("start", "length", "period"), one, strict=True)) for one in found])
                rests.append(collapsed(words, found))
            columns = [pa.array(sizes, pa.int64()), pa.array(all_runs, pa.list_(run)), pa.array(rests, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], ["key", "n_words", "runs", "collapsed"])

    return given.mapInArrow(examine, f"key {kind}, {RUNS}").withColumnRenamed("key", key)


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """(doc_id, text): the contract's texts, in which one document of ten repeats its words from some place on.

    A document without an id stays as it is.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(hashed % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    rows = documents.select("doc_id", "text", hashed.alias("_hash"), words.alias("_words"))
    rows = rows.select("*", F.floor(F.col("_hash") / 10).alias("_g"), F.size("_words").cast("bigint").alias("_n"))
    rows = rows.select("*", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).alias("_a"))
    period = F.expr("1 + (_n - _a) div (3 + _g % 8)")
    rows = rows.select("*", period.alias("_p"))
    repeated = F.transform(
        "_words", lambda word, i: F.when(i < F.col("_a"), word).otherwise(F.get("_words", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")))
    )
    return rows.select("doc_id", F.when(F.col("_n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def _greatest(found: Column) -> Column:
    """The run with the greatest length / period, compared as fractions; the first of equal ones."""
    return F.reduce(
        found,
        F.get(found, F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )


def run_documents(documents: DataFrame) -> DataFrame:
    """The contract's columns: the number of runs, the most repetitive one, and digests of all runs and of what is left of the text."""
    found = find_runs(with_planted_periods(documents)).withColumn("best", _greatest(F.col("runs")))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
