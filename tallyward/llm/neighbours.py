"""Approximate nearest neighbours by inner product: shifted space-filling curves.

Each vector gets a place on several Hilbert curves through random projections that are shifted against each other; near vectors
are near on at least one of them with a good chance. Every order is range-partitioned and ranked by Spark, a query looks at the
ranks around its own place in each order, and what it meets is ranked anew by the exact product.

For inner products vectors of different lengths are lifted to equal length by one more component, which a query has as 0; the
nearest by angle are then those with the largest product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import parts_for, stored
from tallyward.llm.exact_search import matrix, usable, width_of

CURVES = 8
AXES = 8
AXIS_BITS = 7
# Projections are scaled and windows are set on about so many vectors, chosen by a hash.
SAMPLE = 4096
# So many of the sample ask when a window is set, drawn at random whatever the sample's order.
ASKING = 512
# Share of the sample's nearest neighbours that the windows have to meet.
AIM = 0.96
# A cell holds the candidates of so many ranks at most, and the queries of so many.
CELL_RANKS = 32_768
QUERY_RANKS = 65_536
# More queries of one range than these are dealt to several cells.
QUERY_MOST = 8_192
ROWS_PER_RANGE = 100_000


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of points with whole coordinates on a Hilbert curve: the transposed form, turned from the highest bit down."""
    x = points.astype(np.int64).T.copy()
    axes = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(axes):
            high = (x[i] & level) != 0
            exchanged = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ exchanged)
            x[i] ^= exchanged
        level >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turned = np.zeros(x.shape[1], np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        turned ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turned
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


@dataclass
class Curves:
    """Projections, their scales and shifts. ``longest``: the length that candidates are lifted to."""

    directions: np.ndarray  # curves, width + 1, axes
    middle: np.ndarray
    spread: np.ndarray
    shifts: np.ndarray
    longest: float

    @classmethod
    def drawn(cls, sample: np.ndarray, longest: float, curves: int = CURVES, seed: int = 17) -> Curves:
        rng = np.random.default_rng(seed)
        width = sample.shape[1] + 1
        axes = min(AXES, width)
        directions = np.stack([np.linalg.qr(rng.normal(size=(width, axes)))[0] for _ in range(curves)])
        out = cls(directions, np.zeros((curves, axes)), np.ones((curves, axes)), rng.random((curves, axes)), longest)
        seen = np.einsum("nw,cwa->cna", out.lifted(sample), directions)
        out.middle, out.spread = seen.mean(axis=1), np.maximum(seen.std(axis=1), 1e-12 * longest)
        return out

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0)
        return np.column_stack([vectors, np.sqrt(rest)])

    def keys(self, vectors: np.ndarray, ask: bool) -> np.ndarray:
        """A row of keys for each curve. Scores become even on the axes by a curve close to the normal distribution."""
        lifted = np.column_stack([vectors, np.zeros(len(vectors))]) if ask else self.lifted(vectors)
        if ask:
            lengths = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
            lifted = lifted * (self.longest / np.maximum(lengths, np.finfo(float).tiny))
        out = []
        for directions, middle, spread, shift in zip(self.directions, self.middle, self.spread, self.shifts, strict=True):
            even = (np.tanh(0.8 * (lifted @ directions - middle) / spread) + 1) / 2
            cells = np.minimum((even + shift) / 2 * (1 << AXIS_BITS), (1 << AXIS_BITS) - 1)
            out.append(hilbert(cells.astype(np.int64), AXIS_BITS))
        return np.array(out)

    def window(self, sample: np.ndarray, k: int, total: int, aim: float = AIM) -> int:
        """How many ranks a query looks at to either side, so that in the sample it meets the ``aim`` of its nearest.

        In a sample the nearest are farther away than among all, so the share of ranks that they need is enough for all.
        """
        size = len(sample)
        if size <= k + 1:
            return total
        nearest = min(size - 1, max(1, math.ceil(k * size / total)))
        asking = np.random.default_rng(23).permutation(size)[:ASKING]
        asked = sample[asking]
        scores = asked @ sample.T
        scores[np.arange(len(asked)), asking] = -np.inf
        best = np.argpartition(-scores, nearest - 1, axis=1)[:, :nearest]
        least = np.full(best.shape, size)
        for given, wanted in zip(self.keys(sample, False), self.keys(asked, True), strict=True):
            order = np.argsort(given, kind="stable")
            rank = np.empty(size, int)
            rank[order] = np.arange(size)
            least = np.minimum(least, np.abs(rank[best] - np.searchsorted(given[order], wanted)[:, None]))
        return min(total, max(4 * k, math.ceil((np.quantile(least, aim) + 1) / size * total)))


FOUND = pa.schema(
    [("query_row", pa.int64()), ("query_id", pa.int64()), ("row_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
)


def cell_search(queries: pa.Table, candidates: pa.Table, k: int, window: int) -> pa.Table:
    """The ``k`` nearest of the cell's candidates within each query's window of ranks."""
    if not len(queries) or not len(candidates):
        return FOUND.empty_table()
    columns = [t.column("vector").combine_chunks() for t in (queries, candidates)]
    width = width_of(*columns)
    asked, given = (matrix(c, width) for c in columns)
    rank, ids, rows = (candidates.column(c).to_numpy() for c in ("rank", "vec_id", "row_id"))
    order = np.argsort(rank, kind="stable")
    given, rank, ids, rows = given[order], rank[order], ids[order], rows[order]
    middle = queries.column("rank").to_numpy()
    lows, highs = np.searchsorted(rank, middle - window), np.searchsorted(rank, middle + window, "right")
    query_ids, query_rows = (queries.column(c).to_numpy() for c in ("vec_id", "row_id"))
    out: list[list[np.ndarray]] = []
    for first in range(0, len(asked), 256):
        block = asked[first : first + 256]
        products = block @ given.T
        for i, scores in enumerate(products, start=first):
            low, high = int(lows[i]), int(highs[i])
            some = scores[low:high]
            if not len(some):
                continue
            # Fast products choose, with room for their rounding; products in a fixed order of addition decide.
            room = 1e-9 * (1 + np.abs(some).max())
            least = np.partition(some, len(some) - k - 1)[len(some) - k - 1] - room if len(some) > k + 1 else -np.inf
            near = low + np.flatnonzero(some >= least)
            near = near[rows[near] != query_rows[i]]
            exact = np.add.reduce(given[near] * asked[i], axis=1)
            best = np.lexsort((ids[near], -exact))[:k]
            near, exact = near[best], exact[best]
            same = np.full(len(near), query_rows[i]), np.full(len(near), query_ids[i])
            out.append([*same, rows[near], ids[near], exact])
    if not out:
        return FOUND.empty_table()
    return pa.table([pa.array(np.concatenate(c), t.type) for c, t in zip(zip(*out, strict=True), FOUND, strict=True)], schema=FOUND)


def _keyed(vectors: DataFrame, curves: Curves) -> DataFrame:
    """A row for each vector and curve, and one more for each query."""
    width = curves.directions.shape[1] - 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 4096):
                batch = whole.slice(low, 4096)
                points = matrix(batch.column("vector"), width)
                asks = batch.column("asks").to_numpy(zero_copy_only=False)
                rows = batch.column("row_id").to_numpy()
                for kind, chosen in ((0, np.ones(len(rows), bool)), (1, asks)):
                    if not chosen.any():
                        continue
                    keys = curves.keys(points[chosen], kind == 1)
                    n = keys.size
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(np.arange(len(keys), dtype=np.int32), keys.shape[1])),
                            pa.array(np.full(n, kind, np.int32)),
                            pa.array(keys.reshape(-1)),
                            pa.array(np.tile(rows[chosen], len(keys))),
                        ],
                        ["curve", "kind", "key", "row_id"],
                    )

    return vectors.select("row_id", "asks", "vector").mapInArrow(place, "curve int, kind int, key bigint, row_id bigint")


def _ranked(keyed: DataFrame, total: int) -> DataFrame:
    """``rank`` of each row: how many candidates lie before it on its curve.

    The order is range-partitioned, each task numbers its rows, and the counts of the tasks before are added.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            curve, kind = batch.column("curve").to_numpy(), batch.column("kind").to_numpy()
            local = np.empty(len(curve), np.int64)
            for c in np.unique(curve).tolist():
                mine = curve == c
                counted = np.cumsum(kind[mine] == 0) - (kind[mine] == 0)
                local[mine] = seen.get(c, 0) + counted
                seen[c] = seen.get(c, 0) + int((kind[mine] == 0).sum())
            columns = [pa.array(np.full(len(curve), part, np.int32)), *(batch.column(c) for c in ("curve", "kind", "row_id"))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(local)], ["part", "curve", "kind", "row_id", "local"])

    # A query comes before the candidates of the same key.
    order = ["curve", "key", F.desc("kind"), "row_id"]
    ranges = keyed.repartitionByRange(parts_for(CURVES * total, ROWS_PER_RANGE), *order).sortWithinPartitions(*order)
    numbered = ranges.mapInArrow(number, "part int, curve int, kind int, row_id bigint, local bigint")
    numbered = stored(numbered, "curve-order")
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy("curve", "part").agg(F.count_if(F.col("kind") == 0).alias("n"))
    counts = counts.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = numbered.join(counts, ["curve", "part"])
    return ranked.select("row_id", "kind", "curve", (F.col("before") + F.col("local")).cast("bigint").alias("rank"))


def dealt(placed: DataFrame, total: int, window: int, cell: int) -> tuple[DataFrame, DataFrame]:
    """Queries and candidates with the cells in which they meet: ``curve``, ``block``, ``queries``, ``share``.

    A query goes to each block of candidates that its window reaches; blocks are copied for each range of queries that reach them. Queries
    with equal vectors have equal ranks, so a range can hold any number of them: it is cut into shares by a hash.
    """
    first, last = (F.expr(f"greatest(bigint(0), rank - {window}) div {cell}"), F.expr(f"least(rank + {window}, {max(total - 1, 0)}) div {cell}"))
    asked = placed.where("kind = 1").withColumn("queries", F.expr(f"rank div {QUERY_RANKS}"))
    crowded = asked.groupBy("curve", "queries").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > QUERY_MOST)
    crowded = stored(crowded.select("curve", "queries", F.expr(f"(n - 1) div {QUERY_MOST} + 1").alias("shares")), "query-shares")
    asked = asked.join(crowded, ["curve", "queries"], "left")
    asked = asked.withColumn("share", F.pmod(F.xxhash64("row_id"), F.coalesce("shares", F.lit(1)))).drop("shares")
    asked = asked.withColumn("block", F.explode(F.sequence(first, F.greatest(first, last))))
    given = placed.where("kind = 0").withColumn("block", F.expr(f"rank div {cell}"))
    reach = [
        F.expr(f"greatest(bigint(0), block * {cell} - {window}) div {QUERY_RANKS}"),
        F.expr(f"least((block + 1) * {cell} + {window}, {total}) div {QUERY_RANKS}"),
    ]
    given = given.withColumn("queries", F.explode(F.sequence(*reach))).join(crowded, ["curve", "queries"], "left")
    shares = F.sequence(F.lit(0).cast("bigint"), F.coalesce("shares", F.lit(1)) - 1)
    return asked, given.withColumn("share", F.explode(shares)).drop("shares")


def nearest(
    vectors: DataFrame, queries: Column, k: int, identity: str = "vec_id", vector: str = "embedding", aim: float = AIM
) -> DataFrame:
    """The ``k`` nearest other rows found for each row where ``queries`` holds: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Vectors that are missing, all zero or hold a missing or non-finite component, and rows without an id, take no part. Of vectors
    of different lengths the shorter counts as filled up with zeros. Equal scores: smaller id first. A repeated row is a candidate, and
    a query, of its own. ``aim`` is the share of nearest neighbours that the windows are set for.
    """
    size = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = vectors.where(F.col(identity).isNotNull() & usable(vector) & F.exists(vector, lambda x: x != 0)).select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(identity).cast("bigint").alias("vec_id"),
        F.col(vector).alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
        F.sqrt(size).alias("length"),
    )
    rows = stored(rows, "near-vectors")
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"), F.max(F.size("vector")).alias("width")).first()
    total, width = facts["n"], facts["width"] or 1
    chance = F.pmod(F.xxhash64(F.lit("sample"), "row_id", "vec_id"), F.lit(2**31)) / F.lit(2**31)
    chosen = rows.where(chance * total < SAMPLE).orderBy("row_id").select("vector").toArrow()
    sample = matrix(chosen.column("vector"), width) if total else np.zeros((0, width))
    curves = Curves.drawn(sample if len(sample) else np.zeros((1, width)), facts["longest"] or 1.0)
    window = max(1, curves.window(sample, k, total, aim))

    ranked = stored(_ranked(_keyed(rows, curves), total), "curve-ranks")
    cell = min(CELL_RANKS, max(window, 1024))
    placed = ranked.groupBy("row_id", "kind").agg(F.collect_list(F.struct("curve", "rank")).alias("places"))
    placed = rows.select("row_id", "vec_id", "vector").join(placed, "row_id")
    placed = placed.select("row_id", "vec_id", "vector", "kind", F.explode("places").alias("place"))
    placed = placed.select("row_id", "vec_id", "vector", "kind", "place.curve", "place.rank")
    asked, given = dealt(placed, total, window, cell)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return cell_search(left, right, k, window)

    keys = ["curve", "block", "queries", "share"]
    given = given.select(*[F.col(c).alias(c) for c in given.columns])  # both sides come from one table
    found = asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInArrow(
        search, "query_row bigint, query_id bigint, row_id bigint, vec_id bigint, score double"
    )
    # The same pair may be met on several curves, with the same score.
    merged = found.groupBy("query_row", "query_id", "row_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def near_embeddings(embeddings: DataFrame) -> DataFrame:
    return nearest(embeddings, F.col("vec_id") % 20 == 0, 20)
