"""Exact top-k by inner product: columnar branch and bound over a grid of query blocks and candidate blocks.

A cell of the grid holds a block of queries and a block of candidates. The candidates lie dimension by dimension; a query adds up its
products one block of dimensions after another. What the rest can still add or take away is at most the product of the norms of
both rests, so that a candidate whose upper bound is below the k-th best lower bound is out, and the survivors are compacted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import parts_for, stored

CANDIDATES_PER_CELL = 8192
QUERIES_PER_CELL = 1024
DIMENSIONS_PER_BLOCK = 16
SCALE = 1024
LONG = 2**63 - 1


def usable(vector: str) -> Column:
    """Whether the vector is there and all its components are finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & fine


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column as doubles; shorter vectors are filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def width_of(*columns: pa.ListArray) -> int:
    return max((int(pc.max(pc.list_value_length(c)).as_py() or 0) for c in columns if len(c)), default=0)


def best_candidates(
    query: np.ndarray, columns: np.ndarray, norms: np.ndarray, ids: np.ndarray, k: int, step: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best columns (dimensions by candidates), higher scores first, then smaller ids.

    ``norms[b]``: of each candidate's rest from block b on. All values are whole numbers below 2**53, so sums are exact.
    """
    alive = np.arange(columns.shape[1])
    sums = np.zeros(len(alive))
    width = len(query)
    for block, first in enumerate(range(0, width, step)):
        part = columns[first : first + step]
        sums += query[first : first + step] @ (part if len(alive) == columns.shape[1] else part[:, alive])
        rest = query[first + step :]
        if len(alive) > k and len(rest):
            bound = norms[block + 1][alive] * (math.sqrt(rest @ rest) * (1 + 1e-9)) + 1e-6
            least = np.partition(sums - bound, len(alive) - k)[len(alive) - k]
            left = sums + bound >= least
            if left.sum() < 0.9 * len(alive):
                alive, sums = alive[left], sums[left]
    order = np.lexsort((ids[alive], -sums))[:k]
    return alive[order], sums[order]


def _exact(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[list[int], list[int]]:
    """The same with unbounded integers, for components too large for exact doubles."""
    whole = [int(x) for x in query]
    scores = [sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in rows]
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k]
    return order, [max(-LONG - 1, min(LONG, scores[i])) for i in order]


RESULT = "query_row bigint, query_id bigint, vec_id bigint, score bigint"
FIELDS = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def cell_search(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of the cell for each of its queries, leaving out the query's own row."""
    if not len(queries) or not len(candidates):
        return FIELDS.empty_table()
    vectors = [t.column("vector").combine_chunks() for t in (queries, candidates)]
    width = width_of(*vectors)
    asked, given = (np.floor(matrix(v, width) * SCALE) for v in vectors)
    ids, rows = (candidates.column(c).to_numpy() for c in ("vec_id", "row_id"))
    own = dict(zip(rows.tolist(), range(len(rows)), strict=True))
    largest = np.abs(asked).max(initial=0) * np.abs(given).max(initial=0) * max(width, 1)
    # Dimensions that carry most come first, so that the rests get small soon.
    order = np.argsort(-(given**2).sum(axis=0), kind="stable")
    asked, given = asked[:, order], given[:, order]
    columns = np.ascontiguousarray(given.T)
    squares = given**2
    norms = [np.sqrt(squares[:, first:].sum(axis=1)) for first in range(0, width + DIMENSIONS_PER_BLOCK, DIMENSIONS_PER_BLOCK)]
    out: list[tuple] = []
    query_ids, query_rows = (queries.column(c).to_pylist() for c in ("vec_id", "row_id"))
    for i, (query_id, query_row) in enumerate(zip(query_ids, query_rows, strict=True)):
        if largest < 2.0**53:
            places, scores = best_candidates(asked[i], columns, norms, ids, k + 1, DIMENSIONS_PER_BLOCK)
            found = list(zip(places.tolist(), scores.astype(np.int64).tolist(), strict=True))
        else:
            found = list(zip(*_exact(asked[i], given, ids, k + 1), strict=True))
        mine = own.get(query_row)
        found = [(p, s) for p, s in found if p != mine][:k]
        out += [(query_row, query_id, int(ids[p]), s) for p, s in found]
    return pa.table([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), FIELDS, strict=True)], FIELDS) if out else FIELDS.empty_table()


def top_k(vectors: DataFrame, queries: Column, k: int, identity: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` best other rows for each row where ``queries`` holds: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Vectors that are missing or hold a missing or non-finite component, and rows without an id, take no part. Of vectors of
    different lengths the shorter counts as filled up with zeros. A repeated row is a candidate, and a query, of its own. Scores that
    a long cannot hold are cut to its range. Equal scores: smaller id first. Fewer candidates than ``k``: all of them.
    """
    rows = vectors.where(F.col(identity).isNotNull() & usable(vector)).select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(identity).cast("bigint").alias("vec_id"),
        F.col(vector).alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    )
    rows = stored(rows, "vectors")
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked")).first()
    blocks, asking = parts_for(found["n"], CANDIDATES_PER_CELL), parts_for(found["asked"], QUERIES_PER_CELL)
    part = F.xxhash64("row_id", "vec_id")
    candidates = rows.withColumn("block", F.pmod(part, F.lit(blocks)).cast("int")).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(asking - 1)))
    )
    asked = rows.where("asks").withColumn("group", F.pmod(part, F.lit(asking)).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return cell_search(left, right, k)

    cells = asked.groupBy("block", "group").cogroup(candidates.groupBy("block", "group")).applyInArrow(search, RESULT)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = cells.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_embeddings(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("vec_id") % 100 == 0, 10)


SEARCH_SQL = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from vectors q join vectors c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
"""
