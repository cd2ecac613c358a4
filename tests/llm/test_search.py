"""Exact search against all products; approximate search: curve, recall, exact scores; odd rows of both."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.llm import exact_search, neighbours
from tallyward.llm.queries import QUERIES


def plain_top(rows, asks, k, score, drop_zero=False):
    fine = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    fine = [(i, v) for i, v in fine if not drop_zero or any(v)]
    width = max((len(v) for _, v in fine), default=0)
    full = [(i, [*v, *[0.0] * (width - len(v))]) for i, v in fine]
    out = []
    for at, (query, own) in enumerate(full):
        if asks(query):
            scores = sorted((-score(own, other), i) for place, (i, other) in enumerate(full) if place != at)[:k]
            out += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def whole(a, b):
    return sum(int(np.floor(1024 * float(x))) * int(np.floor(1024 * float(y))) for x, y in zip(a, b, strict=True))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 40), st.integers(1, 70), st.integers(1, 12))
def test_branch_and_bound_is_exact(seed, width, n, k):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-9, 9, (n, width)).astype(float)
    query, ids = rows[0], rng.permutation(n)
    norms = [np.sqrt((rows[:, first:] ** 2).sum(axis=1)) for first in range(0, width + 4, 4)]
    places, scores = exact_search.best_candidates(query, np.ascontiguousarray(rows.T), norms, ids, k, 4)
    expected = sorted((-float(row @ query), i) for row, i in zip(rows, ids, strict=True))[:k]
    assert [(-s, ids[p]) for p, s in zip(places, scores, strict=True)] == expected


def test_candidates_are_left_out_early():
    rng = np.random.default_rng(1)
    rows = np.floor(rng.normal(size=(2000, 64)) * np.geomspace(1000, 1, 64))
    norms = [np.sqrt((rows[:, first:] ** 2).sum(axis=1)) for first in range(0, 80, 16)]
    bound = norms[1] * np.sqrt((rows[0, 16:] ** 2).sum())
    partial = rows[:, :16] @ rows[0, :16]
    assert (partial + bound >= np.sort(partial - bound)[-10]).mean() < 0.1


ODD = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (200, [1.0, 2.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0])]
ODD += [(8, [0.5]), (None, [9.0, 9.0]), (100, [3.0, -1.0]), (9, []), (10, [-1e-3, 5.0])]


@pytest.mark.parametrize("rows", [ODD, [], [(0, [1.0])], [(0, [1e30, 1.0]), (1, [1.0, 1.0]), (2, [-1e30, 2.0])]])
def test_exact_search_of_odd_rows(spark, rows):
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    found = exact_search.top_k(frame, F.col("vec_id") % 100 == 0, 3).collect()
    expected = plain_top(rows, lambda i: i % 100 == 0, 3, whole)
    cut = [(q, r, i, max(-(2**63), min(2**63 - 1, s))) for q, r, i, s in expected]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == cut


def test_exact_search_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(exact_search, "CANDIDATES_PER_CELL", 50)
    monkeypatch.setattr(exact_search, "QUERIES_PER_CELL", 3)
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=20).round(1).tolist()) for i in range(400)] + [(1000 + i, [0.5] * 20) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = exact_search.top_k(frame, F.col("vec_id") % 20 == 0, 7).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == plain_top(rows, lambda i: i % 20 == 0, 7, whole)


@pytest.mark.parametrize(("axes", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_in_steps_of_one(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
    keys = neighbours.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def recall(spark, directory):
    rows = spark.read.parquet(f"{directory}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    points = np.array([r.embedding for r in rows])
    found = QUERIES["op4_neighbours"](spark, directory).collect()
    by_query: dict[int, list] = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    place = {int(i): p for p, i in enumerate(ids)}
    met = wanted = 0
    for query in ids[ids % 20 == 0].tolist():
        products = points @ points[place[query]]
        products[place[query]] = -np.inf
        best = ids[np.lexsort((ids, -products))[:20]]
        mine = by_query[query]
        assert len(mine) == 20 and query not in dict(mine)
        assert mine == sorted(mine, key=lambda x: (-x[1], x[0]))
        assert np.allclose([s for _, s in mine], [products[place[i]] for i, _ in mine], rtol=0, atol=1e-12)
        met += len(set(best.tolist()) & {i for i, _ in mine})
        wanted += 20
    return met / wanted


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, size):
    assert recall(spark, f"/root/testdata/{size}") >= 0.9


def test_windows_are_small_where_vectors_lie_in_groups():
    rng = np.random.default_rng(4)
    sample = (rng.normal(size=(100, 1, 32)) * 4 + rng.normal(size=(100, 40, 32)) * 0.1).reshape(-1, 32)
    sample = rng.permutation(sample)
    curves = neighbours.Curves.drawn(sample, float(np.sqrt((sample**2).sum(axis=1)).max()))
    spread = sample / np.sqrt((sample**2).sum(axis=1, keepdims=True))
    curves = neighbours.Curves.drawn(spread, 1.0)
    assert curves.window(spread, 20, 100 * len(spread)) < 0.05 * 100 * len(spread)


def test_recall_where_the_first_rows_lie_in_groups(spark):
    """Windows that the tight groups at the table's beginning need are too small for the rest."""
    rng = np.random.default_rng(9)
    groups = (rng.normal(size=(25, 1, 32)) + rng.normal(size=(25, 40, 32)) * 0.01).reshape(-1, 32)
    points = np.concatenate([groups, rng.normal(size=(3000, 32))])
    points /= np.sqrt((points**2).sum(axis=1, keepdims=True))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>").coalesce(1)
    found: dict[int, set] = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0, 20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    met = {}
    for query in range(0, len(points), 20):
        products = points @ points[query]
        products[query] = -np.inf
        met[query] = len(set(np.argsort(-products)[:20].tolist()) & found[query]) / 20
    assert np.mean(list(met.values())) >= 0.9
    assert np.mean([x for query, x in met.items() if query >= len(groups)]) >= 0.9


@pytest.mark.parametrize("rows", [ODD, [], [(0, [1.0])]])
def test_approximate_search_of_odd_rows(spark, rows):
    """So few vectors are all within the window."""
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    found = neighbours.nearest(frame, F.col("vec_id") % 100 == 0, 3).collect()

    def product(a, b):
        return sum(x * y for x, y in zip(a, b, strict=True))

    expected = plain_top(rows, lambda i: i % 100 == 0, 3, product, drop_zero=True)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)
    assert [x[:3] for x in got] == [x[:3] for x in expected]
    assert [x[3] for x in got] == pytest.approx([x[3] for x in expected])


def test_lengths_that_differ(spark):
    """A long vector in another direction can have the larger product."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 10)).tolist()) for i in range(3000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(frame, F.col("vec_id") % 50 == 0, 10).collect()
    points = np.array([v for _, v in rows])
    met = 0
    for query in range(0, 3000, 50):
        products = points @ points[query]
        products[query] = -np.inf
        met += len(set(np.argsort(-products)[:10].tolist()) & {r.vec_id for r in found if r.query_id == query})
    assert met >= 0.9 * 600


def test_queries_with_equal_vectors_are_dealt_to_several_cells(spark, monkeypatch):
    """Most queries have one rank on a curve; no cell holds more of them than it may, and each pair in reach still meets once."""
    monkeypatch.setattr(neighbours, "QUERY_RANKS", 400)
    monkeypatch.setattr(neighbours, "QUERY_MOST", 50)
    rng = np.random.default_rng(2)
    total, window, cell = 2000, 30, 100
    rows = [(10_000 + i, 0, 0, i) for i in range(total)]
    rows += [(i, 1, 0, 777 if i % 10 else int(rng.integers(0, total))) for i in range(1000)]
    placed = spark.createDataFrame(rows, "row_id long, kind int, curve int, rank long")
    asked, given = neighbours.dealt(placed, total, window, cell)
    keys = ["curve", "block", "queries", "share"]
    sizes = [r["count"] for r in asked.groupBy(*keys).count().collect()]
    assert max(sizes) < 150 and sum(sizes) > 1000
    meet = asked.select(*keys, F.col("row_id").alias("q"), F.col("rank").alias("at")).join(given, keys)
    pairs = meet.where(F.abs(F.col("rank") - F.col("at")) <= window).groupBy("q", "row_id").count()
    assert pairs.where("count <> 1").count() == 0
    expected = sum(min(total - 1, at + window) - max(0, at - window) + 1 for _, kind, _, at in rows if kind)
    assert pairs.count() == expected
