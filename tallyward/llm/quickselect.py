"""Distributed quickselect: the k-th smallest key of a table without sorting it.

Random rows of the table are the pivots of a pass; one aggregate counts exactly how many keys lie between, and on, each of them; the
rows between the two pivots around the k-th key are stored, and the next pass is over these alone. With P pivots a pass leaves about
two in P rows, so all passes together read little more than the first one. The driver holds P keys and 2 P + 1 counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallyward.llm.common import stored

PIVOTS = 31


def key_of(columns: Sequence[str], values: Row | None = None) -> Column:
    """The composite key of a row, or that of given values. Keys compare column by column."""
    return F.struct(*[F.col(c) if values is None else F.lit(values[c]).alias(c) for c in columns])


def partition_counts(rows: DataFrame, columns: Sequence[str], pivots: Sequence[Row]) -> list[int]:
    """How many keys are below the first pivot, equal to it, between it and the second, and so on; ``pivots`` ascend."""
    key = key_of(columns)
    given = F.array(*[key_of(columns, pivot) for pivot in pivots])
    below = F.size(F.filter(given, lambda pivot: pivot < key))
    place = (2 * below + F.array_contains(given, key).cast("int")).alias("place")
    counts = {row["place"]: row["n"] for row in rows.groupBy(place).agg(F.count(F.lit(1)).alias("n")).collect()}
    return [counts.get(i, 0) for i in range(2 * len(pivots) + 1)]


def kth_key(rows: DataFrame, columns: Sequence[str], k: int, seed: str = "pivots", pivots: int = PIVOTS) -> Row:
    """The key at place ``k`` (from 1) in ascending order. ``rows`` is read repeatedly: pass a stored table.

    The columns must be orderable and without nulls; keys that are equal count as often as they come.
    """
    if k < 1:
        raise ValueError("places count from 1")
    rows, turn = rows.select(*columns), 0
    while True:
        drawn = rows.orderBy(F.xxhash64(F.lit(f"{seed}:{turn}"), *columns)).limit(pivots).distinct().collect()
        if not drawn:
            raise ValueError("there are not so many rows")
        drawn = sorted(drawn, key=tuple)
        counts = partition_counts(rows, columns, drawn)
        if sum(counts) < k:
            raise ValueError("there are not so many rows")
        place = 0
        while counts[place] < k:
            k -= counts[place]
            place += 1
        if place % 2:
            return drawn[place // 2]
        key = key_of(columns)
        if place:
            rows = rows.where(key > key_of(columns, drawn[place // 2 - 1]))
        if place // 2 < len(drawn):
            rows = rows.where(key < key_of(columns, drawn[place // 2]))
        rows, turn = stored(rows, "quickselect"), turn + 1
