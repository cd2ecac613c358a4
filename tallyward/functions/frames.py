"""Small helpers that keep several results in one pass over the data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day(as_of: date | None) -> Column:
    """The reference day of a run: the given date, or today."""
    return F.current_date() if as_of is None else F.lit(as_of)


def rows_from_aggregate(df: DataFrame, rows: Iterable[Mapping[str, Column]], keys: Iterable[str] = ()) -> DataFrame:
    """One aggregate over ``df`` whose results come out as several rows.

    Each mapping is one output row, column name to aggregate expression. All of them are evaluated in the same
    scan and the same (map-side combined) aggregation; equal aggregates in several rows are computed once.
    """
    keys = list(keys)
    packed = F.array(*[F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows])
    return df.groupBy(*keys).agg(packed.alias("_rows")).select(*keys, F.inline("_rows"))


def describe(df: DataFrame, descriptions: Mapping[str, str]) -> DataFrame:
    """Attach column comments; they are stored with the table when the frame is saved."""
    return df.select(
        *[
            F.col(name).alias(name, metadata={"comment": descriptions[name]}) if name in descriptions else F.col(name)
            for name in df.columns
        ]
    )
