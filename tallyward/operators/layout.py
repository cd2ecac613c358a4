"""Files laid out so that filters on any of several columns prune them.

Sorting by one column leaves every file with all values of the others. Here each column's values are cut into equally frequent ranges,
and the rows are ordered by the interleaved bits of their ranges: rows that lie close in that order are close in every column, so each file
covers a small part of each. The statistics in the footers of Parquet then let a reader skip most files, whichever column it filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampType

BITS = 6
PREFIX_BYTES = 7


def _as_number(column: str, kind: DataType) -> Column:
    """A number that orders as the column does; texts by their first bytes."""
    value = F.col(column)
    if isinstance(kind, NumericType):
        return value.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, StringType):
        prefix = F.hex(F.substring(F.encode(value, "UTF-8"), 1, PREFIX_BYTES))
        return F.conv(F.rpad(prefix, 2 * PREFIX_BYTES, "0"), 16, 10).cast("double")
    raise ValueError(f"{column} has no order to lay files out by")


def cut_points(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """For each column the values that cut it into 2 ** ``bits`` equally frequent ranges, from one aggregate of mergeable sketches."""
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    sketches = [F.percentile_approx(_as_number(c, df.schema[c].dataType), shares, F.lit(100 * 2**bits)).alias(c) for c in columns]
    found = df.agg(*sketches).first()
    return {c: list(found[c] or []) for c in columns}


def _range_of(value: Column, points: Sequence[float]) -> Column:
    """How many of the points lie at or below the value; 0 for a missing one."""
    given = F.array(*[F.lit(point) for point in points])
    return F.when(value.isNull(), 0).otherwise(F.size(F.filter(given, lambda point: point <= value)))


def interleaved(df: DataFrame, cuts: dict[str, list[float]], bits: int = BITS) -> Column:
    """The bits of the columns' ranges, the highest of all columns first. A missing value lies in the first range."""
    code = F.lit(0).cast("bigint")
    for j, (column, points) in enumerate(cuts.items()):
        distinct = sorted(set(points))
        value = _as_number(column, df.schema[column].dataType)
        place = F.lit(0)
        if distinct:
            # Few different values use the upper bits, so that they count as much as those of other columns.
            place = F.floor(_range_of(value, distinct) * F.lit((2**bits - 1) / len(distinct))).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(place, b).bitwiseAND(F.lit(1).cast("bigint"))
            code = code + F.shiftleft(bit, b * len(cuts) + j)
    return code


def clustered_by(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """The rows in ``files`` partitions along the interleaved bits of ``columns``: write them as they come.

    Reads ``df`` twice, once for the cut points: pass a stored frame.
    """
    kept = df.columns
    code = interleaved(df, cut_points(df, columns, bits), bits)
    coded = df.select(code.alias("code"), F.struct(*kept).alias("row"))
    order = ["code", *[f"row.{c}" for c in columns]]
    laid = coded.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return laid.select("row.*")
