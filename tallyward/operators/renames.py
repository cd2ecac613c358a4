"""Renamed columns: a column that went and one that came, which hold the same values for the same rows.

Schemas alone show a rename as a removal and an addition. Each of the columns concerned is summed up by a theta sketch, all of a state in
one aggregate; the sketches of removed and added columns of the same kind are matched by their intersection. Only sketches meet, one for each
column, and no rows are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

from tallyward.functions.frames import rows_from_aggregate

# 2 ** 14 values are kept of each column: the share of common ones is right to about one percent.
NOMINAL_LOG2 = 14
LEAST_COMMON = 0.9
LEAST_VALUES = 10


def _kind(kind: DataType) -> str:
    return "number" if isinstance(kind, NumericType) else kind.typeName()


def column_sketches(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(column_name, kind, sketch) of the values of each column, each together with the key of its row. Missing values stay out."""
    # Absent fields are the missing parts of a key, so different keys have different texts.
    key = F.to_json(F.struct(*keys)) if keys else F.lit("")

    def of(name: str) -> Column:
        number = isinstance(df.schema[name].dataType, NumericType)
        value = (F.col(name).cast("double") + F.lit(0.0) if number else F.col(name)).cast("string")
        return F.theta_sketch_agg(F.concat(key, F.lit("="), value), F.lit(NOMINAL_LOG2))

    rows = [{"column_name": F.lit(name), "kind": F.lit(_kind(df.schema[name].dataType)), "sketch": of(name)} for name in columns]
    return rows_from_aggregate(df, rows)


def column_matches(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str] = (),
    least_common: float = LEAST_COMMON,
    least_values: int = LEAST_VALUES,
) -> DataFrame:
    """(removed, added, kind, common, is_rename) for each removed and added column of the same kind.

    ``common`` is the estimated share of the values of the column with fewer of them that the other has too. It is a rename if that is
    ``least_common`` or more of at least ``least_values`` values, and neither column has a better match. ``keys`` (which both states have)
    name the rows: without them only sets of values are compared, and columns with few different values can look alike. Rows that have come
    or gone in between do no harm. Where nothing was removed, or nothing added, no rows are read.
    """
    removed = [name for name in before.columns if name not in after.columns]
    added = [name for name in after.columns if name not in before.columns]
    if not removed or not added:
        schema = "removed string, added string, kind string, common double, is_rename boolean"
        return before.sparkSession.createDataFrame([], schema)
    old = column_sketches(before, removed, keys).withColumnsRenamed({"column_name": "removed", "sketch": "old"})
    new = column_sketches(after, added, keys).withColumnsRenamed({"column_name": "added", "sketch": "new"})
    both = F.theta_sketch_estimate(F.theta_intersection("old", "new"))
    fewer = F.least(F.theta_sketch_estimate("old"), F.theta_sketch_estimate("new"))
    pairs = old.join(new, "kind").select("removed", "added", "kind", F.try_divide(both, fewer).cast("double").alias("common"), fewer.alias("_values"))

    def best(of: str, other: str) -> Column:
        return F.row_number().over(Window.partitionBy(of).orderBy(F.col("common").desc_nulls_last(), other)) == 1

    enough = (F.col("common") >= least_common) & (F.col("_values") >= least_values)
    ranked = pairs.select("*", best("removed", "added").alias("_best_old"), best("added", "removed").alias("_best_new"))
    rename = F.coalesce(enough & F.col("_best_old") & F.col("_best_new"), F.lit(False))
    return ranked.select("removed", "added", "kind", F.coalesce("common", F.lit(0.0)).alias("common"), rename.alias("is_rename"))


def renamed_columns(before: DataFrame, after: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(removed, added) of the columns that were renamed."""
    return column_matches(before, after, keys).where("is_rename").select("removed", "added")
