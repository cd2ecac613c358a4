"""What several operators share: stored intermediate tables, running totals without a single large group, slices of batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.sources.storage import new_path

# Of a table that is cut by a hash, one part has about so many rows: few enough that the parts of a large group spread over all tasks.
ROWS_PER_PART = 2_048


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the folder that all executors share and read it back.

    Cuts the lineage: an executor that is lost afterwards costs no recomputation, and numbers given to rows stay as they are.
    """
    path = new_path(df.sparkSession, f"llm-{purpose}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(rows: int, per_part: int = ROWS_PER_PART) -> int:
    return max(1, -(-rows // per_part))


def shuffle_key(seed: str, *columns: str) -> Column:
    """A hexadecimal key that orders rows at random, the same in each run: the hash of the seed and of the columns' hashes."""
    return F.md5(F.concat(F.lit(f"{seed}:"), *[F.md5(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]))


def part_of_key(key: str, parts: int) -> Column:
    """The part of the key's range that a row falls in, in the order of the keys."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") * F.lit(parts) / F.lit(2**32)).cast("bigint")


def with_running_total(
    df: DataFrame, name: str, value: Column, group: Sequence[str], part: str, order: Sequence[Column]
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before this one in its group.

    ``part`` cuts each group into ranges of the order, so that no task sorts a whole group. Totals of the parts (one row each)
    are summed up apart and joined to the sums within a part. ``df`` is read twice: pass a stored table.
    """
    columns = df.columns
    inner = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, part).agg(F.sum(value).alias("_total"))
    totals = totals.select(
        *[F.col(c).alias(f"_{c}") for c in (*group, part)],
        F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_before"),
    )
    rows = df.withColumn("_within", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    matching = None
    for c in (*group, part):
        same = F.col(c).eqNullSafe(F.col(f"_{c}"))
        matching = same if matching is None else matching & same
    return rows.join(totals, matching).select(*columns, (F.col("_before") + F.col("_within")).cast("bigint").alias(name))


def pieces_of(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece have at most ``limit`` bytes together; a longer text is a piece of its own.

    Memory that a batch leaves unused goes back to the system, as a worker shares it with the executor's.
    """
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)
        del batch, texts, sizes
        pa.default_memory_pool().release_unused()
