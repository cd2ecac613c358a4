"""Sharding by proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; the rank divided by the number of the source's rows is
the row's place on a line from 0 to 1, on which each source is spread evenly. Cutting the sorted line into equal counts
therefore gives every shard the mixture of the whole, up to a row or two of each source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import part_of_key, parts_for, shuffle_key, stored, with_running_total

LAW = "rows"


def interleave(
    docs: DataFrame,
    shards: int,
    stratum: str = "source",
    identity: Sequence[str] = ("doc_id", "text"),
    seed: str = "shards",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Give each row a shard from 0 and a slot in it from 0: columns ``row`` (struct of ``carry``), ``shard``, ``slot``.

    Shards differ by one row at most. A missing stratum is a stratum of its own and comes last among equal places. Rows that
    are equal in ``identity`` are interchangeable; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(stratum).alias("stratum"), shuffle_key(seed, *identity).alias("key"), F.struct(*carry).alias("row")
    )
    rows = stored(rows, "shard-rows")
    counts = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    parts = parts_for(total)

    one = F.lit(1).cast("bigint")
    ranked = with_running_total(
        rows.withColumn("part", part_of_key("key", parts)), "rank", one, ["stratum"], "part", [F.col("key"), F.col("row")]
    )
    counts = counts.withColumnRenamed("stratum", "of_stratum")
    placed = ranked.join(counts, F.col("stratum").eqNullSafe(F.col("of_stratum"))).withColumn(
        "place", (F.col("rank") + F.lit(0.5)) / F.col("n")
    )
    # Each stratum is even on the line, so equal ranges of places hold nearly equal numbers of rows.
    placed = placed.withColumn("part", F.floor(F.col("place") * parts))
    placed = stored(placed.select("stratum", "key", "row", "place", "part"), "shard-places")
    order = [F.col("place"), F.col("stratum").asc_nulls_last(), F.col("key"), F.col("row")]
    lined = with_running_total(placed, "position", one, [], "part", order)
    n = F.lit(max(total, 1))
    shard = F.expr(f"((position + 1) * {shards} - 1) div {max(total, 1)}")
    first = F.floor(F.col("shard") * n / F.lit(shards))
    return (
        lined.withColumn("shard", shard)
        .withColumn("slot", (F.col("position") - F.expr(f"(shard * {max(total, 1)}) div {shards}")).cast("bigint"))
        .select("row", F.col("shard").cast("int").alias("shard"), "slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int, rows_per_file: int = 100_000, **options) -> None:
    """Write whole rows, a folder for each shard, sorted by slot within each file; the original row is the column ``row``."""
    lined = interleave(docs, shards, carry=docs.columns, **options)
    files = lined.repartition("shard", F.expr(f"slot div {rows_per_file}"))
    files.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_documents(documents: DataFrame, shards: int = 16) -> DataFrame:
    """The contract's columns. A missing text has no bytes and the checksum of an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = documents.select(
        "doc_id",
        "source",
        F.md5(text).alias("digest"),
        (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("bigint").alias("text_crc32"),
    )
    lined = interleave(sized, shards, identity=("doc_id", "digest"), carry=("doc_id", "size", "text_crc32"))
    return lined.select(
        "row.doc_id",
        "row.size",
        "row.text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The checksum goes through the bytes with the table of remainders of its polynomial.
SHARD_SQL = """
with remainders as (
  select list(c order by n) as t from (
    select n, list_reduce(list_prepend(n, range(8)), lambda c, i: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) as c
    from (select unnest(range(256)) as n))
), rows as (
  select doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 as size,
    xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: cast('0x' || x as bigint))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as crc,
    md5('shards:' || md5(coalesce(cast(doc_id as varchar), '')) || md5(md5(coalesce(text, '')))) as key
  from documents, remainders
), ranked as (
  select *, row_number() over (partition by source order by key, doc_id) - 1 as rank, count(*) over (partition by source) as n
  from rows
), lined as (
  select *, count(*) over () as total,
    row_number() over (order by (rank + cast(0.5 as double)) / n, source nulls last, key, doc_id) - 1 as position
  from ranked
), cut as (
  select *, ((position + 1) * 16 - 1) // total as shard from lined
)
select doc_id, cast(size as bigint) as size, cast(crc as bigint) as text_crc32, 'rows' as law, cast(shard as integer) as shard,
  cast(position - (shard * total) // 16 as bigint) as slot, cast(null as integer) as grown_shard
from cut
"""
