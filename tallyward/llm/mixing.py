"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Slot k of the schedule belongs to the source in whose interval of the cumulative weights the k-th golden-ratio point lies,
so that every stretch of the schedule is close to the targets. The slots of a source are ranked, its shuffled documents form
a stream of words that is cut into as many equal blocks as it has slots, and the r-th slot is joined to the r-th block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import part_of_key, parts_for, shuffle_key, stored, with_running_total

# The schedule has about so many slots, and up to three for each source of few words; a block holds the total divided by it, but at least LEAST_BLOCK words.
SLOTS = 2**20
LEAST_BLOCK = 16
# Words of a source are used at most so often.
REPEATS = 3
# Golden ratio as a fraction GOLDEN / POINTS of two Fibonacci numbers: of N < POINTS points the largest gap is below 2 / N.
POINTS = 2971215073
GOLDEN = 1836311903
# Intervals of the weights are found by their upper bits.
CELL = 2**20

WORDS = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """From a row per source (``source``, ``source_size``) the words to take from it: ``number``, ``target``.

    Sources in the order of their names, a missing one last, weigh 1, 2, 3, 1, ... and share all words by weight. A target
    stops at ``repeats`` times its source; what is left over goes to the others by weight. Sorted by the weight at which they are
    full, full sources come first, so running sums decide in one step what sharing out again and again would end with.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_room = Window.orderBy(F.col("room") / F.col("weight"), "number")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    sources = (
        sizes.withColumn("number", F.row_number().over(by_name))
        .withColumn("weight", ((F.col("number") - 1) % 3 + 1).cast("bigint"))
        .withColumn("room", F.col("source_size") * repeats)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("room").over(before), F.lit(0)))
        .withColumn(
            "weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
        )
        .withColumn("full", F.col("room") * F.col("weight_left") <= F.col("left") * F.col("weight"))
        .withColumn("shared", F.col("total") - F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(everything))
        .withColumn("sharing", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything))
    )
    share = (F.col("shared") * F.col("weight")).cast("double") / F.col("sharing")
    target = F.when(F.col("full"), F.col("room").cast("double")).otherwise(share)
    return sources.select("source", "number", "source_size", "total", target.alias("target"))


def _schedule(sources: DataFrame, block: int) -> DataFrame:
    """Rows ``slot``, ``number`` (of the source), ``rank`` (of the slot in its source, from 0).

    An interval is at least three blocks long and there is a slot for each block of all intervals, so that the points, whose largest
    gap is less, meet every source.
    """
    up_to = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.floor("target").cast("bigint")
    sources = sources.withColumn("width", F.when(whole > 0, F.greatest(whole, F.lit(3 * block))).otherwise(0))
    count = -(-(sources.agg(F.sum("width")).first()[0] or 0) // block)
    intervals = (
        sources.withColumn("end", F.sum("width").over(up_to))
        .withColumn("all", F.sum("width").over(Window.partitionBy()))
        .where("width > 0")
        .withColumn("low", F.floor((F.col("end") - F.col("width")) / F.col("all") * POINTS).cast("bigint"))
        .withColumn("high", F.floor(F.col("end") / F.col("all") * POINTS).cast("bigint"))
        .where("low < high")
        .withColumn("cell", F.explode(F.expr(f"sequence(low div {CELL}, (high - 1) div {CELL})")))
        .select("number", "low", "high", "cell")
    )
    spark = sources.sparkSession
    slots = spark.range(count).select(F.col("id").alias("slot"), F.expr(f"(id * {GOLDEN}) % {POINTS}").alias("point"))
    slots = slots.withColumn("cell", F.expr(f"point div {CELL}")).join(intervals, "cell")
    slots = slots.where("low <= point and point < high").select("slot", "number", F.expr("slot div 65536").alias("part"))
    slots = stored(slots, "mix-slots")
    ranked = with_running_total(slots, "rank", F.lit(1).cast("bigint"), ["number"], "part", [F.col("slot")])
    return ranked.select("slot", "number", "rank")


def mix(
    docs: DataFrame,
    size: str = "size",
    source: str = "source",
    identity: Sequence[str] = ("doc_id", "text"),
    seed: str = "mix",
    slots: int = SLOTS,
    carry: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """The documents with a row number and their source's target, and the schedule.

    First frame: ``row_id``, ``row`` (struct of ``carry``), ``size``, ``source_size``, ``target``. Second frame: a row for each piece of
    a document in a slot: ``slot``, ``number`` (of the source), ``row_id``, ``round`` (how often its source was gone through before),
    ``start`` (words of the document before), ``length``; slots in order are the mix. Each source gives the whole words of its target, none more than ``REPEATS`` times. Rows without words
    are in no slot. Equal rows are interchangeable. Up to ``2**30`` slots, and three more for each source of few words.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(source).alias("source"),
        F.col(size).cast("bigint").alias("size"),
        shuffle_key(seed, *identity).alias("key"),
        F.struct(*carry).alias("row"),
    )
    rows = stored(rows, "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = stored(targets(sizes.select("source", "source_size")), "mix-sources")
    found = sizes.agg(F.sum("source_size").alias("words"), F.sum("rows").alias("rows")).first()
    words, total = found["words"] or 0, found["rows"] or 0
    block = max(LEAST_BLOCK, -(-words // slots))
    schedule = stored(_schedule(sources, block), "mix-schedule")

    # Blocks: the stream of a source, gone through again and again up to its target, in as many equal blocks as it has slots.
    of_source = schedule.groupBy("number").agg(F.count(F.lit(1)).alias("blocks"))
    sources = sources.join(of_source, "number", "left").select(
        F.col("source").alias("of_source"),
        "number",
        "source_size",
        "target",
        F.floor("target").cast("bigint").alias("take"),
        F.coalesce("blocks", F.lit(0)).alias("blocks"),
    )
    joined = rows.join(sources, F.col("source").eqNullSafe(F.col("of_source")))
    placed = (
        stored(
            joined.where("size > 0 and take > 0").select(
                "row_id", "number", "size", "source_size", "take", "blocks", "key", part_of_key("key", parts_for(total)).alias("part")
            ),
            "mix-stream",
        )
        .transform(
            lambda df: with_running_total(df, "offset", F.col("size"), ["number"], "part", [F.col("key"), F.col("row_id")])
        )
        .withColumn("round", F.explode(F.expr("sequence(bigint(0), (take - 1) div source_size)")))
        .withColumn("low", F.col("round") * F.col("source_size") + F.col("offset"))
        .withColumn("high", F.least(F.col("low") + F.col("size"), F.col("take")))
        .where("low < high")
        .withColumn("even", F.expr("take div blocks"))
        .withColumn("longer", F.expr("take % blocks"))
        .withColumn("turn", F.expr("longer * (even + 1)"))
    )
    # The first `longer` blocks have a word more than the others.
    block_of = "if({0} < turn, {0} div (even + 1), longer + ({0} - turn) div greatest(even, bigint(1)))"
    pieces = (
        placed.withColumn("rank", F.explode(F.expr(f"sequence({block_of.format('low')}, {block_of.format('(high - 1)')})")))
        .withColumn("begin", F.greatest(F.expr("rank * even + least(rank, longer)"), F.col("low")))
        .withColumn("end", F.least(F.expr("(rank + 1) * even + least(rank + 1, longer)"), F.col("high")))
    )
    pieces = pieces.select(
        "number",
        "rank",
        "row_id",
        "round",
        (F.col("begin") - F.col("low")).alias("start"),
        (F.col("end") - F.col("begin")).alias("length"),
    )
    mixed = schedule.join(pieces, ["number", "rank"]).select("slot", "number", "row_id", "round", "start", "length")
    return joined.select("row_id", "row", "size", "source_size", "target"), mixed


def taken(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents with ``taken``: the words that the mix takes from each, repeats counted."""
    sums = mixed.groupBy("row_id").agg(F.sum("length").alias("taken"))
    return docs.join(sums, "row_id", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("bigint"))


def counted(documents: DataFrame) -> DataFrame:
    """Sizes in words and a digest of the text. A missing text has no words."""
    return documents.withColumns(
        {"_words": F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("bigint"), "_digest": F.md5("text")}
    )


def mix_documents(documents: DataFrame) -> DataFrame:
    """The contract's columns."""
    docs, mixed = mix(counted(documents.select("doc_id", "source", "text")), "_words", identity=("doc_id", "_digest"), carry=("doc_id",))
    return taken(docs, mixed).select("row.doc_id", "size", "source_size", "target", "taken")


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of so many of its words."""
    pieces = F.regexp_extract_all(text, F.lit(rf"([\x20\x09-\x0D]*{WORDS})"), F.lit(1))
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def mixed_documents(documents: DataFrame, ordered: bool = True) -> DataFrame:
    """The documents of the mix, with their columns: each as often as the mix goes through it.

    A copy stands for one round of its source. The last document of a source's take is cut behind the last word taken (``n_chars``, where
    there is such a column, is then that of the rest), so that the copies together have exactly the words of the mix. With ``ordered``
    they come by the first slot that they have words in; an order that files do not keep, so leave it out for what is stored and
    read again. A document without words is not in the mix.
    """
    columns = documents.columns
    # The document travels as a whole, so that no column of it meets one of these names.
    texts = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "doc_id", "source", "text")
    sized = counted(texts.select("row", "doc_id", "source", "text"))
    docs, mixed = mix(sized, "_words", identity=("doc_id", "_digest"), carry=("row",))
    copies = mixed.groupBy("row_id", "round").agg(F.sum("length").alias("taken"), F.min("slot").alias("slot"))
    rows = docs.select("row_id", "row.row", "size").join(copies, "row_id")
    text = F.when(F.col("taken") < F.col("size"), first_words(F.col("row.text"), F.col("taken"))).otherwise(F.col("row.text"))
    rows = rows.select("slot", "row_id", "round", "row", "taken", "size", text.alias("text"))
    if ordered:
        rows = rows.orderBy("slot", "row_id", "round")
    cut = {"text": F.col("text")}
    if "n_chars" in columns:
        length = F.length("text").cast(documents.schema["n_chars"].dataType)
        cut["n_chars"] = F.when(F.col("taken") < F.col("size"), length).otherwise(F.col("row.n_chars"))
    return rows.select(*[cut.get(c, F.col("row")[c]).alias(c) for c in columns])


# The points are those of the schedule; each is in the interval of one source.
MIX_SQL = r"""
with rows as (
  select row_number() over () as row_id, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('mix:' || md5(coalesce(cast(doc_id as varchar), '')) || md5(coalesce(md5(text), ''))) as key
  from documents
), sizes as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as number from rows group by source
), weighed as (
  select *, (number - 1) % 3 + 1 as weight, 3 * source_size as room, cast(sum(source_size) over () as bigint) as total from sizes
), running as (
  select *,
    total - coalesce(sum(room) over before, 0) as rest, sum(weight) over () - coalesce(sum(weight) over before, 0) as weight_left
  from weighed window before as (order by room / weight, number rows between unbounded preceding and 1 preceding)
), filled as (
  select *, room * weight_left <= rest * weight as full_up from running
), shared as (
  select source, number, source_size, total, cast(case when full_up then cast(room as double)
    else cast((total - sum(case when full_up then room else 0 end) over ()) * weight as double)
      / sum(case when full_up then 0 else weight end) over () end as double) as target
  from filled
), widths as (
  select *, cast(floor(target) as bigint) as take, greatest(16, -(-total // 1048576)) as block from shared
), ends as (
  select *, case when take > 0 then greatest(take, 3 * block) else 0 end as width,
    cast(sum(case when take > 0 then greatest(take, 3 * block) else 0 end) over (order by number) as bigint) as stop,
    cast(sum(case when take > 0 then greatest(take, 3 * block) else 0 end) over () as bigint) as everything
  from widths
), points as (
  select slot, (slot * 1836311903) % 2971215073 as point
  from (select unnest(range((select any_value(-(-everything // block)) from ends))) as slot)
), slots as (
  select number, count(*) as blocks from points, ends
  where width > 0 and point >= floor(cast(stop - width as double) / everything * 2971215073)
    and point < floor(cast(stop as double) / everything * 2971215073)
  group by number
), stream as (
  select row_id, number, size, sum(size) over (partition by number order by key, row_id) - size as low, source_size, take
  from rows join ends on rows.source is not distinct from ends.source
), sums as (
  select row_id, sum(greatest(0, least(low + round * source_size + size, take) - least(low + round * source_size, take))) as taken
  from stream, (select unnest([0, 1, 2]) as round) where number in (select number from slots) group by row_id
)
select doc_id, cast(size as bigint) as size, ends.source_size, target, cast(coalesce(taken, 0) as bigint) as taken
from rows join ends on rows.source is not distinct from ends.source left join sums on sums.row_id = rows.row_id
"""
