"""Near-duplicate groups by SuperMinHash signatures, banding, exact confirmation and connected components.

1. Rows with equal shingle sets are a class; one row stands for it from then on, however many copies there are.
2. Classes that agree in a band share a bucket. Each is compared with the least class of the bucket on full sets (a star: as many pairs as
   members), and the links give first components.
3. Only buckets that still hold several components are gone through again: members of different components whose signatures agree
   enough are compared on full sets as well, so that no link is lost to the star.

Comparisons happen in cells of bounded size inside tasks; what leaves a cell is at most a forest of its members, never its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import pieces_of, stored
from tallyward.llm.components import components
from tallyward.llm.shingles import mix, shingle_sets
from tallyward.llm.superminhash import band_keys, lanes, signatures

# A pair with the similarity 0.8 misses all 32 bands of 4 with a chance of (1 - 0.8 ** 4) ** 32 < 1e-7.
COMPONENTS = 128
BANDS = 32
PERCENT = 80
# Signatures that agree in a smaller share are not compared on full sets: five standard deviations below PERCENT.
LEAST_AGREEMENT = 0.66
PIECE_BYTES = 1 << 20
# Members of a cell by the kind of comparison: signatures only, or full sets.
SIGNATURE_CELL = 2048
TEXT_CELL = 512
TEXT_CELL_SHINGLES = 1_000_000
# Ids of so many documents at most are broadcast to fetch their texts; more are joined by shuffling.
BROADCAST_ROWS = 500_000

SIGNED = "row_id bigint, doc_id bigint, text_key bigint, n bigint, set_low bigint, set_high bigint, bands array<bigint>, lanes binary"


def signed(docs: DataFrame, words: int, bands: int = BANDS) -> DataFrame:
    """For each row the number of its shingles, a 128-bit hash of their set, and its signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            elements, offsets = shingle_sets(batch.column("text"), words)
            sizes = np.diff(offsets)
            signature = signatures(elements, offsets, COMPONENTS)
            sums = []
            for seed in (11, 12):
                total = np.append(np.uint64(0), np.add.accumulate(mix(elements, seed)))
                sums.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
            keys = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * bands), pa.array(band_keys(signature, bands).reshape(-1))
            )
            bytes_of = lanes(signature)
            arrays = [batch.column(c) for c in ("row_id", "doc_id", "text_key")]
            arrays += [pa.array(sizes.astype(np.int64)), *map(pa.array, sums), keys]
            arrays.append(pa.array([row.tobytes() for row in bytes_of], pa.binary()))
            names = ["row_id", "doc_id", "text_key", "n", "set_low", "set_high", "bands", "lanes"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("bigint"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("string"),
    )
    return rows.mapInArrow(sign, SIGNED)


def _cells(members: DataFrame, main: Column, main_blocks: Column, other_blocks: Column) -> DataFrame:
    """Deal the members of each ``group`` to cells (``kind``, ``low``, ``high``), so that each pair with a member that is not ``main`` meets in one.

    A cell holds a block of the others and a block of the main ones, or two blocks of the others. Pairs of main members need no
    comparison: they are known to belong together, or are no candidates.
    """
    spread = F.abs(F.xxhash64("id") % 2**31)
    with_blocks = members.withColumns({"_main": main, "_mains": main_blocks.cast("int"), "_others": other_blocks.cast("int")})
    with_blocks = with_blocks.withColumn("_block", (spread % F.when(F.col("_main"), F.col("_mains")).otherwise(F.col("_others"))).cast("int"))
    as_main = F.expr("transform(sequence(0, _others - 1), i -> struct(0 as kind, i as low, _block as high))")
    as_other = F.expr(
        "concat(transform(sequence(0, _mains - 1), j -> struct(0 as kind, _block as low, j as high)),"
        " transform(filter(sequence(0, _others - 1), i -> i <> _block),"
        "  i -> struct(1 as kind, least(i, _block) as low, greatest(i, _block) as high)))"
    )
    cells = F.explode(F.when(F.col("_main"), as_main).otherwise(as_other))
    columns = [c for c in members.columns if c != "group"]
    return with_blocks.withColumn("_cell", cells).select("group", "_cell.*", F.col("_main").alias("main"), *columns)


def _merge(labels: np.ndarray, places: np.ndarray) -> None:
    """Give all groups that occur at ``places`` the label of the first of them."""
    groups = np.unique(labels[places])
    if len(groups) > 1:
        labels[np.isin(labels, groups)] = groups[0]


def _in_cells(
    cells: DataFrame, compare: Callable[[pa.Table], Iterator[tuple[int, int]]], prepare: Callable[[pa.Table], dict] | None = None
) -> DataFrame:
    """Edges (``a``, ``b``) that ``compare`` finds in each cell. Cells are sorted together in partitions and streamed."""
    keys = ["group", "kind", "low", "high"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        out: list[tuple[int, int]] = []
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in keys]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            bounds = [0, *changes.tolist(), batch.num_rows]
            for low, high in zip(bounds, bounds[1:], strict=False):
                if low == high:
                    continue
                own = tuple(int(c[low]) for c in columns)
                if own != key and held:
                    out += compare(pa.Table.from_batches(held))
                    held = []
                key = own
                held.append(batch.slice(low, high - low))
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        if held:
            out += compare(pa.Table.from_batches(held))
        if out:
            yield _edges(out)

    # Many more partitions than cells of any one group need: the cells of a large group are dealt to many tasks.
    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(scan, "a bigint, b bigint")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    first, second = zip(*pairs, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["a", "b"])


def _lanes_of(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("lanes").to_pylist()), np.uint8).reshape(-1, COMPONENTS)


def _alike(i: int, places: np.ndarray, lane: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of ``places`` those that can have the similarity: their sizes allow it and their signatures agree enough."""
    places = places[100 * np.minimum(sizes[places], sizes[i]) >= PERCENT * np.maximum(sizes[places], sizes[i])]
    agree = np.count_nonzero(lane[places] == lane[i], axis=1)
    return places[agree >= LEAST_AGREEMENT * COMPONENTS]


def _candidates(table: pa.Table) -> Iterator[tuple[int, int]]:
    """Connect the members that have a candidate in another component: an edge from each to one of its group in the cell."""
    ids, labels, sizes = (table.column(c).to_numpy() for c in ("id", "label", "n"))
    lane, group, found = _lanes_of(table), np.arange(len(ids)), np.zeros(len(ids), bool)
    for i in np.flatnonzero(~table.column("main").to_numpy()):
        alike = np.append(_alike(i, np.flatnonzero(labels != labels[i]), lane, sizes), i)
        if len(alike) > 1:
            _merge(group, alike)
            found[alike] = True
    yield from zip(ids[found].tolist(), ids[group[found]].tolist(), strict=True)


def _links(words: int) -> Callable[[pa.Table], Iterator[tuple[int, int]]]:
    """Links between members of different components, confirmed on full sets; those inside a component that has formed are left out."""

    def compare(table: pa.Table) -> Iterator[tuple[int, int]]:
        ids, labels, sizes = (table.column(c).to_numpy() for c in ("id", "label", "n"))
        lane, group = _lanes_of(table), np.unique(labels, return_inverse=True)[1]
        elements, offsets = shingle_sets(table.column("text").combine_chunks(), words)
        for i in np.flatnonzero(~table.column("main").to_numpy()):
            mine = elements[offsets[i] : offsets[i + 1]]
            for j in _alike(i, np.flatnonzero(group != group[i]), lane, sizes):
                if group[i] == group[j]:
                    continue
                other = elements[offsets[j] : offsets[j + 1]]
                at = np.searchsorted(mine, other).clip(max=len(mine) - 1)
                shared = int(np.count_nonzero(mine[at] == other))
                if 100 * shared >= PERCENT * (len(mine) + len(other) - shared):
                    _merge(group, np.array([i, j]))
                    yield int(ids[i]), int(ids[j])

    return compare


def _with_texts(members: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Add signature and text of each member's class. Texts are read again from the documents, by id and hash of the text."""
    wanted = stored(members.select("id").distinct().join(classes, "id").select("id", "doc_id", "text_key"), "dup-wanted")
    few = wanted.count() <= BROADCAST_ROWS
    texts = docs.select(F.col("doc_id").cast("bigint").alias("own_id"), F.xxhash64("text").alias("own_key"), "text")
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key"))
    texts = texts.join(F.broadcast(wanted) if few else wanted, same).select("id", "text").dropDuplicates(["id"])
    return members.join(classes.select("id", "n", "lanes"), "id").join(texts, "id")


def _text_blocks() -> Column:
    """Into how many blocks a group is cut, so that a cell holds neither too many texts nor too long ones."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / TEXT_CELL), F.ceil(F.sum("n") / TEXT_CELL_SHINGLES)).alias("blocks")


def _grouped(docs: DataFrame, words: int) -> DataFrame:
    """Each row's ``doc_id``, ``text_key`` and ``n``, and ``root`` (number) and ``component`` (least id) of its component; none without words."""
    rows = stored(signed(docs, words), "dup-signed")
    # 1. Classes of equal sets, named by their first row.
    named = rows.where("n > 0").groupBy("set_low", "set_high", "n").agg(F.min("row_id").alias("id"), F.min("doc_id").alias("least_id"))
    named = stored(named, "dup-named")
    classes = rows.select("row_id", "doc_id", "text_key", "bands", "lanes").join(
        named.select("id", "n", "least_id"), F.col("row_id") == F.col("id")
    )
    classes = stored(classes.select("id", "n", "least_id", "doc_id", "text_key", "bands", "lanes"), "dup-classes")

    # 2. Buckets with several classes, and their stars.
    placed = classes.select("id", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(placed.join(shared, "bucket"), "dup-members")
    star = members.where("id <> pivot").select("pivot", "id").distinct()
    star = stored(star, "dup-star")
    sizes = star.join(classes.select("id", "n"), "id").groupBy("pivot").agg(_text_blocks())
    arms = star.join(sizes, "pivot").select(F.col("pivot").alias("group"), "id", "blocks", F.lit(True).alias("arm"))
    centres = sizes.select(F.col("pivot").alias("group"), F.col("pivot").alias("id"), "blocks", F.lit(False).alias("arm"))
    spokes = _cells(arms.union(centres), F.col("arm"), F.col("blocks"), F.lit(1))
    spokes = _with_texts(spokes.withColumn("label", F.col("id")).drop("blocks", "arm"), classes, docs)
    first_links = stored(_in_cells(spokes, _links(words)), "dup-links")
    first = stored(components(first_links), "dup-first")

    # 3. Buckets with several components: candidates by signature, then full sets.
    labelled = members.join(first, F.col("id") == F.col("node"), "left").select(
        "bucket", "id", "pivot", "size", F.coalesce("root", "id").alias("label")
    )
    labelled = stored(labelled, "dup-labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("main_label"), F.max("label").alias("last")).where("main_label < last")
    blocks = F.ceil(F.col("size") / SIGNATURE_CELL)
    open_members = labelled.join(mixed.select("bucket", "main_label"), "bucket").join(classes.select("id", "n", "lanes"), "id")
    open_members = open_members.select(F.col("bucket").alias("group"), "id", "label", "main_label", "size", "n", "lanes")
    cells = _cells(open_members, F.col("label") == F.col("main_label"), blocks, blocks).drop("main_label", "size")
    near = stored(_in_cells(cells, _candidates), "dup-near")
    communities = stored(components(near), "dup-communities")
    communities = communities.join(first.withColumnRenamed("root", "label"), "node", "left").select(
        F.col("root").alias("group"), F.col("node").alias("id"), F.coalesce("label", "node").alias("label")
    )
    communities = stored(communities, "dup-groups")
    sizes = communities.join(classes.select("id", "n"), "id").groupBy("group").agg(_text_blocks(), F.min("label").alias("main_label"))
    blocks = F.col("blocks")
    cells = _cells(communities.join(sizes, "group"), F.col("label") == F.col("main_label"), blocks, blocks)
    cells = _with_texts(cells.drop("main_label", "blocks"), classes, docs)
    more_links = stored(_in_cells(cells, _links(words)), "dup-more-links")
    edges = first.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more_links)
    final = stored(components(edges), "dup-components")

    # The least id of each component, and of each row through its class.
    rooted = named.join(final, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component"))
    of_class = rooted.join(least, "root").select(
        F.col("set_low").alias("low_"), F.col("set_high").alias("high_"), F.col("n").alias("n_"), "root", "component"
    )
    of_class = stored(of_class, "dup-of-class")
    same = (F.col("set_low") == F.col("low_")) & (F.col("set_high") == F.col("high_")) & (F.col("n") == F.col("n_"))
    return rows.select("doc_id", "text_key", "n", "set_low", "set_high").join(of_class, same, "left")


def duplicate_groups(docs: DataFrame, words: int = 5) -> DataFrame:
    """For each row ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Words are what white space separates, A-Z in lower case. Rows whose sets of shingles have a similarity of 0.8 or more are linked;
    a text with fewer words than a shingle is one shingle, and one without words, or a missing one, is linked with nothing.
    ``component_id`` is the least id of the row's component, and a row is ``kept`` if that is its own. Rows with the same id and the
    same text are both kept. Rows without id are named by the least id in their component; where there is none, they are kept.
    """
    component = F.coalesce("component", "doc_id")
    return _grouped(docs, words).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def distinct_documents(documents: DataFrame, words: int = 5) -> DataFrame:
    """The documents with their columns, one of each group of near duplicates: that with the least id, of equal ids the least hash.

    Texts without words are no duplicates of each other. Of rows that are equal in id and text one stays.
    """
    rows = stored(_grouped(documents, words).where("root is not null").select("root", "doc_id", "text_key"), "dup-roots")
    several = rows.groupBy("root").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    )
    several = several.where("rows > 1").select("root", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"))
    known = rows.join(several, "root").groupBy("doc_id", "text_key").agg(
        F.count(F.lit(1)).alias("rows"), F.first(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))).alias("stays")
    )
    known = stored(known, "dup-known")
    # The document travels as a whole, so that no column of it meets one of these names.
    whole = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document"),
        F.col("doc_id").cast("bigint").alias("own_id"),
        F.xxhash64("text").alias("own_key"),
    )

    def of(some: DataFrame, how: str) -> DataFrame:
        few = some.count() <= BROADCAST_ROWS
        keys = some.select("doc_id", "text_key")
        same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key"))
        return whole.join(F.broadcast(keys) if few else keys, same, how)

    kept = of(known.where("not stays or rows > 1"), "left_anti")
    repeated = known.where("stays and rows > 1")
    if not repeated.isEmpty():
        kept = kept.unionByName(of(repeated, "left_semi").dropDuplicates(["own_id", "own_key"]))
    return kept.select("document.*")


def grouped_documents(documents: DataFrame) -> DataFrame:
    """The contract's columns: shingles of two words."""
    return duplicate_groups(documents, words=2)


# Every pair of texts with a common shingle is counted, and the links are followed from each text.
GROUPS_SQL = r"""
with recursive texts as (
  select row_number() over () as node, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents
), sets as (
  select node, doc_id, case when len(words) < 2 then words
    else list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) end as shingles
  from texts
), sizes as (
  select node, doc_id, len(shingles) as n from sets
), each as (
  select node, len(shingles) as n, unnest(shingles) as shingle from sets
), shared as (
  select a.node as a, b.node as b, any_value(a.n) as n_a, any_value(b.n) as n_b, count(*) as common
  from each as a join each as b on a.shingle = b.shingle and a.node < b.node
    and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.node, b.node
), links as (
  select a, b from shared where 100 * common >= 80 * (n_a + n_b - common)
), edges as (
  select a, b from links union all select b, a from links
), reached as (
  select node, node as other from sizes where n > 0
  union
  select reached.node, edges.b from reached join edges on edges.a = reached.other
), named as (
  select reached.node, min(sizes.doc_id) as least from reached join sizes on sizes.node = reached.other group by reached.node
)
select sizes.doc_id, cast(n as bigint) as n_shingles, coalesce(least, doc_id) as component_id, coalesce(doc_id = coalesce(least, doc_id), true) as kept
from sizes left join named using (node)
"""
