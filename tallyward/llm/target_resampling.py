"""Importance resampling towards a target: documents are drawn by how much likelier their words are in the target than in the corpus.

Words are hashed into a bounded number of buckets. A document is an array of buckets; the gains of the buckets, one bounded array,
score it by lookups alone. Gumbel noise from a hash of the id makes the highest scores a weighted draw without replacement. The lowest
score that is drawn is found by quickselect, so that only the documents drawn are sorted and ranked.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import pieces_of, stored, with_running_total
from tallyward.llm.quickselect import key_of, kth_key

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
PIECE_BYTES = 1 << 20
CACHED_WORDS = 1 << 18

# Bytes of words stay, upper case of ASCII becomes lower case, all other ASCII separates words.
LETTERS = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)


class BucketOf(dict):
    """The bucket of a feature; so many features are remembered, the others are hashed each time."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(self) < CACHED_WORDS:
            self[feature] = bucket
        return bucket


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def features_of(words: list[bytes], longest: int = LONGEST) -> list[bytes]:
    """All runs of 1 to ``longest`` consecutive words, joined by one space."""
    runs = [b" ".join(words[i : i + n]) for n in range(2, longest + 1) for i in range(len(words) - n + 1)]
    return words + runs if runs else words


def hashed(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, carry: Sequence[str] = (), text: str = "text") -> DataFrame:
    """(row, n_words, buckets) of each text: a struct of the columns in ``carry``, its words, its features' buckets, 32 bits each."""
    given = texts.select(F.struct(*carry).alias("row") if carry else F.lit(None).cast("int").alias("row"), F.col(text).cast("string").cast("binary").alias("text"))
    kind = given.schema["row"].dataType.simpleString()

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = BucketOf(buckets)
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            sizes, arrays = [], []
            for value in batch.column("text"):
                words = words_of(value.as_py())
                features = features_of(words, longest)
                sizes.append(len(words))
                arrays.append(np.fromiter(map(bucket_of.__getitem__, features), "<u4", len(features)).tobytes())
            columns = [batch.column("row"), pa.array(sizes, pa.int64()), pa.array(arrays, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "buckets"])

    return given.mapInArrow(convert, f"row {kind}, n_words bigint, buckets binary")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket comes in all texts: a row per task and bucket is exchanged, a number per bucket is fetched."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for one in batch.column("buckets"):
                total += np.bincount(np.frombuffer(one.as_buffer(), "<u4"), minlength=buckets)
        (there,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there])], ["bucket", "n"])

    parts = features.select("buckets").mapInArrow(count, "bucket bigint, n bigint")
    found = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much likelier each bucket is in the target; every bucket counts once more than it comes."""
    size = len(corpus)
    whole, aim = float(corpus.sum() + size), float(target.sum() + size)
    ratios = ((t + 1) * whole / ((s + 1) * aim) for s, t in zip(corpus.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(row, n_words, n_features, weight): the mean gain of each text's features, rounded down; 0 for a text without any."""
    kind = features.schema["row"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "buckets", PIECE_BYTES):
            arrays = [np.frombuffer(one.as_buffer(), "<u4") for one in batch.column("buckets")]
            sizes = [len(a) for a in arrays]
            weights = [int(gain[a].sum()) // len(a) if len(a) else 0 for a in arrays]
            columns = [batch.column("row"), batch.column("n_words"), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "n_features", "weight"])

    return features.mapInArrow(score, f"row {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(seed: int, key: Column) -> Column:
    """Thousandths of Gumbel noise, the same for the same key in each run. A missing key is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


KEY = ("negative_score", "without_id", "id", "number")


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Draw ``percent`` of the documents that have ``least_words`` words, likest to the ``target`` first.

    Gives (doc_id, row, n_features, weight, score, rank) for every document: ``row`` holds the columns in ``carry``, such as the text;
    ``rank`` counts from 1 and is null for those not drawn. Equal scores go to the smaller id, documents without an id after all
    others. A missing text has no words. Repeated rows are documents of their own; rows that are equal in all but the order in which they
    are read are interchangeable. An empty target leaves only the corpus to compare with, and every gain is still defined.
    """
    own = stored(
        hashed(documents, buckets, longest, ["doc_id", *[c for c in carry if c != "doc_id"]]).withColumn(
            "number", F.monotonically_increasing_id()
        ),
        "resample-features",
    )
    gain = gains(bucket_counts(own, buckets), bucket_counts(hashed(target, buckets, longest), buckets))
    numbered = own.select(F.struct("row", "number").alias("row"), "n_words", "buckets")
    rows = weighed(numbered, gain).select(F.col("row.row").alias("row"), F.col("row.number").alias("number"), "n_words", "n_features", "weight")
    doc_id = F.col("row.doc_id")
    score = F.col("weight") + noise(seed, doc_id)
    rows = rows.select("*", score.alias("score"), (F.col("n_words") >= least_words).alias("eligible"))
    rows = rows.select(
        "*",
        (-F.col("score")).alias("negative_score"),
        doc_id.isNull().alias("without_id"),
        F.coalesce(doc_id.cast("bigint"), F.lit(0).cast("bigint")).alias("id"),
    )
    rows = stored(rows, "resample-scores")

    k = rows.where("eligible").count() * percent // 100
    result = ["row.doc_id", "row", "n_features", "weight", "score"]
    if not k:
        return rows.select(*result, F.lit(None).cast("bigint").alias("rank"))
    last = key_of(KEY, kth_key(rows.where("eligible"), KEY, k))
    drawn = F.col("eligible") & (key_of(KEY) <= last)
    ranges = rows.where(drawn).repartitionByRange(*KEY).withColumn("part", F.spark_partition_id())
    winners = stored(ranges, "resample-winners")
    ranked = with_running_total(winners, "before", F.lit(1).cast("bigint"), [], "part", [F.col(c) for c in KEY])
    return ranked.select(*result, (F.col("before") + 1).alias("rank")).unionByName(
        rows.where(~drawn).select(*result, F.lit(None).cast("bigint").alias("rank"))
    )


def resampled_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns."""
    return resample(documents, benchmark).select("doc_id", "n_features", "weight", "score", "rank")


# A feature's checksum goes through its bytes with the table of remainders of the polynomial.
RESAMPLE_SQL = r"""
with remainders as (
  select list(c order by n) as t from (
    select n, list_reduce(list_prepend(n, range(8)), lambda c, i: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) as c
    from (select unnest(range(256)) as n))
), texts as (
  select doc_id, true as own, text from documents union all select item_id, false, text from benchmark
), words as (
  select doc_id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as list
  from texts
), each as (
  select doc_id, own, unnest(list) as word from words
), buckets as (
  select word, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(
      regexp_extract_all(hex(encode(word)), '..'), lambda x: cast('0x' || x as bigint))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 as bucket
  from (select distinct word from each), remainders
), counts as (
  select bucket, count(*) filter (where own) as s, count(*) filter (where not own) as t
  from each join buckets using (word) group by bucket
), sums as (
  select sum(s) as s, sum(t) as t from counts
), gained as (
  select bucket, floor(1000 * ln((cast(counts.t + 1 as double) * cast(sums.s + 10000 as double))
    / (cast(counts.s + 1 as double) * cast(sums.t + 10000 as double)))) as gain
  from counts, sums
), weights as (
  select doc_id, cast(floor(sum(gain) / count(*)) as bigint) as weight
  from each join buckets using (word) join gained using (bucket) where own group by doc_id
), scored as (
  select doc_id, len(list) as n, coalesce(weight, 0) as weight, coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
    (cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) + 0.5::double) / 4294967296.0::double))) as bigint) as score
  from words left join weights using (doc_id) where own
), ranked as (
  select *, row_number() over (partition by n >= 20 order by score desc, doc_id) as place, count(*) over (partition by n >= 20) as among
  from scored
)
select doc_id, cast(n as bigint) as n_features, cast(weight as bigint) as weight, cast(score as bigint) as score,
  case when n >= 20 and place <= 10 * among // 100 then place end as rank
from ranked
"""
