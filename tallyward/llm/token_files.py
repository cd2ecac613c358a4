"""Files of token ids: documents in ascending order of their ids, each with the token that ends it, packed by Simple-8b.

Spark brings the documents in order and writes the files, on whatever file system the path names, with its commit protocol: a task that
is lost is run again, and readers see whole files only. A file is a row of records, a record some whole documents:

    8 bytes   magic
    8 x u64   bytes of the record, number of its task, its number in the task, documents, ids, blocks, words, escapes
    i64 each  id of each document (0 where it has none)
    u64 each  number of ids of each document, times 2, plus 1 if the document has no id
    u64 each  first word of each block of 4096 ids, and the number of words
    u64 each  place of each escape, then the value of each escape
    u64 each  words
    8 bytes   end mark

All numbers are little-endian, and all parts begin at multiples of 8 bytes. Records sorted by task and number are the whole sequence; the
place of a document in it follows from the sizes of the records before.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.llm import simple8b
from tallyward.llm.common import pieces_of, stored, with_running_total
from tallyward.sources.storage import new_path

VOCABULARY = "word_bpe_49k.json"
END = 2
MAGIC, END_MARK = b"tokids8b", "end8b\r\n\n"
HEADER = 8
PIECE_BYTES = 1 << 20
# A record is closed by the document that brings it to so many ids; a file has so many records at most (some 36 MB).
RECORD_IDS = 1 << 18
RECORDS_PER_FILE = 64
RECORDS_PER_PART = 16
CACHED_WORDS = 3 << 17

# Fixed values of the vocabulary: its split pattern, its special tokens' beginning, and the characters that stand for bytes (printable
# ones of Latin-1 for themselves, the others from 256 on).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPECIAL = "<|"
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LEVEL = {b: b if b in _OWN else 256 + sum(x not in _OWN for x in range(b)) for b in range(256)}
# Up to here normalization leaves characters alone but for their case.
LAST_LATIN = "\u024f"


class Encoder(dict):
    """Ids of texts, 32 bits each, and those of words that were met, as bytes.

    The vocabulary drops white space before it splits words, and nothing in it joins what white space separates, so the ids of a text are
    those of its words in a row. A word of Latin letters is split as the vocabulary's own pattern does, and its pieces, words of their
    own, go straight to the library's model; any other word goes through the whole of it. Beyond ``limit`` words those that were not
    met since the last time are forgotten.
    """

    def __init__(self, vocabulary: str = VOCABULARY, limit: int = CACHED_WORDS):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.tokenize = self.tokenizer.model.tokenize
        self.ids = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.limit, self.older = limit, {}

    def _piece(self, text: str) -> bytes:
        ids = self.ids
        return b"".join([ids[token.id] for token in self.tokenize(text)])

    def _word(self, word: bytes) -> bytes:
        letters = word.rstrip(b".,;:!?")
        if letters.isalpha():  # of ASCII
            if len(letters) == len(word):
                return self._piece(word.decode().lower())
            return self[letters] + self[word[len(letters) :]]
        text = word.decode()
        if not text.isascii() and max(text) > LAST_LATIN or SPECIAL in text:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        text = text.lower()
        pieces = [text] if text.isalpha() else PIECES.findall(text)
        if len(pieces) == 1:
            return self._piece(pieces[0].encode().decode("latin-1").translate(BYTE_LEVEL))
        return b"".join([self[piece.encode()] for piece in pieces])

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._word(word)
        self[word] = ids
        return ids

    def encode(self, text: bytes | None, end: bytes = b"") -> np.ndarray:
        """The ids of a text, and those of ``end``, 32 bits each, behind them."""
        text = text or b""
        if SPECIAL.encode() not in text:
            text = text.lower()
        ids = b"".join([*map(self.__getitem__, text.split()), end])
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        return np.frombuffer(ids, "<u4")


@functools.cache
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def record(task: int, number: int, doc_ids: list[int | None], documents: list[np.ndarray]) -> bytes:
    ids = np.concatenate(documents).astype(np.uint64)
    words, offsets, places = simple8b.encode(ids)
    sizes = np.array([len(one) for one in documents], np.uint64) * np.uint64(2)
    sizes += np.array([doc_id is None for doc_id in doc_ids], np.uint64)
    parts = [np.array([doc_id or 0 for doc_id in doc_ids], "<i8"), sizes, offsets, places.astype(np.uint64), ids[places], words]
    body = b"".join(part.astype("<i8" if part.dtype.kind == "i" else "<u8").tobytes() for part in parts)
    counts = [len(MAGIC) + 8 * HEADER + len(body), task, number, len(documents), len(ids), len(offsets) - 1, len(words), len(places)]
    return MAGIC + np.array(counts, "<u8").tobytes() + body


class Record:
    """A record that is read in place: what is decoded are only the blocks asked for."""

    def __init__(self, content: memoryview):
        if bytes(content[: len(MAGIC)]) != MAGIC:
            raise ValueError("this is no record of token ids")
        counts = np.frombuffer(content, "<u8", HEADER, len(MAGIC)).astype(np.int64).tolist()
        self.bytes, self.task, self.number, documents, self.size, blocks, words, escapes = counts
        at = len(MAGIC) + 8 * HEADER

        def part(kind: str, size: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, size, at)
            at += 8 * size
            return found

        keys, sizes = part("<i8", documents), part("<u8", documents)
        self.offsets, self.places, self.values, self.words = part("<u8", blocks + 1), part("<u8", escapes), part("<u8", escapes), part("<u8", words)
        self.doc_ids = [None if odd else key for key, odd in zip(keys.tolist(), (sizes & np.uint64(1)).tolist(), strict=True)]
        self.sizes = (sizes >> np.uint64(1)).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def ids(self, first: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``first`` to ``end`` of the record, from the blocks that hold them."""
        end = self.size if end is None else end
        low, high = first // simple8b.BLOCK, -(-end // simple8b.BLOCK)
        begin = low * simple8b.BLOCK
        offsets = self.offsets[low : high + 1]
        words = self.words[int(offsets[0]) : int(offsets[-1])]
        found = simple8b.decode(words, offsets - offsets[0], min(high * simple8b.BLOCK, self.size) - begin)
        if len(self.places):
            here = (self.places >= begin) & (self.places < begin + len(found))
            found[(self.places[here] - np.uint64(begin)).astype(np.int64)] = self.values[here]
        return found[first - begin : end - begin]


def records(content: bytes) -> Iterator[Record]:
    """The records of a file."""
    view, mark = memoryview(content), END_MARK.encode()
    while view:
        one = Record(view)
        if bytes(view[one.bytes : one.bytes + len(mark)]) != mark:
            raise ValueError("a record of token ids is cut off")
        yield one
        view = view[one.bytes + len(mark) :]


def write_token_files(documents: DataFrame, path: str, vocabulary: str = VOCABULARY, end: int = END) -> None:
    """Write the ids of ``text``, and the one that ends each document, in ascending order of ``doc_id``.

    Documents without an id come last; those with the same id are in the order of a hash of their text. A missing text is an empty one, so
    the document is its end. Other columns are left out. Ranges of ids are cut by a sample, so that tasks have like numbers of documents.
    """
    given = documents.select(
        F.col("doc_id").isNull().alias("without_id"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("hash"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    order = ["without_id", "doc_id", "hash"]
    ordered = given.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encode_text, last = TaskContext.get().partitionId(), encoder(vocabulary).encode, end.to_bytes(4, "little")
        keys, texts, size, number = [], [], 0, 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([record(task, number, keys, texts)], pa.binary())], ["record"])

        for batch in pieces_of(batches, "text", PIECE_BYTES):
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode_text(text.as_py(), last)
                keys.append(key), texts.append(ids)
                size += len(ids)
                if size >= RECORD_IDS:
                    yield closed()
                    keys, texts, size, number = [], [], 0, number + 1
        if keys:
            yield closed()

    # Text files are the rows' bytes, each followed by the separator, so bytes that are no text are written as they are.
    lines = ordered.mapInArrow(encode, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.options(lineSep=END_MARK, compression="none", maxRecordsPerFile=RECORDS_PER_FILE).text(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document; with ``with_ids`` also its ids, 32 bits each.

    ``start`` is the number of ids of all documents before it.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = "part bigint, number bigint, place bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint, ids binary"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for one in records(content.as_py()):
                    ids = one.ids().astype("<u4")
                    each = [ids[a : a + n].tobytes() for a, n in zip(one.starts.tolist(), one.sizes.tolist(), strict=True)]
                    n = len(each)
                    part = (one.task << 32) + one.number // RECORDS_PER_PART
                    columns = [[part] * n, [one.number] * n, list(range(n)), one.doc_ids, one.sizes, [zlib.crc32(x) for x in each]]
                    arrays = [pa.array(column, pa.int64()) for column in columns]
                    arrays.append(pa.array(each if with_ids else [None] * n, pa.binary()))
                    names = ["part", "number", "place", "doc_id", "n_tokens", "ids_crc32", "ids"]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    found = stored(files.mapInArrow(decode, schema), "token-places")
    placed = with_running_total(found, "start", F.col("n_tokens"), [], "part", [F.col("number"), F.col("place")])
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def filed_documents(documents: DataFrame) -> DataFrame:
    """The contract's columns, read back from files that are written for it."""
    path = new_path(documents.sparkSession, "token-files")
    write_token_files(documents, path)
    return read_token_files(documents.sparkSession, path)
