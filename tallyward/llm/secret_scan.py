"""Secret scans: patterns propose findings, a random forest removes the false ones.

The forest sees length and make-up of a candidate, how often it changes between kinds of characters, how much of it consists of words
of the corpus, whether it is part of a path, and which words stand around it. It is trained from labelled findings.

Where people have labelled none, a few findings are labelled by outer evidence: a provider's prefix, or a credential's name with a sign
of assignment before the value. The forest never sees that evidence. It learns what such values look like, and so finds those that
nobody assigns to anything, and removes words, numbers and paths that stand where a credential could.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import pieces_of, stored
from tallyward.llm.language import held_out
from tallyward.llm.shingles import hashed_words, text_bytes
from tallyward.llm.toxicity import NO_LETTER
from tallyward.sources.storage import new_path

PIECE_BYTES = 2 << 20
# The dictionary holds the most frequent words of the corpus, as hashes.
DICTIONARY = 20_000
# The forest is fitted on about so many labelled findings, chosen by a hash.
LEARN_FINDINGS = 20_000
TREES = 20
DEPTH = 8
NEARBY = 40

# Formats in which providers issue credentials.
PROVIDERS = {
    "access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "hosting_token": r"\bgh[pousr]_[A-Za-z0-9]{36,}",
    "chat_token": r"\bxox[abprs]-[A-Za-z0-9-]{10,}",
    "signed_token": r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "private_key": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
    r"(?:(?:[A-Za-z0-9+/=\s:,]|-(?!-))*-----END [A-Z ]{0,20}PRIVATE KEY-----)?",
}
# What tells a format by itself.
PREFIX = re.compile(r"AKIA|ASIA|gh[pousr]_|xox[abprs]-|eyJ|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")
# What a text must hold for the pattern to be tried.
SIGNS = {
    "access_key": ("AKIA", "ASIA"),
    "hosting_token": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "chat_token": ("xox",),
    "signed_token": ("eyJ",),
    "private_key": ("-----BEGIN",),
}
KEYWORDS = r"(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|credential)s?"
ASSIGNED = re.compile(rf"(?i){KEYWORDS}[\"']?[ \t]{{0,3}}[:=][ \t]{{0,3}}[\"']?([^\s\"',;]{{6,}})")
RUN = re.compile(r"[A-Za-z0-9+/_.~-]{12,}={0,2}")
FORMATS = {name: re.compile(pattern) for name, pattern in PROVIDERS.items()}
RULES = (*PROVIDERS, "assigned", "run")

KEYWORD_NEAR = re.compile(rf"(?i){KEYWORDS}")
NAME_NEAR = re.compile(rf"(?i)[\w-]*{KEYWORDS}[\w-]*")
HARMLESS_NEAR = re.compile(r"(?i)example|sample|dummy|placeholder|commit|checksum|sha\d*|md5|uuid|version|isbn")
DIGIT = re.compile(r"[0-9]")
WITH_DIGIT = re.compile(r"(?<!\S)[^\s\d]*+\d\S*")
TURN = re.compile(r"[a-z][A-Z]")
NEAR_WORD = re.compile(r"[^\W\d_]{2,}")
HEX = re.compile(r"[0-9a-fA-F]+")
HARMLESS = re.compile(
    r"[0-9.+-]+|[^0-9]+|(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}|(?:[\w.-]*/){2,}[\w.-]*|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
)
# Of values that are assigned to a credential, what is plainly a number or a path, and what may be words.
PLAIN = re.compile(r"[0-9.+-]+|(?:~|\.{1,2})?(?:/[a-z_.-]+[0-9]{0,4}(?:\.[a-z0-9]{1,5})?)+/?")
# Of a value with digits such a share of the letters in known words makes it words, a file's name or a date.
WORDY = 0.8
WORD = r"(?:[A-Z]?[a-z]{2,}|[A-Z]{3,})"
WORDS = re.compile(rf"{WORD}(?:[ _./-]{WORD})*[.!?)]*")


def mixed(found: str) -> bool:
    """Letters that change from small to capital again and again, as in a random key and unlike in words."""
    return len(found) >= 20 and len(TURN.findall(found)) >= 4


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, rule) in code points, by start; of proposals that overlap the first rule in the order of ``RULES`` stays."""
    found = []
    for name, pattern in FORMATS.items():
        if any(sign in text for sign in SIGNS[name]):
            found += [(m.start(), m.end(), name) for m in pattern.finditer(text)]
    if "=" in text or ":" in text:
        found += [(*m.span(1), "assigned") for m in ASSIGNED.finditer(text)]
    found += [(*m.span(), "run") for m in RUN.finditer(text) if DIGIT.search(m[0]) or mixed(m[0])]
    found.sort(key=lambda x: (RULES.index(x[2]), x[0]))
    taken: list[tuple[int, int, str]] = []
    if len(found) > 1:
        covered = bytearray(len(text))
        for start, end, rule in found:
            if not any(covered[start:end]):
                covered[start:end] = b"\1" * (end - start)
                taken.append((start, end, rule))
        return sorted(taken)
    return found


def kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3


# The words around a candidate are counted in so many classes, by a hash.
NEAR_CLASSES = 12
NAMES = (
    "length digits lower upper other transitions distinct entropy longest_run hex words slashes dots path harmless "
    + " ".join(f"near_{i}" for i in range(NEAR_CLASSES))
).split()
# What findings without people's labels are labelled by: seen only where people have labelled.
TOLD = ("quoted", "assigned", "keyword")


def known_words(found: str, dictionary: np.ndarray) -> list[tuple[str, bool]]:
    """The words of a candidate (three letters and more) and whether the dictionary has them."""
    words = pa.array(re.findall(r"[A-Za-z]{3,}", found), pa.string())
    if not len(words) or not len(dictionary):
        return [(w, False) for w in words.to_pylist()]
    hashes, _ = hashed_words(*text_bytes(words), NO_LETTER)
    known = dictionary[np.searchsorted(dictionary, hashes).clip(max=len(dictionary) - 1)] == hashes
    return list(zip(words.to_pylist(), known.tolist(), strict=True))


def describe(text: str, start: int, end: int, dictionary: np.ndarray, told: bool = False) -> list[float]:
    """The features of a candidate, in the order of ``NAMES`` and, where ``told``, ``TOLD``.

    Otherwise nothing of the outer evidence is seen: the prefix of a format is cut off, and the names of credentials are no words.
    """
    before, after = text[max(0, start - NEARBY) : start], text[end : end + NEARBY]
    if not told and (prefix := PREFIX.match(text, start, end)) and prefix.end() < end:
        start = prefix.end()
    found, size = text[start:end], end - start
    kinds = [kind(c) for c in found]
    counts = Counter(kinds)
    changes = [i for i in range(1, size) if kinds[i] != kinds[i - 1]]
    bounds = [0, *changes, size]
    letters = Counter(found)
    entropy = -sum(n / size * math.log2(n / size) for n in letters.values())
    covered = sum(len(w) for w, k in known_words(found, dictionary) if k)
    near = [0.0] * NEAR_CLASSES
    for part in (before, after):
        for word in NEAR_WORD.findall(part if told else NAME_NEAR.sub(" ", part)):
            near[zlib.crc32(word.lower().encode()) % NEAR_CLASSES] += 1.0
    features = [
        math.log2(size),
        *(counts[k] / size for k in range(4)),
        len(changes) / max(size - 1, 1),
        len(letters) / size,
        entropy,
        max(b - a for a, b in zip(bounds, bounds[1:], strict=False)) / size,
        float(HEX.fullmatch(found) is not None),
        covered / size,
        float(found.count("/")),
        float(found.count(".")),
        float("://" in before[-12:] or found.startswith(("/", "./", "~/")) or before[-1:] in ("/", "\\") or after[:1] in ("/", "\\")),
        float(HARMLESS_NEAR.search(before) is not None),
        *near,
    ]
    if told:
        last = before.rstrip(" \t\"'")[-1:]
        features += [
            float(before[-1:] in ("'", '"') and before[-1:] == after[:1]),
            float(last in ("=", ":")),
            float(KEYWORD_NEAR.search(before) is not None),
        ]
    return features


def rule_label(text: str, start: int, end: int, rule: str, dictionary: np.ndarray | None = None) -> int | None:
    """The label that a finding has by its form alone, for training without findings that people have labelled.

    Providers' formats, and values with digits that are assigned to a credential, are secrets; numbers, addresses, paths, words without
    a digit and identifiers are not. Of assigned values, and of letters that change between small and capital, with a form that is
    otherwise harmless only numbers, paths in small letters and words of the dictionary are not secrets: a key may be letters only or
    hold slashes. What consists mostly of known words is none where it stands by itself. Everything else is unlabelled.
    """
    found = text[start:end]
    if rule in PROVIDERS:
        return 1
    if "@" in text[max(0, start - 1) : end + 1]:
        return 0
    if HARMLESS.fullmatch(found):
        if PLAIN.fullmatch(found) or (rule != "assigned" and not mixed(found)):
            return 0
        words = known_words(found, dictionary) if dictionary is not None and WORDS.fullmatch(found) else []
        return 0 if words and all(known for _, known in words) else None
    words = [] if dictionary is None else known_words(found, dictionary)
    share = sum(len(w) for w, known in words if known) / max(1, sum(c.isalpha() for c in found))
    if share >= WORDY:
        return 0 if rule == "run" else None
    return 1 if rule == "assigned" and len(found) >= 8 and not share else None


def unassigned(text: str | None) -> str | None:
    """The text without the values that are assigned to a credential, and without what holds a digit: pieces of keys are no words."""
    if text is None:
        return text
    if "=" in text or ":" in text:
        text = ASSIGNED.sub(lambda m: m[0][: m.start(1) - m.start()], text)
    return WITH_DIGIT.sub("", text) if DIGIT.search(text) else text


def frequent_words(docs: DataFrame, size: int = DICTIONARY) -> np.ndarray:
    """Hashes of the most frequent words of all documents (three letters and more do for describing), ascending.

    What is assigned to a credential does not count, nor what stands together with digits, so that in a small corpus a key, or a piece of
    one, is no word.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            words, _ = hashed_words(*text_bytes(pa.array([unassigned(x.as_py()) for x in batch.column("text")], pa.string())), NO_LETTER)
            distinct, counts = np.unique(words, return_counts=True)
            merged, place = np.unique(np.concatenate([held, distinct]), return_inverse=True)
            held_counts = np.bincount(place, np.concatenate([held_counts, counts]), len(merged)).astype(np.int64)
            held = merged
            if len(held) > 1_000_000:
                yield _counts(held, held_counts)
                held, held_counts = held[:0], held_counts[:0]
        if len(held):
            yield _counts(held, held_counts)

    counted = docs.select("text").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(size).select("word").toArrow().column("word").to_numpy()
    return np.sort(top.astype(np.int64).view(np.uint64))


def _counts(words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])


FINDINGS = "doc_id bigint, start bigint, end bigint, rule string, label int, features array<double>"


def proposed(docs: DataFrame, dictionary: np.ndarray, told: bool = False) -> DataFrame:
    """Every candidate of every document with its features (see :func:`describe`) and the label of its form."""

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for start, end, rule in candidates(text or ""):
                    rows.append((doc_id, start, end, rule, rule_label(text, start, end, rule, dictionary), describe(text, start, end, dictionary, told)))
            if rows:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.float64()))
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "end", "rule", "label", "features"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(propose, FINDINGS)


def scan(docs: DataFrame, labelled: DataFrame | None = None, findings: int = LEARN_FINDINGS) -> DataFrame:
    """Every finding with ``score`` (0 to 1) and ``secret``: ``doc_id``, ``held_out``, ``start``, ``end`` (code points), ``rule``.

    ``labelled`` holds findings that people have judged (``doc_id``, ``start``, ``end``, ``label``); without it, the labels that
    findings have by their form serve. Nothing is learned from documents that are held out. With labels of one kind only every finding
    has that one, without any the score is 0.5. A missing or empty text has no finding; repeated rows have theirs each.
    """
    known_to_all = frequent_words(docs.where(~held_out()))
    found = stored(proposed(docs, known_to_all, told=labelled is not None), "secret-candidates")
    if labelled is not None:
        judged = labelled.where("doc_id is not null and label is not null").groupBy("doc_id", "start", "end").agg(F.max("label").alias("label"))
        found = found.drop("label").join(judged, ["doc_id", "start", "end"], "left")
    found = found.withColumn("held_out", held_out())
    known = found.where(F.col("label").isNotNull() & ~F.col("held_out") & F.col("doc_id").isNotNull())
    counts = {row["label"]: row["n"] for row in known.groupBy(F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    columns = ["doc_id", "held_out", "start", "end", "rule"]
    if len(counts) < 2:
        score = F.lit(float(next(iter(counts), 0.5)))
        return found.select(*columns, score.alias("score"), (score >= 0.5).cast("int").alias("secret"))
    # Half of the sample for either label at most, so that the rarer one is kept whole.
    share = {label: findings / 2 / n for label, n in counts.items()}
    least = F.when(F.col("label") > 0, F.lit(share[1])).otherwise(F.lit(share[0]))
    chance = F.pmod(F.xxhash64(F.lit("findings"), "doc_id", "start"), F.lit(2**31)) / F.lit(2**31)
    sample = known.where(chance < least).select(
        F.col("label").cast("double").alias("label"), array_to_vector("features").alias("vector"), "doc_id", "start"
    )
    sample = stored(sample.repartition(4, "doc_id").sortWithinPartitions("doc_id", "start", "label"), "secret-sample")
    forest = RandomForestClassifier(
        featuresCol="vector", numTrees=TREES, maxDepth=DEPTH, seed=29, probabilityCol="shares", rawPredictionCol="votes", predictionCol="chosen"
    ).fit(sample.select("label", "vector"))
    # A fitted model holds on to the session through its summary, which tasks cannot be sent; a stored one is trees only.
    path = new_path(docs.sparkSession, "secret-forest")
    forest.write().save(path)
    judged = RandomForestClassificationModel.load(path).transform(found.withColumn("vector", array_to_vector("features")))
    judged = judged.withColumn("score", vector_to_array("shares")[1])
    return judged.select(*columns, "score", (F.col("score") >= 0.5).cast("int").alias("secret"))


def scanned_documents(documents: DataFrame) -> DataFrame:
    return scan(documents)
