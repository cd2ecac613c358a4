"""Personal data in texts: regular expressions propose spans, checksums confirm them, words nearby move the score.

The four base kinds are reported whatever their score; the kinds this method adds only from ``LEAST_SCORE`` up. Patterns are applied
so that each text is gone through in time proportional to its length, however long its runs of digits or letters.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import pieces_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
LEAST_SCORE = 0.5
# Score of a confirmed span, and what a context word in the CONTEXT characters before it adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
CONTEXT = 40
CONTEXT_GAIN = 0.3
CONTEXT_LOSS = 0.2
NEAR = {
    "email": re.compile(r"mail|contact|write|schreib|écri|escrib", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login|adresse", re.I),
    "card": re.compile(r"card|visa|credit|master|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"phone|call|mobile|\btel|fax|ruf|appel|llam", re.I),
    "iban": re.compile(r"iban|account|bank|konto|compte|cuenta", re.I),
    "ssn": re.compile(r"\bssn\b|social|security", re.I),
}
AGAINST = {
    "ip": re.compile(r"version|release|\bv$", re.I),
    "card": re.compile(r"order|serial|isbn|tracking", re.I),
    "phone": re.compile(r"serial|version", re.I),
}

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
SSN = re.compile(r"\b(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}\b")

Span = tuple[int, int, str, float]


def luhn(digits: str) -> bool:
    """Whether the check digit is right: every second digit from the right is doubled and its digits added up."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod_97(code: str) -> bool:
    """Whether an account code has the remainder 1: first four characters at the end, letters as 10 to 35."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches from the left: the run before each sign, cut at the end of the match before, and a domain after it."""
    last = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in LOCAL_PART:
            begin -= 1
        if begin < at and (domain := DOMAIN.match(text, at + 1)):
            last = domain.end()
            yield begin, last
        at = text.find("@", at + 1)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """A chain of dotted numbers is taken four at a time."""
    for chain in DOTTED.finditer(text):
        parts = chain[0].split(".")
        begin = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = begin + sum(map(len, four)) + 3
            if all(len(short := part.lstrip("0")) < 4 and int(short or 0) <= 255 for part in four):
                yield begin, end
            begin = end + 1


def _digits(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans as (kind, start, end) in code points."""
    if "@" in text:
        yield from (("email", *span) for span in _emails(text))
    if not DIGIT.search(text):
        return
    yield from (("ip", *span) for span in _addresses(text))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span()
    for m in IBAN.finditer(text):
        if 15 <= len(code := m[0].replace(" ", "")) <= 34 and mod_97(code):
            yield "iban", *m.span()
    for m in SSN.finditer(text):
        yield "ssn", *m.span()


def find_spans(text: str | None) -> list[Span]:
    """(start, end, kind, score) of every span by start, then kind. A missing or empty text has none.

    The words that adjust a score are looked for before a span, where a label stands, and not behind it.
    """
    spans = []
    for kind, start, end in proposals(text or ""):
        nearby = text[max(0, start - CONTEXT) : start]
        score = SCORES[kind]
        if NEAR[kind].search(nearby):
            score += CONTEXT_GAIN
        if kind in AGAINST and AGAINST[kind].search(nearby):
            score -= CONTEXT_LOSS
        if kind in BASE_KINDS or score >= LEAST_SCORE:
            spans.append((start, end, kind, round(min(score, 1.0), 2)))
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2])))


def mask(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; spans that overlap become one."""
    spans = find_spans(text)
    if not spans:
        return text
    out, last = [], 0
    for start, end, kind, _ in spans:
        if start >= last:
            out += [text[last:start], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


SPANS = "array<struct<start:bigint,end:bigint,kind:string,score:double>>"
PIECE_BYTES = 1 << 20


def with_spans(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """``identity`` and ``spans``: an array of (start, end, kind, score) for each row, empty where nothing is found."""
    rows = docs.select(F.col(identity).alias("identity"), F.col(text).cast("string").alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            found = [
                [dict(zip(("start", "end", "kind", "score"), span, strict=True)) for span in find_spans(text.as_py())]
                for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("identity"), pa.array(found, kind)], ["identity", "spans"])

    id_type = rows.schema["identity"].dataType.simpleString()
    return rows.mapInArrow(scan, f"identity {id_type}, spans {SPANS}").withColumnRenamed("identity", identity)


def private_documents(documents: DataFrame) -> DataFrame:
    """The contract's columns, and ``scores``: one for each of ``spans``, in the same order."""

    def joined(spans: str):
        return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")

    base = f"filter(spans, s -> s.kind in {BASE_KINDS})"
    return with_spans(documents).select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        F.expr("array_join(transform(spans, s -> cast(s.score as string)), ',')").alias("scores"),
    )


def masked_documents(documents: DataFrame) -> DataFrame:
    """The documents with personal data masked; ``n_chars`` is that of the masked text. No row is dropped."""
    schema = documents.schema

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", PIECE_BYTES):
            texts = [mask(text.as_py()) for text in batch.column("text")]
            place = batch.schema.get_field_index("text")
            batch = batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
            place = batch.schema.get_field_index("n_chars")
            if place >= 0:
                field = batch.schema.field(place)
                sizes = pa.array([None if text is None else len(text) for text in texts], pa.int64()).cast(field.type)
                batch = batch.set_column(place, field, sizes)
            yield batch

    return documents.mapInArrow(rewrite, schema)
