"""Spans against the plain patterns, and defined results for odd rows."""

from __future__ import annotations

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.llm import privacy
from tallyward.llm.queries import QUERIES

# Fixed values of the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    found += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        if 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0:
            found.append((m.start(), m.end(), "card"))
    found += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found, key=lambda x: (x[0], privacy.KINDS.index(x[2])))


def base(text: str) -> list[tuple[int, int, str]]:
    return [span[:3] for span in privacy.find_spans(text) if span[2] in privacy.BASE_KINDS]


@settings(max_examples=600, deadline=None)
@given(st.text("a@.-+ 0123459%é(", max_size=60))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert base(text) == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a.b@c.de", "@", "1.2.3.4", ".5", "4111 1111 1111 1111", "-", "+1 (555) 123-4567", " ", "x", "256.1.1.1"]), max_size=12))
def test_joined_parts(parts):
    text = "".join(parts)
    assert base(text) == plain(text)


def test_checksums():
    assert privacy.luhn("4111111111111111") and not privacy.luhn("4111111111111112")
    assert privacy.mod_97("DE89370400440532013000") and not privacy.mod_97("DE89370400440532013001")


def test_added_kinds_need_their_checksum_or_context():
    assert [s[2] for s in privacy.find_spans("konto DE89 3704 0044 0532 0130 00.")] == ["iban"]
    assert privacy.find_spans("konto DE89 3704 0044 0532 0130 01.") == []
    assert [s[2] for s in privacy.find_spans("ssn: 123-45-6789")] == ["ssn"]
    assert privacy.find_spans("part 123-45-6789") == []


def test_context_moves_the_score():
    near, far, against = (privacy.find_spans(f"{words} 10.0.0.1")[0][3] for words in ("ip address", "zzz", "version"))
    assert against < far < near


@pytest.mark.parametrize("text", ["a" * 300_000 + " x@", "1" * 300_000, "+1" + " " * 300_000, "1." * 150_000, "a@" * 100_000, "+1 (" * 80_000])
def test_long_runs_take_linear_time(text):
    started = time.perf_counter()
    privacy.find_spans(text)
    assert time.perf_counter() - started < 3


def test_mask():
    assert privacy.mask("write a@b.cd or +1 555 123 4567!") == "write [EMAIL] or [PHONE]!"
    assert privacy.mask(None) is None and privacy.mask("") == ""


def test_odd_rows(spark):
    rows = [(1, None, "x"), (None, "a@b.cd", "x"), (2, "", None), (2, "a@b.cd", "y"), (2, "a@b.cd", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = sorted(privacy.private_documents(docs).collect(), key=str)
    assert len(out) == 5
    empty = hashlib.sha256(b"").hexdigest()
    assert sum(r.base_sha256 == empty and r.spans == "" for r in out) == 2
    assert [r.spans for r in out if r.doc_id is None] == ["email:0:6"]
    assert privacy.private_documents(docs.where("false")).count() == 0
    assert [r.text for r in privacy.masked_documents(docs).where("spans = 'y'").collect()] == ["[EMAIL]"] * 2


def test_query_over_whole_table(spark):
    directory = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in QUERIES["op6_private_data"](spark, directory).collect()}
    docs = spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(found) == len(docs)
    for doc in docs:
        spans = plain(doc.text)
        row = found[doc.doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[2] == k for s in spans) for k in privacy.BASE_KINDS]
        joined = ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in found.values()) > 0
