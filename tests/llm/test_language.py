"""Profiles and distances against a plain count, held-out accuracy, odd rows."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import language
from tallyward.llm.queries import QUERIES


def plain_grams(text: str) -> Counter:
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    found: Counter = Counter()
    for word in words:
        found.update(word)
        padded = f" {word} "
        for n in (2, 3):
            found.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return found


def number(gram: str) -> int:
    value = 0
    for c in gram:
        value = (value << language.BITS) | (language.GAP if c == " " else ord(c))
    return value


@settings(max_examples=300, deadline=None)
@given(st.text("abé ß.İ1\n日", max_size=40))
def test_grams_are_those_of_the_words(text):
    distinct, counts = language.counted(text)
    assert dict(zip(distinct.tolist(), counts.tolist(), strict=True)) == {number(g): n for g, n in plain_grams(text).items()}


def plain_distance(text: str, profile: list[str], size: int) -> int:
    mine = [g for g, _ in sorted(plain_grams(text).items(), key=lambda x: (-x[1], number(x[0])))][:size]
    return sum(abs(profile.index(g) - i) if g in profile else size for i, g in enumerate(mine))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abcd ", min_size=3, max_size=30).filter(str.strip), min_size=2, max_size=4), st.text("abcde ", max_size=30))
def test_prediction_has_the_least_distance(samples, text):
    size = 12
    lists = {f"l{i}": [g for g, _ in sorted(plain_grams(s).items(), key=lambda x: (-x[1], number(x[0])))][:size] for i, s in enumerate(samples)}
    profiles = language.Profiles({name: [number(g) for g in grams] for name, grams in lists.items()}, size)
    name, score = profiles.predict(text)
    if not text.strip():
        assert (name, score) == ("und", 0.0)
        return
    distances = {n: plain_distance(text, grams, size) for n, grams in lists.items()}
    assert name == min(sorted(distances), key=distances.get)
    assert score == pytest.approx(1 - distances[name] / (min(size, len(plain_grams(text))) * size))


def test_held_out_accuracy(spark):
    directory = "/root/testdata/sf0.01"
    found = QUERIES["op3_language"](spark, directory).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{directory}/documents.parquet").collect()}
    assert len(found) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    unseen = [r for r in found if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in unseen) >= 0.97 * len(unseen)
    kept = language.recognised_documents(spark.read.parquet(f"{directory}/documents.parquet"))
    assert kept.count() == len(docs) and kept.columns == list(docs[1].asDict())


def test_nothing_of_a_held_out_document_is_learned(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = spark.createDataFrame([(i, "secret words", "xx") for i in ids] + [(None, "no id", "yy")], "doc_id long, text string, lang string")
    assert language.learn(docs).names == []
    assert {(r.lang_pred, r.score) for r in language.identify_documents(docs).collect()} == {("und", 0.0)}


def test_every_language_has_a_profile(spark):
    """The rarest of 301 languages, each with letters of its own."""

    def words(lang):
        return " ".join(chr(0x4E00 + 40 * lang + i) * 2 for i in range(40))

    fine = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 5]
    rows = [(fine[3 * lang + i], words(lang), f"l{lang:03}") for lang in range(300) for i in range(3)] + [(fine[900], words(300), "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify_documents(docs).collect()}
    assert found == {i: (lang, 1.0) for i, _, lang in rows}
    assert language.recognised_documents(docs).count() == len(rows)


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(20)] + [(i, "der hund und die katze", "de") for i in range(20, 40)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 !?", "en"), (None, "the dog", None), (103, "the " * 100_000, None), (103, "Ω" * 50, None)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, score string")
    found = {(r.doc_id, r.lang_pred) for r in language.identify_documents(docs).collect()}
    assert {(100, "und"), (101, "und"), (102, "und"), (None, "en"), (103, "en"), (0, "en"), (20, "de")} <= found
    kept = language.recognised_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, *range(40), 103]
    assert language.identify_documents(docs.where("false")).count() == 0
