"""Each stage of the pipeline against a brute-force version on what the stage before has written."""

from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline
from tallyward.llm import mixing
from tallyward.llm.common import stored
from tests.llm.test_near_duplicates import plain_groups
from tests.llm.test_packing import check, expected_ids
from tests.llm.test_privacy import plain

DIRECTORY = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    junk = [(9001, "12345 !!", "en", "src0", 8), (9002, None, None, None, None), (9003, "", "en", "src0", 0), (9004, "Ж" * 400, "en", "src1", 400)]
    first = docs.first()
    junk += [(9005, first.text, "en", None, 1), (first.doc_id, *list(first)[1:])]
    docs = stored(docs.union(spark.createDataFrame(junk, docs.schema)), "pipeline-test")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], DIRECTORY), "pipeline-test"))
    return out


def rows(frame):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in frame.collect())


def test_stages_and_columns(tables):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "private_data", "mixing", "packing"]
    assert all(frame.columns == COLUMNS for frame in tables[:-1])


def test_language_rejects_what_is_no_text(tables):
    gone = rows(tables[0]) - rows(tables[1])
    assert {x[0] for x in gone} == {9001, 9002, 9003, 9004}
    assert not rows(tables[1]) - rows(tables[0])


def test_one_document_of_each_group_stays(tables):
    before, after = rows(tables[1]), rows(tables[2])
    groups = plain_groups([(i, text) for i, text, *_ in before], 5)
    assert sorted(x[0] for x in after.elements()) == sorted({root for _, root in groups.values()})
    assert not after - before


def test_personal_data_are_masked(tables):
    before = {r.doc_id: r for r in tables[2].collect()}
    changed = 0
    for r in tables[3].collect():
        old = before.pop(r.doc_id)
        assert (r.lang, r.source, r.n_chars) == (old.lang, old.source, len(r.text))
        spans = plain(old.text)
        assert not [s for s in plain(r.text) if s[2] == "email"]
        if not spans:
            # Masks of other kinds than the base ones are all that may differ.
            assert r.text == old.text or re.search(r"\[(IBAN|SSN)\]", r.text)
            continue
        changed += 1
        for start, end, _ in spans:
            assert old.text[start:end] not in r.text
    assert not before and changed > 0


def test_the_mix_decides_which_words_come(tables):
    """Whole copies, and of the last document of each source's take its first words: exactly the words that the mix takes."""
    expected = {}
    for r in mixing.mix_documents(tables[3]).collect():
        expected[r.doc_id] = r.taken
    texts = {r.doc_id: r.text for r in tables[3].collect()}
    found, cut = Counter(), 0
    for r in tables[4].collect():
        assert texts[r.doc_id].startswith(r.text)
        found[r.doc_id] += len(plain_words(r.text))
        if r.text != texts[r.doc_id]:
            cut += 1
            assert plain_words(r.text) == plain_words(texts[r.doc_id])[: len(plain_words(r.text))] and r.n_chars == len(r.text)
    assert found == +Counter(expected)
    assert 0 < cut <= len({r.source for r in tables[3].collect()})


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_sequences_hold_all_tokens(tables):
    docs = tables[4].collect()
    pieces = tables[5].collect()
    copies = Counter(r.doc_id for r in docs)
    assert Counter((p.doc_id, p.start) for p in pieces if p.start == 0) == Counter({(i, 0): n for i, n in copies.items()})
    assert sum(p.length for p in pieces) == sum(len(expected_ids(r.text)) for r in docs)
    filled: Counter = Counter()
    for p in pieces:
        filled[p.sequence_id] += p.length
    assert all(n == 2048 or i == max(filled) for i, n in filled.items())


def test_packing_stage_without_copies(spark, tables):
    single = tables[4].dropDuplicates(["doc_id"])
    check(corpus_pipeline.pack(spark, single, DIRECTORY).collect(), [(r.doc_id, r.text) for r in single.collect()])


def test_run_is_the_stages_one_after_another(spark):
    from __spark_entry__ import queries

    found = queries()["pipeline"](spark, DIRECTORY)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.count() > 0


def test_empty_tables_pass_all_stages(spark, tables):
    docs = tables[0].where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, DIRECTORY), "pipeline-test")
    assert docs.count() == 0


def test_columns_with_names_that_the_stages_use(spark):
    names = ["row", "rows", "key", "part", "size", "score", "taken", "copies", "n", "id", "spans", "identity", "batch"]
    names += ["_id", "_key", "_words", "_digest", "document", "own_id", "own_key", "text_key", "row_id", "round", "slot", "root"]
    docs = spark.createDataFrame(
        [(i, f"some words of document {i} and the mail a{i}@b.cd", "en", f"s{i % 3}", None) for i in range(30)]
        + [(None, None, None, None, None), (7, "some words of document 7 and the mail a7@b.cd", "en", "s1", None)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for i, name in enumerate(names):
        docs = docs.selectExpr("*", f"{i} as {name}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, DIRECTORY), "pipeline-test")
        assert docs.columns == [*COLUMNS, *names]
        assert {tuple(r)[5:] for r in docs.collect()} == {tuple(range(len(names)))}
    assert all("[EMAIL]" in r.text for r in docs.collect())
    assert corpus_pipeline.pack(spark, docs, DIRECTORY).count() > 0
