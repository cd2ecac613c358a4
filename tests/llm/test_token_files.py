"""Token files: ids of the tokenizer, exact round trips, the layout of the files, odd rows."""

from __future__ import annotations

import glob
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyward.llm import simple8b, token_files
from tallyward.llm.queries import QUERIES

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
ENCODER = token_files.Encoder()


def expected_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def encoded(text):
    return [*ENCODER.encode(text.encode()).tolist(), 2]


@pytest.mark.parametrize("template", ["a{}b", "{} X{}", "1{}2'{}s", "{}", "W.{}", "Où{},"])
def test_ids_of_each_latin_character(template):
    for code in range(0x300):
        text = template.replace("{}", chr(code))
        assert encoded(text) == expected_ids(text), hex(code)


@settings(max_examples=500, deadline=None)
@example("<|endoftext|> and<|startoftext|>x <|endo é ẛ̣ ΑΣ σς İ I'LL it's 'Re 's")
@example("日本 語 😀‍❤  x　y z\u0085w \x1cq\x1fr ¼² ½x ª º ǅ ß ﬁ")
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n'.,sTaé1<|")), max_size=40))
def test_ids_equal_those_of_the_tokenizer(text):
    assert encoded(text) == expected_ids(text)


def test_the_end_is_encoded_with_the_text():
    for text in ("Où est ÿ İstanbul? ǅ, ª.", "", "<|endoftext|>"):
        assert ENCODER.encode(text.encode(), (2).to_bytes(4, "little")).tolist() == expected_ids(text)
    assert ENCODER.encode(None, (2).to_bytes(4, "little")).tolist() == [2]


@pytest.mark.parametrize("widest", [0, 1, 7, 16, 60])
def test_the_kind_of_a_word_is_the_one_with_most_numbers(widest):
    """Kinds are tried only up to the first that is nowhere possible, which leaves the same ones."""
    widths = np.zeros((2, 300 + max(simple8b.COUNTS)), np.uint8)
    widths[:, :300] = np.random.default_rng(7).integers(widest // 2, widest + 1, (2, 300))
    kinds = list(enumerate(zip(simple8b.COUNTS, simple8b.BITS, strict=True)))
    expected = [[next(n for n, (count, bits) in kinds if max(row[at : at + count]) <= bits) for at in range(300)] for row in widths.tolist()]
    assert simple8b._selectors(widths, 300).tolist() == expected


def test_words_are_forgotten_and_encoded_again():
    small = token_files.Encoder(limit=3)
    for text in ["a b, c d", "A B. c", "é-x e'll 12 <|endoftext|> D", "", "b b b b b"] * 3:
        assert [*small.encode(text.encode()).tolist(), 2] == expected_ids(text)
        assert len(small) <= 3


numbers = st.one_of(st.integers(0, 1), st.integers(0, 49407), st.integers(0, 2**60 + 5), st.integers(0, 2**64 - 1))


@settings(max_examples=400, deadline=None)
@example([2**64 - 1] * 3 + [0] * 500 + [2**60 - 1, 2**60, 1], 100)
@given(st.lists(numbers, max_size=600), st.sampled_from([1, 7, 100, 4096]))
def test_round_trip(values, block):
    given_ = np.array(values, np.uint64)
    words, offsets, escapes = simple8b.encode(given_, block)
    found = simple8b.decode(words, offsets, len(given_), block)
    assert not found[escapes].any() and len(offsets) == -(-len(values) // block) + 1
    found[escapes] = given_[escapes]
    assert found.tolist() == values
    assert all(values[i] >= 2**59 for i in escapes)


def greedy(values, block):
    """Word by word: the selector with most numbers whose next numbers (zeros behind the block) all fit."""
    words = []
    for low in range(0, len(values), block):
        rest = list(values[low : low + block])
        while rest:
            for selector, (count, bits) in enumerate(zip(simple8b.COUNTS, simple8b.BITS, strict=True)):
                taken = (rest + [0] * count)[:count]
                if all(value < 2**bits for value in taken):
                    words.append(selector << 60 | sum(value << i * bits for i, value in enumerate(taken)))
                    rest = rest[count:]
                    break
    return words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 49407), st.integers(0, 2**50)), max_size=400), st.sampled_from([7, 100]))
def test_words_are_those_of_the_greedy_choice(values, block):
    words, _, escapes = simple8b.encode(np.array(values, np.uint64), block)
    assert words.tolist() == greedy(values, block) and not len(escapes)


def test_record_decodes_any_part():
    rng = np.random.default_rng(3)
    documents = [rng.integers(0, 2**64 if i % 5 == 0 else 49408, size=n, dtype=np.uint64) for i, n in enumerate([1, 9000, 3, 4096, 12_000])]
    content = token_files.record(2, 7, [5, None, 0, -3, 2**62], documents)
    assert len(content) % 8 == 0
    (one,) = token_files.records(content + token_files.END_MARK.encode())
    whole = np.concatenate(documents)
    assert (one.task, one.number, one.doc_ids) == (2, 7, [5, None, 0, -3, 2**62])
    assert (one.ids() == whole).all()
    for low, high in [(0, 0), (0, 1), (4095, 4097), (8000, 20_000), (12_288, 12_288), (25_099, 25_100), (5, 25_100)]:
        assert (one.ids(low, high) == whole[low:high]).all()
    for broken in (content[:-8], b"x" + content[1:], content):
        with pytest.raises(ValueError):
            list(token_files.records(broken))


def check(rows, docs):
    """Ascending ids, no gaps, the checksums of the tokenizer's ids."""
    rows = sorted(rows, key=lambda row: row.start)
    assert [row.doc_id for row in rows] == sorted((i for i, _ in docs), key=lambda i: (i is None, i or 0))
    at = 0
    for row in rows:
        assert row.start == at
        at += row.n_tokens
    wanted = sorted((str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, text in docs for ids in [expected_ids(text)])
    assert sorted((str(row.doc_id), row.n_tokens, row.ids_crc32) for row in rows) == wanted


def test_query(spark):
    directory = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op12_token_files"](spark, directory)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    check(found.collect(), [tuple(row) for row in docs])


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, start string, hash string, part string, record string, content string"
    docs = [(3, "same"), (3, "same"), (3, "other"), (None, "no id"), (None, None), (7, None), (-1, ""), (2**62, " \n"), (9, "a " * 300_000)]
    docs += [(i, "x" * (i % 7) + " y") for i in range(100, 1500)] + [(8, "z" * 100_000)]
    frame = spark.createDataFrame([(i, text, "s", "h", "p", "r", "c") for i, text in docs], schema)
    check(token_files.filed_documents(frame).collect(), docs)
    assert token_files.filed_documents(frame.limit(0)).collect() == []
    with_end = token_files.filed_documents(frame.where("doc_id = 7")).collect()
    assert [tuple(row) for row in with_end] == [(7, 0, 1, zlib.crc32((2).to_bytes(4, "little")))]


def test_files_hold_records_in_order(spark, tmp_path):
    docs = [(i, f"document {i} " * 400) for i in range(500)]
    path = str(tmp_path / "ids")
    token_files.write_token_files(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), path)
    found = []
    for name in glob.glob(f"{path}/part-*"):
        with open(name, "rb") as file:
            found += list(token_files.records(file.read()))
    found.sort(key=lambda one: (one.task, one.number))
    assert len(found) > 2
    assert [key for one in found for key in one.doc_ids] == list(range(500))
    assert np.concatenate([one.ids() for one in found]).tolist() == [i for _, text in docs for i in expected_ids(text)]
    assert sum(8 * len(one.words) for one in found) < 4 * sum(one.size for one in found)
    rows = token_files.read_token_files(spark, path, with_ids=True).collect()
    check(rows, docs)
    assert all(np.frombuffer(row.ids, "<u4").tolist() == expected_ids(docs[row.doc_id][1]) for row in rows)
