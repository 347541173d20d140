"""Operators 1 and 5 against the libraries on whole texts."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from sheetmill.llm import queries
from sheetmill.llm.bpe import bpe_tokens, encode, encoding, pieces
from sheetmill.llm.token_codes import (
    Words,
    from_levels,
    to_levels,
    token_at,
    token_codes,
    tokens_at,
    words_of,
    write_codes,
)

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXT = st.text(
    st.one_of(
        st.sampled_from(" \n\t\x0b\x1c\x85\xa0　'sabé1!東\U0001f600"),
        st.sampled_from(" \nab'.,"),
        st.characters(codec="utf-8"),
    ),
    max_size=60,
) | st.lists(st.sampled_from(["<|endoftext|>", " ", "a", " b", "\n", "<|end", "é,"]), max_size=8).map("".join)


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(VOCABULARY)  # as it comes: added tokens in a text give their id
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def encoded(words, texts):
    ids, before = words.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(before, before[1:])]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 70_000), max_size=1500))
def test_levels_round_trip(ids):
    levels = to_levels(np.array(ids, np.uint64))
    assert from_levels(levels).tolist() == ids
    for i in range(0, len(ids), 37):
        assert token_at(levels, i) == ids[i]


def test_any_token_is_read_alone():
    ids = np.random.default_rng(1).integers(0, 50_257, 5000)
    levels = to_levels(ids)
    assert [token_at(levels, i) for i in range(5000)] == ids.tolist()


@settings(max_examples=600, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_words_give_the_ids_of_the_whole(whole, texts):
    for text, ids in zip(texts, encoded(words_of(VOCABULARY), texts)):
        assert ids == whole(text)


def test_forgotten_words_are_found_again(whole):
    words = Words(VOCABULARY, most=2)
    for texts in (["one two, three"], ["four five's", "six  odd"], ["one two,", ""], ["<|endoftext|> one", "seven"]):
        assert encoded(words, texts) == list(map(whole, texts))


@pytest.mark.parametrize("space", "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000\u200b\ufeff")
def test_every_white_space(whole, space):
    texts = [f"a {space}b", f"a{space}b c", f"a {space} b", f"{space}{space}a b{space}", f"a{space}\nb c"]
    assert encoded(words_of(VOCABULARY), texts) == list(map(whole, texts))


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
@pytest.mark.parametrize("options", [{}, {"part_rows": 4, "segment_tokens": 50}])
def test_token_codes(request, whole, table, options):
    docs = request.getfixturevalue(table)
    got = token_codes(docs, VOCABULARY, end_id=2, **options).collect()
    rows = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, tuple([*whole(r.text or ""), 2])) for r in rows)
    read = sorted(got, key=lambda r: r.start)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in read) == want
    start = 0
    for r in read:
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        start += r.n_tokens
    ids = [r.doc_id for r in read]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))


@pytest.mark.parametrize("options", [{}, {"part_rows": 4, "segment_tokens": 50}])
def test_single_tokens_are_read(spark, odd, whole, tmp_path, options):
    write_codes(odd, VOCABULARY, str(tmp_path / "codes"), end_id=2, **options)
    rows = sorted(token_codes(odd, VOCABULARY, end_id=2, **options).collect(), key=lambda r: r.start)
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows]).tolist()
    wanted = [0, 1, 2, 49, 50, 51, len(ids) - 1, 7, 7, -1, len(ids), len(ids) + 9, None, *range(100, 400, 7)]
    positions = spark.createDataFrame([(p, "clash") for p in wanted], "position long, part string")
    found = {r.position: r.id for r in tokens_at(spark, str(tmp_path / "codes"), positions).collect()}
    assert found == {p: ids[p] for p in wanted if p is not None and 0 <= p < len(ids)}
    assert tokens_at(spark, str(tmp_path / "codes"), positions.limit(0)).collect() == []


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 8))
def test_pieces_give_the_ids_of_the_whole(text, size):
    enc = encoding(RANKS, public_tokenizers.PATTERN)
    assert "".join(pieces(text, size)) == text
    ids = encode(enc, text, size)
    assert ids == enc.encode_ordinary(text)
    assert enc.decode_bytes(ids) == text.encode()


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
def test_bpe(request, table):
    docs = request.getfixturevalue(table)
    enc = encoding(RANKS, public_tokenizers.PATTERN)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), (r.text or "").encode()] += 1
    got = bpe_tokens(docs, RANKS, public_tokenizers.PATTERN, piece=100)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got.collect()) == want


def test_queries_give_digests(spark, small, whole):
    texts = {r.doc_id: r.text for r in small.collect()}
    enc = encoding(RANKS, public_tokenizers.PATTERN)
    for r in queries.op5_byte_bpe(spark, SMALL).collect():
        ids = np.array(enc.encode_ordinary(texts[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    start = 0
    for r in sorted(queries.op1_token_codes(spark, SMALL).collect(), key=lambda r: r.doc_id):
        ids = np.array([*whole(texts[r.doc_id]), 2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
