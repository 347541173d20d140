"""Operator 12 against the library on whole texts."""

from __future__ import annotations

import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from sheetmill.llm import queries
from sheetmill.llm.trie_bpe import Encoder, Vocabulary, encode_trie, encoder, trie_tokens

SMALL = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.text(
    st.one_of(
        st.sampled_from(" \n\t\x0b\x1c\x85\xa0　'sabé1!東\U0001f600՘\U00010940"),
        st.sampled_from("ain eorst"),
        st.sampled_from(" \nab'.,<|>"),
        st.characters(codec="utf-8"),
    ),
    max_size=60,
) | st.lists(st.sampled_from(["<|endoftext|>", " ", "a", " b", "\n", "<|end"]), max_size=8).map("".join)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)  # as it comes: added tokens in a text give their id


def found(own: Encoder, texts: list[str]):
    ids, before = own.encode(pa.array(texts, pa.string()))
    decoded = own.decode(ids, before).to_pylist()
    return [(ids[a:b].tolist(), t) for a, b, t in zip(before, before[1:], decoded)]


@settings(max_examples=500, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_ids_and_texts_are_those_of_the_library(library, texts):
    for text, (ids, decoded) in zip(texts, found(encoder(FILE), texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_long_words_without_a_space(library):
    texts = ["x" * 70_000, "東京" * 9_000, "ab" * 30_000 + "c", "é" * 20_000, "=-" * 20_000, " " * 5000 + "a"]
    for text, (ids, decoded) in zip(texts, found(encoder(FILE), texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert decoded == text


def test_shared_prefixes_do_not_change_words():
    vocabulary = Vocabulary(FILE)
    words = [b"", b"a", b"an", b"and", b"ander", b"andere", b"b", b"ba", b"bana", b"banana", b"bananas"]
    together = encode_trie(vocabulary, words)
    assert together == {w: encode_trie(vocabulary, [w])[w] for w in words}
    assert list(together[b""]) == []


def test_what_is_forgotten_is_found_again(library):
    own = Encoder(FILE, most=3)
    for texts in (["one two three four five"], ["six seven eight nine"], ["one nine"], ["ten one two", "six"]):
        for text, (ids, _) in zip(texts, found(own, texts)):
            assert ids == library.encode(text, add_special_tokens=False).ids


def test_bytes_that_are_no_text(library):
    own, ids = encoder(FILE), [255, 128, 64, 200, 65]
    texts = own.decode(np.array(ids), np.array([0, 2, 5]))
    assert texts.to_pylist() == [library.decode(ids[:2], skip_special_tokens=False), library.decode(ids[2:], skip_special_tokens=False)]


@pytest.mark.parametrize("change", [
    {"model": {"continuing_subword_prefix": "##"}},
    {"model": {"dropout": 0.1}},
    {"pre_tokenizer": {"add_prefix_space": True}},
    {"normalizer": {"type": "NFC"}},
])
def test_other_kinds_of_files_are_refused(tmp_path, change):
    with open(FILE, encoding="utf-8") as file:
        stored = json.load(file)
    for key, value in change.items():
        stored[key] = {**(stored[key] or {}), **value}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(stored))
    with pytest.raises(ValueError):
        Vocabulary(str(path))


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
@pytest.mark.parametrize("batch_bytes", [50, 8 << 20])
def test_trie_tokens(request, library, table, batch_bytes):
    docs = request.getfixturevalue(table)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), r.text or ""] += 1
    got = trie_tokens(docs, FILE, batch_bytes=batch_bytes)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got.collect()) == want


def test_query_gives_digests(spark, small, library):
    texts = {r.doc_id: r.text or "" for r in small.collect()}
    rows = queries.op12_trie_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
