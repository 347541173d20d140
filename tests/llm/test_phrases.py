"""Operator 13 against counting every phrase."""

from __future__ import annotations

import inspect
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sheetmill.llm.phrases import (
    LEAST_BITS,
    Filter,
    _filter_of,
    _Scan,
    _sorted_totals,
    _Suffixes,
    _word_hash,
    collocations,
    phrase_counts,
)


def pieces_of(text):
    raw = (text or "").encode().lower()  # bytes: A-Z only
    return [[w for w in re.split(rb"[ \t]+", p) if w] for p in re.split(rb"[.,;:!?\n-\r]", raw)]


def plain(rows, most, longest, least):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    count[lang, tuple(words[i : i + size])] += 1
    found = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in found.items():
        if any(
            la == lang and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (la, q), b in found.items()
        ):
            continue
        n = total[lang]
        cuts = [(count[lang, p[:k]], count[lang, p[k:]], k) for k in range(1, len(p))]
        score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for l, r, k in cuts)
        out.append((lang, -score, -a, b" ".join(p), l, r, n))
    out.sort()
    ranked, seen = [], Counter()
    for lang, score, a, phrase, l, r, n in out:
        seen[lang] += 1
        if seen[lang] <= most:
            ranked.append((lang, seen[lang], phrase.decode(), -a, l, r, n, -score))
    return ranked


@pytest.fixture(scope="module")
def rows():
    """A third of the rows hold one passage, some words come very often, and some texts repeat one phrase."""
    rng = random.Random(5)
    passage = "In the Beginning was the word, and the word was good"
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "the", "of", "naïve", "東京", "x\x1cy"]
    found = [("en", passage)] * 60 + [(None, None), (None, "lone words here"), ("fr", ""), ("und", "lone words here")]
    for _ in range(160):
        words = [rng.choice(vocabulary[: rng.choice([3, 8, 46])]) for _ in range(rng.randint(1, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ". ", ",", "  "]) for w in words)
        found.append((rng.choice(["en", "en", "de", None, "fr"]), text + rng.choice(["", passage, "of the of the of the"])))
    found.append(("de", "of the " * 4000))
    found.append(("de", "of the w1 w2 " * 200 + "w3 " * 900))
    return found


@pytest.mark.parametrize("options", [
    {},
    {"batch_bytes": 300},
    {"batch_bytes": 300, "prefix_rows": 3, "group_rows": 20},
    {"hash_bits": 9},
])
@pytest.mark.parametrize("most, longest, least", [(2000, 5, 8), (7, 3, 3)])
def test_collocations_equal_brute_force(spark, rows, options, most, longest, least):
    df = spark.createDataFrame(rows, "lang string, text string")
    got = collocations(df, most=most, longest=longest, least=least, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows, most, longest, least))


@pytest.mark.parametrize("table", ["odd", "clashing", "empty"])
def test_odd_tables(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    got = collocations(docs, most=50, longest=4, least=2)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows, 50, 4, 2))


def test_products_beyond_64_bits(spark):
    from sheetmill.llm.phrases import _cut_scores

    big = 4_000_000_000_000
    words = spark.createDataFrame(
        [(1, False, big, "en", b"a"), (2, False, big - 1, "en", b"b"), (9, True, 3 * big, "en", None)],
        "h long, total boolean, n long, lang string, word binary",
    )
    phrases = spark.createDataFrame([([1, 2], big - 7)], "words array<bigint>, n long")
    (row,) = _cut_scores(words, phrases, 5).collect()
    assert row.score == 1000 * (big - 7) * 3 * big // (big * (big - 1))


def test_hashes_of_words_stand_alone():
    words = pa.array([b"", b"a", b"b", b"ab", b"ba", b"a\x00", b"\x00a", "é".encode()], pa.binary())
    hashes = _word_hash(words, 1)
    assert len(set(hashes.tolist())) == len(words)
    assert _word_hash(words.slice(3, 2), 1).tolist() == hashes[3:5].tolist()
    assert _word_hash(words, 2).tolist() != hashes.tolist()


def test_filter_never_misses(spark):
    rng = np.random.default_rng(2)
    own = rng.integers(-(2**63), 2**63 - 1, 3000)
    table = spark.createDataFrame([(int(x),) for x in own], "h long")
    known = _filter_of(table, "h")
    assert isinstance(known, Filter) and known._bits.nbytes * 8 >= LEAST_BITS
    assert known.of(own.view(np.uint64)).all()
    assert known.of(rng.integers(0, 2**64, 20_000, np.uint64)).mean() < 0.05
    assert not _filter_of(table.limit(0), "h").of(own.view(np.uint64)).any()


def test_leaf_totals():
    rows = np.array([[2, 1], [1, 0], [2, 1], [1, 3]], np.uint64)
    distinct, totals = _sorted_totals(rows, np.array([1, 5, 7, 2]))
    assert distinct.tolist() == [[1, 0], [1, 3], [2, 1]] and totals.tolist() == [5, 2, 8]


def test_rare_words_and_totals(spark):
    df = spark.createDataFrame([("en", "a b a b c"), ("en", "a b")], "lang string, text string")
    words, phrases = phrase_counts(df, least=2)
    assert {(r.word and bytes(r.word), r.n) for r in words.collect()} == {(b"a", 3), (b"b", 3), (None, 7)}
    assert sorted(r.n for r in phrases.collect()) == [3]


def test_memory_of_a_task_is_a_small_part_of_an_executors():
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(9000)}" for _ in range(400)) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    size = inspect.signature(phrase_counts).parameters["batch_bytes"].default
    known = Filter(np.full(LEAST_BITS // 8, 255, np.uint8))
    suffixes = _Suffixes(_Scan(size, 1, 64), 5, known, known)
    tracemalloc.start()
    try:
        n = sum(int(n.sum()) for _, n in suffixes.of(iter([batch] * 5)))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 5 * 500 * 398
    assert most < 80 << 20
