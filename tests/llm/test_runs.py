"""Operator 11 against trying every period."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from sheetmill.llm import queries
from sheetmill.llm.runs import basic_factors, find_runs, periodic_runs
from sheetmill.llm.words import SPACES, split_words

SMALL = "/root/testdata/sf0.001"


def words_of(text: str) -> list[str]:
    return [w.decode() for w in text.encode().split()]  # bytes: splits at these six only


def runs_of(words: list[str], least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) by trying every period."""
    found: dict[tuple[int, int], int] = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at < len(words) - period:
            end = at
            while end < len(words) - period and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if end > at and length >= max(least, 2 * period):
                found.setdefault((at, length), period)
            at = end + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def kept_of(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


UNIT = st.lists(st.sampled_from("ab"), min_size=1, max_size=9)


@st.composite
def repetitive(draw):
    """Words from a few units that follow each other, as progressions and their breaks need."""
    units = draw(st.lists(UNIT, min_size=1, max_size=3))
    order = draw(st.lists(st.integers(0, len(units) - 1), max_size=12))
    return [w for k in order for w in units[k]]


PLAIN = st.lists(st.sampled_from("abc"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(repetitive(), PLAIN), min_size=1, max_size=4), st.sampled_from([1, 2, 5, 12]))
def test_runs_equal_brute_force(texts, least):
    words = split_words(pa.array([" ".join(t) for t in texts], pa.string()), SPACES)
    want = [
        (s + words.firsts[k], s + n + words.firsts[k], p)
        for k, t in enumerate(texts)
        for s, n, p in runs_of(t, least)
    ]
    assert sorted(map(tuple, find_runs(words, least).tolist())) == sorted(want)


@pytest.mark.parametrize("period", [1, 2, 3, 5, 6, 7, 8, 9, 15, 16, 17, 31, 33])
@pytest.mark.parametrize("extra", [0, 1, 2])
def test_a_square_of_any_period_is_found(period, extra):
    unit = [f"w{i % max(2, period // 2)}" if period > 1 else "w" for i in range(period - 1)] + ["z"]
    text = ["x", "y", *(unit * 3)[: 2 * period + extra], "q"]
    words = split_words(pa.array([" ".join(text)], pa.string()), SPACES)
    assert [r for r in find_runs(words, 1).tolist() if r[2] == period]
    assert sorted(map(tuple, find_runs(words, 1).tolist())) == sorted((s, s + n, p) for s, n, p in runs_of(text, 1))


def test_equal_texts_do_not_meet():
    codes, texts = np.array([0, 1, 2, 0, 1, 2]), np.array([0, 0, 0, 1, 1, 1])
    assert basic_factors(codes, texts) == []


def test_white_space_and_nothing_else_parts_words():
    texts = ["a\x1cb c\x0b\x0cd", "é\xa0e f", "", " \n ", "x"]
    words = split_words(pa.array(texts), SPACES)
    names = [words.names[int(c)].as_py().decode() for c in words.codes]
    assert names == [w for t in texts for w in words_of(t)]
    assert words.firsts.tolist() == [0, 3, 4, 4, 4, 5]


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
@pytest.mark.parametrize("batch_bytes", [1, 1 << 20])
def test_periodic_runs(request, table, batch_bytes):
    docs = request.getfixturevalue(table)
    if table == "small" and batch_bytes == 1:
        docs = docs.where("length(text) < 500")
    got = periodic_runs(docs, least=4, batch_bytes=batch_bytes)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        words = words_of(r.text or "")
        if len(words) > 2000 and table != "small":  # one unit over and over: one run
            unit = words_of("all work and no play makes jack")
            assert words == unit * (len(words) // 7)
            want[r.doc_id, len(words), ((0, len(words), 7),), " ".join(unit)] += 1
            continue
        runs = runs_of(words, 4) if len(words) < 600 else None
        if runs is not None:
            want[r.doc_id, len(words), tuple(runs), kept_of(words, runs)] += 1
    rows = Counter(
        (r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed)
        for r in got.collect()
    )
    assert rows.total() == docs.count()
    assert not want - rows
    if table != "small":
        assert rows == want


def test_query_plants_and_finds(spark, small):
    texts = {r.doc_id: r.text for r in small.collect()}
    planted = 0
    got = queries.op11_periodic_runs(spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        words = words_of(texts[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += n > 12
        if n > 1500 and h % 10:
            continue
        runs = runs_of(words, 12)
        assert r.n_runs == len(runs)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        if best:
            assert (r.start, r.length, r.period) == best
            assert r.exponent_milli == 1000 * best[1] // best[2]
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept_of(words, runs).encode()).hexdigest()
    assert planted > 5


def test_planting_without_id_or_text(spark):
    from pyspark.sql import functions as F

    rows = [(None, "a b c"), (1, None), (2, ""), *((k, "a b  c d e f") for k in range(100))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = df.select("doc_id", "text", queries.planted_text(F.col("text"), F.col("doc_id")).alias("t")).collect()
    assert [r.t for r in got[:3]] == ["a b c", None, ""]
    assert any(r.t != r.text for r in got[3:])
