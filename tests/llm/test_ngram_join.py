"""Operator 6 against all pairs in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import sheetmill.llm.ngram_join as module
from sheetmill.llm.common import components
from sheetmill.llm.ngram_join import ngram_join, shingle_sets


def plain_set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def plain_join(rows, words, least):
    sets = [plain_set(text, words) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    by_token = {}
    for i, s in enumerate(sets):
        for token in s:
            by_token.setdefault(token, []).append(i)
    tested = set()
    for members in by_token.values():
        for x in range(len(members)):
            for y in range(x):
                pair = (members[x], members[y])
                if pair in tested:
                    continue
                tested.add(pair)
                a, b = sets[pair[0]], sets[pair[1]]
                common = len(a & b)
                if least[1] * common >= least[0] * (len(a) + len(b) - common):
                    parent[find(pair[0])] = find(pair[1])
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    return Counter((rows[i][0], len(sets[i]), smallest[find(i)]) for i in range(len(rows)))


def joined(docs, words=4, least=(85, 100)):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(docs, words, least).collect())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab AB\n\x0b\x1cé\xa0", max_size=40) | st.none(), max_size=6), st.integers(1, 5))
def test_sets(texts, words):
    plain = [plain_set(t, words) for t in texts]
    sets = shingle_sets(texts, words)
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert len(set(a.tolist()) & set(b.tolist())) == len(plain[i] & plain[j])


@pytest.mark.parametrize("words,least", [(4, (85, 100)), (5, (4, 5)), (2, (1, 2))])
def test_given_documents(small, words, least):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert joined(small, words, least) == plain_join(rows, words, least)


def near_copies(seed, n=400):
    """Copies with a varying number of changed words, common passages, and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(3))
    base, passage = [word() for _ in range(120)], [word() for _ in range(30)]
    rows = []
    for i in range(n):
        if i % 3:
            text = list(base)
            for _ in range(rng.randrange(6)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                text = text[rng.randrange(25) :]
        else:
            text = [word() for _ in range(rng.randrange(1, 60))] + passage
        rows.append((i * 7 % n, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("short,block,salt", [(16, 4096, 4096), (4, 32, 8), (1, 64, 64), (1000, 1000, 4096)])
def test_hot_groups(spark, monkeypatch, seed, short, block, salt):
    monkeypatch.setattr(module, "_SHORT", short)
    monkeypatch.setattr(module, "_BLOCK", block)
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = Counter(
        (r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(docs, salt_rows=salt).collect()
    )
    assert got == plain_join(rows, 4, (85, 100))


@pytest.mark.parametrize("table", ["odd", "clashing", "empty"])
def test_odd_rows(request, table):
    docs = request.getfixturevalue(table)
    got = ngram_join(docs).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    named = [r for r in rows if r[0] is not None]
    assert Counter(
        (r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None
    ) == plain_join(named, 4, (85, 100))
    assert all(r.component_id is None for r in got if r.doc_id is None)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {x: c for x, c in label.items() if x != c}


def test_a_long_chain_is_one_component(spark):
    edges = spark.range(3000).selectExpr("id * 7919 % 3001 AS x").selectExpr("x AS a", "(x + 1) % 3001 AS b")
    got = components(edges).collect()
    assert {r.component for r in got} == {0} and len(got) == 3000


def groups_of_near_copies(n=30, size=60):
    """Two dense groups whose members differ in a word or two, around texts that share about four fifths."""
    rng = random.Random(11)
    first = [f"a{i}" for i in range(size)]
    second = first[: size - 5] + [f"b{i}" for i in range(5)]
    rows = []
    for base in (first, second):
        for _ in range(n):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(3, size - 8)] = f"x{rng.randrange(40)}"
            rows.append(" ".join(words))
    return [(i, text) for i, text in enumerate(rows)]


@pytest.mark.parametrize("least", [(85, 100), (3, 4), (9, 10), (19, 20)])
def test_answers_are_derived_from_similar_sets(spark, monkeypatch, least):
    """Long lists everywhere: most pairs of later sets are decided without reading them."""
    rows = groups_of_near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = {"pairs": 0, "read": 0}
    derived, verified = module._derived, module._verified

    def counted_derived(pairs, *args):
        seen["pairs"] += pairs.count()
        seen["on"] = True
        try:
            return derived(pairs, *args)
        finally:
            seen["on"] = False

    def counted_verified(pairs, *args):
        if seen.get("on"):
            seen["read"] += pairs.count()
        return verified(pairs, *args)

    monkeypatch.setattr(module, "_derived", counted_derived)
    monkeypatch.setattr(module, "_verified", counted_verified)
    got = {r.doc_id: r.component_id for r in ngram_join(df, 2, least).collect()}
    sets = {i: {tuple(w[k : k + 2]) for k in range(len(w) - 1)} for i, t in rows for w in [t.split()]}
    component = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i, x in sets.items():
            for j, y in sets.items():
                if i < j and least[1] * len(x & y) >= least[0] * len(x | y):
                    low = min(component[i], component[j])
                    changed |= component[i] != low or component[j] != low
                    component[i] = component[j] = low
    assert got == component
    assert seen["read"] <= seen["pairs"]


def test_blocks_of_positions_are_skipped():
    """A pair is listed by size and position as by both tests on every pair, from fewer pairs."""
    rng = np.random.default_rng(3)
    count = 400
    n = rng.integers(20, 60, count)
    pos = (rng.random(count) * n * 0.16).astype(np.int64)
    sketches = [np.zeros(64, np.uint8).tobytes()] * count
    table = pa.table({
        "token": np.sort(rng.integers(0, 3, count)), "low": np.zeros(count, np.int32), "high": np.zeros(count, np.int32),
        "block": np.zeros(count, np.int32), "set_id": np.arange(count), "n": n, "pos": pos,
        "component": np.arange(count), "bits": pa.array(sketches, pa.binary()),
    })
    lists = module._Lists(table, 85, 100)
    offered = []
    admitted = lists._admitted
    lists._admitted = lambda i, j: offered.append(len(i)) or admitted(i, j)
    found = {frozenset((int(lists.set_id[a]), int(lists.set_id[b]))) for x in lists.pairs(np.ones(count, bool)) for a, b in zip(*x[:2])}
    token = table.column("token").to_numpy()
    want, by_size = set(), 0
    for a in range(count):
        for b in range(a):
            if token[a] == token[b] and 100 * min(n[a], n[b]) >= 85 * max(n[a], n[b]):
                by_size += 1
                if min(n[a] - pos[a], n[b] - pos[b]) * 185 >= 85 * (n[a] + n[b]):
                    want.add(frozenset((a, b)))
    assert found == want
    assert sum(offered) < by_size


def test_frequency_classes(spark):
    """Sums of counters over all pages; those that are not there and those of 1 are of class 0."""
    rng = random.Random(5)
    places = [0, 4095, 4096, (1 << 22) - 1, *(rng.randrange(1 << 22) for _ in range(3000))]
    rows = [(rng.choice(places), rng.choice([1, 8, 9, 1000, 1 << 33])) for _ in range(8000)]
    sums = Counter()
    for counter, n in rows:
        sums[counter] += n
    want = np.zeros(1 << 22, np.uint8)
    for counter, n in sums.items():
        want[counter] = n.bit_length() - 1
    counted = spark.createDataFrame(rows, "counter long, n long")
    for parts in (1, 7):
        assert (module.frequency_classes(counted.repartition(parts)) == want).all()
    assert not module.frequency_classes(counted.limit(0)).any()


def test_driver_gets_no_row_per_counter(spark, monkeypatch):
    """However many n-grams are frequent, their classes reach the driver in pages, at most 1,024 rows."""
    words, rng, rows = [f"w{i}" for i in range(6000)], random.Random(7), []
    for i in range(10):
        rows.append((i, " ".join(rng.sample(words, len(words)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got, kind = [], type(docs)
    for name in ("collect", "toPandas"):
        monkeypatch.setattr(
            kind, name, lambda self, *a, f=getattr(kind, name): (got.append(len(x := f(self, *a))), x)[1]
        )
    found = ngram_join(docs, words=1).collect()
    assert {(r.n_shingles, r.component_id) for r in found} == {(6000, 0)} and len(found) == 10
    assert 0 < max(got) <= 1024
