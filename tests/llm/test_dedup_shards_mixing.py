"""Operators 2, 4 and 7 against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sheetmill.llm.exact_dedup import build_filter, exact_dedup, maybe_contains
from sheetmill.llm.mixing import mix_sources, source_cuts, source_targets
from sheetmill.llm.sharding import byte_shards


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def plain_dedup(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r.text)].append(r)
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        kept = False
        for r in sorted(members, key=lambda r: -len(r.text or "")):
            stays = r.doc_id == best.doc_id and not kept
            kept |= stays
            out.append((r.doc_id, best.doc_id, len(members), stays, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
@pytest.mark.parametrize("share", [None, 0, 1])
def test_exact_dedup(request, table, share):
    docs = request.getfixturevalue(table)
    snapshot = None if share is None else F.lit(bool(share))
    got = Counter(map(tuple, exact_dedup(docs, snapshot=snapshot).collect()))
    assert got == plain_dedup(docs.collect())


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=400))
def test_filter_finds_every_key(keys):
    keys = np.array(sorted(keys), np.int64)
    assert maybe_contains(build_filter(np.concatenate([keys, keys])), keys).all()


def test_filter_passes_few_others():
    rng = np.random.default_rng(3)
    keys = rng.integers(-(2**63), 2**63 - 1, 300_000)
    built = build_filter(keys)
    assert maybe_contains(built, keys).all()
    assert len(built[3]) < 1.3 * len(keys)
    assert maybe_contains(built, rng.integers(-(2**63), 2**63 - 1, 300_000)).mean() < 1e-3


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
@pytest.mark.parametrize("bucket_rows", [3, 4096])
def test_shards(request, table, bucket_rows):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    got = byte_shards(docs, 4, bucket_rows=bucket_rows).collect()
    want = Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows
    )
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots, sizes = defaultdict(list), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if table == "small":
        target, largest = sum(sizes.values()) / 4, max(r["size"] for r in got)
        assert all(abs(sizes[k] - target) <= largest + 0.02 * target for k in range(4))
        homes = defaultdict(set)
        for r in got:
            homes[r.text_crc32, r["size"]].add(r.shard)
        assert sum(len(h) > 1 for h in homes.values()) <= 3


def test_shards_split_a_hot_group(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("t"), "id")).alias("text"),
    )
    sizes = byte_shards(docs, 8, bucket_rows=64).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(sizes) == 8
    mean = sum(r.s for r in sizes) / 8
    assert all(abs(r.s - mean) < 0.03 * mean for r in sizes)


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = budget - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in rest)
        target = {s: left * weight[s] / total for s in rest} | {s: most * sizes[s] for s in full}
        over = {s for s in rest if target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
def test_mixing(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text", "source").collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows]
    sizes, largest = Counter(), Counter()
    for r, w in zip(rows, words):
        sizes[r.source] += w
        largest[r.source] = max(largest[r.source], w)
    target = plain_targets(sizes) if rows else {}
    got = mix_sources(docs).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter(
        (r.doc_id, w) for r, w in zip(rows, words)
    )
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
    copies = 2 if table != "small" else 1  # rows that repeat share a decision
    for s in sizes:
        assert abs(taken[s] - target[s]) <= copies * largest[s]
    again = mix_sources(docs).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


@settings(max_examples=25, deadline=None)
@given(
    st.dictionaries(st.one_of(st.none(), st.text("abé\U0001f600", max_size=3)), st.integers(0, 1000), min_size=1, max_size=9)
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df, (3, 1, 2), 1.5, 2.0).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-6) for s in want)


def test_larger_budgets_keep_what_smaller_ones_keep(small):
    less = {r.doc_id: r.copies for r in mix_sources(small, share=0.4, most=1.0).collect()}
    more = {r.doc_id: r.copies for r in mix_sources(small, share=0.7, most=1.0).collect()}
    assert all(more[d] >= less[d] for d in less)
    assert sum(more.values()) > sum(less.values())


@pytest.mark.parametrize("seed", range(4))
def test_mix_misses_by_half_of_the_crossing_document_at_most(spark, seed):
    sizes = {"a": [1000, 10, 10], "b": [300] * 7, "c": list(range(1, 40)), "d": [5000]}
    rows = [(i, " ".join(["w"] * n), s) for s, all_ in sizes.items() for i, n in enumerate(all_, 100 * ord(s))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    options = {"share": 0.55, "most": 1.0, "seed": seed}
    mixed, _ = source_cuts(docs, (3, 1, 2), 0.55, 1.0, seed=seed)
    by_hash = defaultdict(list)
    for r in sorted(mixed.collect(), key=lambda r: r.h % 2**64):
        by_hash[r.source].append(r["size"])
    got = mix_sources(docs, **options).collect()
    for s, ordered in by_hash.items():
        target, taken = next(r.target for r in got if r.source == s), sum(r.taken for r in got if r.source == s)
        ends = [0, *itertools.accumulate(ordered)]
        assert abs(taken - target) == pytest.approx(min(abs(e - target) for e in ends), abs=1e-6)
