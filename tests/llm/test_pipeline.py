"""The pipeline against plain Python, stage by stage."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from sheetmill.llm.bpe import encoding
from tests.llm.test_dedup_shards_mixing import plain_targets
from tests.llm.test_ngram_join import plain_join

SMALL = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def norm(text):
    return (text or "").translate({c: None for c in (9, 10, 11, 12, 13, 32)})


def test_stages_and_columns(spark, small, empty, clashing):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for docs in (small, empty, clashing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, docs, SMALL)
            assert left.columns == docs.columns
            assert set(rows(left)) <= set(rows(docs))


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
def test_language(spark, request, table):
    docs = request.getfixturevalue(table)
    want = Counter({k: n for k, n in rows(docs).items() if any(map(str.isalpha, k[1] or ""))})
    assert rows(STAGE["language ID"](spark, docs, SMALL)) == want


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
def test_exact_dedup(spark, request, table):
    docs = request.getfixturevalue(table)
    groups = defaultdict(list)
    for r in docs.collect():
        groups[norm(r.text)].append(tuple(r))
    want = Counter(
        min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0] for g in groups.values()
    )
    got = STAGE["exact dedup"](spark, docs, SMALL).collect()
    assert Counter(r.doc_id for r in got) == want
    assert len({norm(r.text) for r in got}) == len(got) == len(groups)


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
def test_near_dedup(spark, request, table):
    docs = request.getfixturevalue(table)
    named = docs.where("doc_id is not null")
    parts = plain_join([tuple(r) for r in named.select("doc_id", "text").collect()], 5, (4, 5))
    want = {d for d, n, component in parts if component == d}
    got = STAGE["n-gram Jaccard join"](spark, named, SMALL).collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want)
    assert rows(STAGE["n-gram Jaccard join"](spark, docs, SMALL)) <= rows(docs)


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
def test_mixing(spark, request, table):
    docs = request.getfixturevalue(table)
    words, largest = Counter(), Counter()
    for r in docs.collect():
        n = len((r.text or "").split())
        words[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    got = STAGE["mixing"](spark, docs, SMALL)
    taken = Counter()
    for r in got.collect():
        taken[r.source] += len((r.text or "").split())
    before, after = rows(docs), rows(got)
    assert all(after[k] <= 2 * before[k] for k in after)
    for source, target in (plain_targets(words) if before else {}).items():
        assert abs(taken[source] - target) <= 2 * largest[source] + 1


@pytest.mark.parametrize("table", ["small", "odd", "clashing", "empty"])
def test_tokens(spark, request, table):
    docs = request.getfixturevalue(table)
    enc = encoding(public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = enc.encode_ordinary(r.text or "")
        digest = hashlib.sha256((r.text or "").encode()).hexdigest()
        want[r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), digest] += 1
    got = STAGE["byte-level BPE"](spark, docs, SMALL)
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in got.collect()) == want


def test_rows_without_id_in_near_dedup(spark, odd):
    """Every text keeps a representative: only copies of a text that stays may go."""
    got = STAGE["n-gram Jaccard join"](spark, odd, SMALL).collect()
    assert {norm(r.text) for r in got} == {norm(r.text) for r in odd.collect()}


def test_run(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
    enc = encoding(public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN)
    want = Counter((r.doc_id, np.array(enc.encode_ordinary(r.text), "<u4").tobytes()) for r in docs.collect())
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    assert 50 < len(got) < 400
