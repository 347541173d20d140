"""Operator 3: held-out accuracy, Viterbi against enumeration, spans."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sheetmill.llm.language import UNKNOWN, best_paths, identify, label_texts, language_column, train


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98


def test_other_columns_are_no_inputs(small):
    plain = identify(small).collect()
    changed = small.withColumn("source", F.lit("x")).withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.col("lang"))
    )
    assert sorted(map(tuple, identify(changed).collect())) == sorted(map(tuple, plain))


def brute(scores, penalty):
    best = None
    for path in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        value = sum(scores[t, k] for t, k in enumerate(path))
        value -= penalty * sum(a != b for a, b in zip(path, path[1:]))
        if best is None or value > best + 1e-12:
            best = value
    return best


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.integers(0, 5), min_size=1, max_size=5),
    st.integers(0, 10**6),
    st.floats(0, 3),
)
def test_paths_are_the_best_ones(lengths, seed, penalty):
    rng = np.random.default_rng(seed)
    scores = [rng.normal(size=(n, 3)) for n in lengths]
    for own, path in zip(scores, best_paths(scores, penalty)):
        assert len(path) == len(own)
        value = own[np.arange(len(own)), path].sum() - penalty * (np.diff(path) != 0).sum()
        if len(own):
            assert value == pytest.approx(brute(own, penalty))


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_spans_follow_the_languages_of_a_mixed_text(small, model):
    pick = {r.lang: r.text for r in small.where("lang in ('de', 'en')").where("n_chars > 1500").collect()}
    de, en = (pick[k].replace("\n", " ")[:n] for k, n in (("de", 600), ("en", 400)))
    (lang, score, spans), = label_texts(model, [de + " " + en], 8.0, True)
    assert lang == "de" and 0.4 < score < 0.8
    assert [s[2] for s in spans] == ["de", "en"]
    assert abs(spans[1][0] - len(de)) < 40
    assert all(a < b for a, b, _ in spans)


def test_scripts_narrow_the_candidates(spark):
    rows = [("привет мир как дела", "ru")] * 30 + [("hello world how are things", "en")] * 30
    model = train(spark.createDataFrame(rows, "text string, lang string"))
    texts = ["мир", "world", "東京", "мир мир мир world", "", None, "123 !?"]
    found = [r[0] for r in label_texts(model, texts, 8.0, False)]
    assert found[:2] == ["ru", "en"] and found[3] == "ru"
    assert found[2] in ("en", "ru")  # no language is known by this script
    assert found[4:] == [UNKNOWN] * 3


@pytest.mark.parametrize("table", ["odd", "clashing", "empty"])
def test_odd_rows(request, table):
    docs = request.getfixturevalue(table)
    got = identify(docs).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            assert (r.lang_pred == UNKNOWN) == (not any(map(str.isalpha, texts[r.doc_id] or "")))
        assert (r.lang_pred == UNKNOWN) == (r.score == 0)


def test_nothing_learned(spark, small):
    model = train(small.where("false"))
    assert {r[0] for r in label_texts(model, ["some text", None], 8.0, True)} == {UNKNOWN}
    labelled = small.select(language_column(small.text, model).alias("r")).select("r.lang").distinct()
    assert [r.lang for r in labelled.collect()] == [UNKNOWN]
