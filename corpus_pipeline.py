"""A corpus pipeline: label languages, drop copies and near copies, mix sources, encode.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns what is
left of ``docs`` with its columns; the last one returns tokens. Between stages, ``run`` writes the rows
as Parquet to the shared folder and reads them again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sheetmill.llm.bpe import bpe_tokens
from sheetmill.llm.common import small_batches, text_or_empty, written
from sheetmill.llm.exact_dedup import exact_dedup, normalised
from sheetmill.llm.language import UNKNOWN, language_column, train
from sheetmill.llm.mixing import mixed_rows
from sheetmill.llm.ngram_join import ngram_join

#: SQL has no language model, no byte-level BPE and not the hash that picks the mix. The stages
#: are tested against plain Python.
ORACLE_SQL = None

RANKS = "byte_bpe_multi_50k.tiktoken"


def _joined(docs: DataFrame, key: Column, decisions: DataFrame) -> DataFrame:
    """Rows (row: all columns of ``docs``, key, nth: among rows that repeat id and key) and decisions.

    ``decisions`` has (doc_id, key) at most once each; ids may be null.
    """
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("no_id"),
        key.alias("key"),
        F.length(text_or_empty(F.col("text"))).alias("n_points"),
    )
    decided = decisions.withColumns(
        {"id": F.coalesce(F.col("doc_id"), F.lit(0)), "no_id": F.col("doc_id").isNull()}
    ).drop("doc_id")
    same = Window.partitionBy("id", "no_id", "key").orderBy(F.desc("n_points"))
    return keyed.join(decided, ["id", "no_id", "key"]).withColumn("nth", F.row_number().over(same))


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language; those without text or without a letter go.

    Null and empty texts have no letter. Rows without an id and repeated rows are judged each by itself and stay or go as
    their text does; nulls in other columns do not matter. An empty table stays empty.
    """
    model = train(docs)
    small_batches(spark, 2000)
    every = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    labelled = docs.select(every, language_column(F.col("text"), model, spans=False).alias("found"))
    return labelled.where(F.col("found.lang") != UNKNOWN).select("row.*")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space: the longest, then of the smallest id.

    Null texts count as empty, and empty ones are one group. A row without an id stays only where its group has no other; of
    repeated rows one stays. An empty table stays empty.
    """
    decisions = exact_dedup(docs).where("kept").select("doc_id", F.col("text_sha256").alias("key"))
    found = _joined(docs, F.sha2(normalised(F.col("text")), 256), decisions)
    return found.where("nth = 1").select("row.*")


def distant_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 or more of their five-word shingles: the one of
    the smallest id. Documents without words are in no group and stay."""
    joined = written(ngram_join(docs, words=5, least=(4, 5)), "joined")
    named = F.col("component_id").isNotNull()
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.col("text_hash").alias("key"))
    groups = joined.where("n_shingles > 0").groupBy(
        "component_id", F.when(~named, F.col("set_id")).alias("set")
    )
    firsts = groups.agg(F.min(place).alias("first")).select("first.doc_id", "first.key")
    alone = joined.where("n_shingles = 0").select("doc_id", F.col("text_hash").alias("key")).distinct()
    decisions = firsts.withColumn("alone", F.lit(False)).unionByName(alone.withColumn("alone", F.lit(True)))
    found = _joined(docs, F.xxhash64(text_or_empty(F.col("text"))), decisions)
    return found.where("alone or nth = 1").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: up to twice, or not at all.

    Null and empty texts have no words and add nothing. Rows without a source are a source of their own; rows
    without an id are mixed like others, and rows that repeat id and text share one decision. An empty table stays empty.
    """
    return mixed_rows(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text: doc_id, n_tokens, ids, and the digest of what they decode to.

    Null texts count as empty: no ids, the digest of no bytes. Rows without an id and repeated rows give a row each, an
    empty table gives none.
    """
    coded = bpe_tokens(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_languages),
    ("exact dedup", distinct_texts),
    ("n-gram Jaccard join", distant_texts),
    ("mixing", mixed),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
