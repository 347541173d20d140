"""Registered corpus queries over the given tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetmill.llm.bpe import bpe_tokens
from sheetmill.llm.common import WORD_GAP
from sheetmill.llm.embeddings import near_embeddings
from sheetmill.llm.exact_dedup import exact_dedup
from sheetmill.llm.language import identify
from sheetmill.llm.mixing import mix_sources
from sheetmill.llm.ngram_join import ngram_join
from sheetmill.llm.phrases import collocations
from sheetmill.llm.runs import periodic_runs
from sheetmill.llm.secret_scan import KINDS, find_secrets, span_text
from sheetmill.llm.sharding import byte_shards
from sheetmill.llm.suffixes import remove_repeats
from sheetmill.llm.token_codes import token_codes
from sheetmill.llm.trie_bpe import trie_tokens


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = token_codes(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return coded.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(documents(spark, sf_dir), 8)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe_tokens(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join(documents(spark, sf_dir), words=4, least=(85, 100))
    return joined.select("doc_id", "n_shingles", "component_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(documents(spark, sf_dir), weights=(3, 1, 2), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(documents(spark, sf_dir), 50)
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir))
    spans = F.col("found")

    def count(kind: str) -> Column:
        number = KINDS.index(kind)
        return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(span_text(spans, base_only=True), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.93, recall=0.999)


def planted_text(text: Column, doc_id: Column) -> Column:
    """The text; in a tenth of the documents, from some word on, a stretch of its words over and over.

    With h the checksum of the id and g = h div 10, documents of h % 10 = 0 repeat the p words from word a = g % n on,
    p = 1 + (n - a) div (3 + g % 8). Rows without an id stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    n = F.size(words)
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    rest = n - a
    p = (F.floor(rest / (3 + g % 8)) + 1).cast("int")
    copies = F.ceil(rest / p).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), copies)), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), repeated), " ")
    return F.when((h % 10 == 0) & (n > 0), planted).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = periodic_runs(docs, text=planted_text(F.col("text"), F.col("doc_id")), least=12)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))).alias("best"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    length, start, period = F.col("best.length"), -F.col("best.col2"), -F.col("best.col3")
    return rows.select(
        "doc_id",
        "n_runs",
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = trie_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir), most=2000, longest=5, least=100)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    names = (
        op1_token_codes,
        op2_exact_dedup,
        op3_language_id,
        op4_sharding,
        op5_byte_bpe,
        op6_ngram_join,
        op7_mixing,
        op8_suffix_dedup,
        op9_secret_scan,
        op10_embeddings,
        op11_periodic_runs,
        op12_trie_bpe,
        op13_phrases,
    )
    return {query.__name__: query for query in names}


_OP2 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents
), k AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""


_OP6 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, string_split_regex(trim(regexp_replace(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d) WHERE w[1] <> ''
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)
), e2 AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS doc_id, b AS c FROM e2 UNION SELECT r.doc_id, e2.b FROM r JOIN e2 ON e2.a = r.c)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(d.doc_id, m.c), d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""

_OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), g AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), e2 AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93
), r AS (SELECT a AS vec_id, b AS c FROM e2 UNION SELECT r.vec_id, e2.b FROM r JOIN e2 ON e2.a = r.c)
SELECT v.vec_id, coalesce(k.n, 0) AS n_links, least(v.vec_id, coalesce(m.c, v.vec_id)) AS component_id,
  v.vec_id = least(v.vec_id, coalesce(m.c, v.vec_id)) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM e2 GROUP BY a) k ON k.a = v.vec_id
LEFT JOIN (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id) m ON m.vec_id = v.vec_id
"""


_OP13 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
s AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k)),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM s GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 100),
cut AS (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:k], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)
), scored AS (
  SELECT x.lang, x.phrase, x.a, x.j, y.a AS l, z.a AS r, n.n,
    CAST((1000::HUGEINT * x.a * n.n) // (y.a::HUGEINT * z.a) AS BIGINT) AS score
  FROM cut x JOIN f y ON y.lang = x.lang AND y.phrase = x.lp JOIN f z ON z.lang = x.lang AND z.phrase = x.rp
  JOIN n ON n.lang = x.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_part AS (
  SELECT DISTINCT lang, phrase, a FROM (
    SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (
      SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i
      FROM (SELECT lang, a, w, k, unnest(range(2, k)) AS m FROM c)
    )
  )
), kept AS (
  SELECT b.* FROM best b LEFT JOIN (SELECT lang, phrase, max(a) AS longer FROM inner_part GROUP BY ALL) i
    ON i.lang = b.lang AND i.phrase = b.phrase WHERE coalesce(100 * longer < 100 * a, true)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""


def statements() -> dict[str, str]:
    """SQL for the queries that it can express; the others are tested against plain Python."""
    return {"op2_exact_dedup": _OP2, "op6_ngram_join": _OP6, "op10_embeddings": _OP10, "op13_phrases": _OP13}
