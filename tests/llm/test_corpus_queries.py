"""Registered corpus queries: against SQL where there is one, their columns, and native plans."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from sheetmill.llm import queries

SMALL = "/root/testdata/sf0.001"
NATIVE = ("op4_sharding", "op7_mixing", "op9_secret_scan")
COLUMNS = {
    "op1_token_codes": "doc_id start n_tokens ids_crc32",
    "op2_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op3_language_id": "doc_id held_out lang_pred score",
    "op4_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op5_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6_ngram_join": "doc_id n_shingles component_id",
    "op7_mixing": "doc_id size source_size target taken",
    "op8_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10_embeddings": "vec_id n_links component_id kept",
    "op11_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12_trie_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op13_phrases": "lang rank phrase a l r n score",
}


def test_everything_is_registered():
    assert set(queries.registered()) == set(COLUMNS)
    assert set(queries.registered()) | {"pipeline"} <= set(contract.queries())
    assert set(queries.statements()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    columns = COLUMNS[name].split()
    found = con.sql(queries.statements()[name])
    order = [found.columns.index(c) for c in columns]
    want = sorted(tuple(row[i] for i in order) for row in found.fetchall())
    df = queries.registered()[name](spark, SMALL)
    assert df.columns == columns
    assert sorted(map(tuple, df.collect())) == want


@pytest.mark.parametrize("name", [*NATIVE, "op3_language_id", "op8_suffix_dedup", "op11_periodic_runs", "op12_trie_bpe"])
def test_columns_and_plans(spark, name):
    df = queries.registered()[name](spark, SMALL)
    assert df.columns == COLUMNS[name].split()
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    if name in NATIVE:
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
