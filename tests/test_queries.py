"""Every registered query against its SQL counterpart, and known counts."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from sheetmill.operators.profile import infer_schema
from sheetmill.operators.quality import reconcile, typed_rows
from sheetmill.plans import fixtures as fx, oracle
from sheetmill.plans.queries import registered
from sheetmill.rules import RuleSet

DATA = Path("/root/testdata")
SMALL, MEDIUM = str(DATA / "sf0.001"), str(DATA / "sf0.01")
RULES = RuleSet.reference()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(registered()) == set(oracle.statements())
    assert set(registered()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_equals_sql(spark, duck, name):
    """Same rows in both engines, by built-in operators and without a cross join."""
    df = registered()[name](spark, SMALL)
    columns = sorted(df.columns)
    expected = duck.sql(oracle.statements()[name])
    assert sorted(expected.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    want = sorted(repr(tuple(row[i] for i in order)) for row in expected.fetchall())
    got = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    assert got == want
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_sample_is_bounded(spark):
    sample = registered()["profile_sample"](spark, MEDIUM)
    assert sample.count() == 1000
    assert sample.subtract(fx.purchases(spark, MEDIUM)).count() == 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [*fx.COLUMNS, "load_datetime", "job_date", "job_id"]
    assert df.count() > 0


def test_inferred_groups(spark):
    assert infer_schema(fx.purchases(spark, MEDIUM), fx.COLUMNS, RULES) == fx.INFERRED


@pytest.mark.parametrize(
    ("schema", "counts"),
    [
        (fx.INFERRED, (15000, 5651, 9151, 198, 5629, 22)),
        (fx.FORCED, (15000, 13901, 611, 488, 13214, 687)),
    ],
)
def test_known_counts(spark, schema, counts):
    tmp = fx.purchases(spark, MEDIUM)
    stg = typed_rows(tmp, schema, fx.CTX, RULES)
    found = {r.layer: r.n_rows for r in reconcile(tmp, stg, schema, fx.KEYS, fx.CTX, RULES).collect()}
    layers = ("tmp", "src", "rej_datatype", "leaked", "dw", "rej_duplicate")
    assert tuple(found[layer] for layer in layers) == counts
