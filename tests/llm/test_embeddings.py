"""Operator 10 against all pairs in plain Python."""

from __future__ import annotations

import numpy as np
import pytest

from sheetmill.llm.embeddings import fit_index, near_embeddings, units_of

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, least=0.93):
    good = []
    for _, vector, label in rows:
        fine = (
            label is not None
            and vector is not None
            and len(vector) > 0
            and all(x is not None and np.isfinite(x) for x in vector)
            and any(vector)
        )
        good.append(units_of(np.array([vector], float))[0] if fine else None)
    n = len(rows)
    links, comp = [0] * n, list(range(n))
    pairs = [
        (i, j)
        for i in range(n)
        for j in range(i)
        if good[i] is not None
        and good[j] is not None
        and rows[i][2] == rows[j][2]
        and len(good[i]) == len(good[j])
        and good[i] @ good[j] >= least
    ]
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(comp[i], comp[j])
            changed |= comp[i] != low or comp[j] != low
            comp[i] = comp[j] = low
    names = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            names[comp[i]] = min(names.get(comp[i], vec_id), vec_id)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    return sorted(
        ((r[0], links[i], names.get(comp[i]), r[0] == names.get(comp[i])) for i, r in enumerate(rows)), key=key
    )


def found(df, **options):
    key = lambda r: tuple(-1 if x is None else x for x in r)
    return sorted((tuple(r) for r in near_embeddings(df, **options).collect()), key=key)


@pytest.fixture(scope="module")
def given_rows(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    return table, [(r.vec_id, list(r.embedding), r.label) for r in table.collect()]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 5, "block_rows": 7}])
def test_given_vectors(given_rows, options):
    table, rows = given_rows
    assert found(table, **options) == plain(rows)


def dense(n=300):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 8))
    rows = []
    for i in range(n):
        v = centre[i % 4 if i % 3 else 0] + rng.normal(scale=0.25, size=8)
        rows.append((i * 11 % n, v.tolist(), i % 2 if i % 3 else 0))
    return rows + [(n + k, rows[0][1], rows[0][2]) for k in range(40)]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 4, "block_rows": 16}, {"cell_rows": 30, "sample_rows": 50}])
def test_dense_groups(spark, options):
    rows = dense()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, **options) == plain(rows)


def test_lower_target_recall_stays_symmetric_and_precise(spark):
    rows = dense()
    df = spark.createDataFrame(rows, SCHEMA)
    all_links = sum(r[1] for r in plain(rows))
    got = found(df, recall=0.95, cell_rows=4)
    share = sum(r[1] for r in got) / all_links
    assert 0.9 <= share <= 1
    exact = {r[0]: r[1] for r in plain(rows)}
    assert all(r[1] <= exact[r[0]] for r in got)
    assert sum(r[1] for r in got) % 2 == 0


def test_reach_holds_every_link():
    rng = np.random.default_rng(2)
    units = units_of(rng.normal(size=(600, 6)))
    index = fit_index(units[:100], 5, 0.93, 1.0)
    home, first, second = index.bounds(units)
    visits = index.visited(first, second)
    close = units @ units.T >= 0.93
    assert all(home[j] in visits[i] for i, j in zip(*np.nonzero(close)))
    assert sum(map(len, visits)) < 600 * index.cells


def planted(n=2400, links=400, dim=64, seed=3):
    """Unclustered vectors of four labels, some of them with a near copy."""
    rng = np.random.default_rng(seed)
    units = units_of(rng.normal(size=(n, dim)))
    noise = units_of(rng.normal(size=(links, dim)))
    noise = units_of(noise - (noise * units[:links]).sum(1, keepdims=True) * units[:links])
    cosine = rng.uniform(0.931, 0.999, size=(links, 1))
    units[n - links :] = cosine * units[:links] + np.sqrt(1 - cosine**2) * noise
    labels = np.arange(n) % 4
    labels[n - links :] = labels[:links]
    return units, labels


@pytest.mark.parametrize("k", [8, 16])
def test_target_recall_is_reached_in_few_cells(k):
    units, labels = planted()
    index = fit_index(units[::2], k, 0.93, 0.999, labels=labels[::2])
    home, first, second = index.bounds(units)
    visits = [set(v) for v in index.visited(first, second)]
    close = (units @ units.T >= 0.93) & (labels[:, None] == labels)
    pairs = [(i, j) for i, j in zip(*np.nonzero(close)) if i < j]
    assert len(pairs) >= 400
    hit = sum(home[j] in visits[i] or home[i] in visits[j] for i, j in pairs)
    assert hit / len(pairs) >= 0.99
    assert sum(map(len, visits)) < 0.2 * len(units) * index.cells


def test_sample_without_links_still_finds_them():
    """The reach is measured on planted links where the sample has none."""
    units, labels = planted(seed=4)
    index = fit_index(units[400:2000], 8, 0.93, 0.999, labels=labels[400:2000])
    home, first, second = index.bounds(units)
    visits = [set(v) for v in index.visited(first, second)]
    hit = sum(home[2000 + i] in visits[i] or home[i] in visits[2000 + i] for i in range(400))
    assert index.reach < 0.1 and hit >= 396


def test_query_equals_sql_where_there_are_links(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from sheetmill.llm import queries

    units, labels = planted()
    rows = [(i, v.tolist(), int(x)) for i, (v, x) in enumerate(zip(units, labels))]
    rows += [(3000 + i, rows[i][1], rows[i][2]) for i in range(0, 300, 3)] + [(4000, None, 1), (4001, rows[0][1], None)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = sorted(con.sql(queries.statements()["op10_embeddings"]).fetchall())
    got = sorted(map(tuple, queries.op10_embeddings(spark, str(tmp_path)).collect()))
    assert sum(r[1] for r in want) > 900
    assert got == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1),
        (2, [2.0, 0.0], 1),
        (3, [1.0, 0.0], None),
        (4, None, 1),
        (5, [0.0, 0.0], 1),
        (6, [nan, 1.0], 1),
        (7, [inf, 1.0], 1),
        (8, [1.0, None], 1),
        (9, [], 1),
        (10, [1.0, 0.0, 0.0], 1),
        (10, [1.0, 0.0, 0.0], 1),
        (11, [1e300, 1e299], 1),
        (12, [1e-300, 1e-301], 1),
        (13, [1.0, 0.0], 2),
        (None, [0.0, 1.0], 2),
        (None, [3.0, 0.1], 2),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = df.selectExpr("*", "'x' AS node", "'x' AS cell", "'x' AS member", "'x' AS vector", "'x' AS component")
    for table in (df, clashing):
        got = found(table)
        want = plain(rows)
        assert [r[:3] for r in got] == [r[:3] for r in want]
    assert near_embeddings(df.where("false")).count() == 0
