"""Loads of many feeds: batches, what runs side by side, and going on after a stop."""

from __future__ import annotations

import threading
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sheetmill.model import REJECT_SCHEMA, ROW_ID, FeedConfig, RunContext, SchemaInfo
from sheetmill.operators.history import HISTORY, schema_changes
from sheetmill.operators.validate import ext_to_src, rej_datatype, route_rows
from sheetmill.plans import load as plan
from sheetmill.plans.ledger import Ledger
from sheetmill.plans.load import LAYERS, cancel_feed, load_feeds
from sheetmill.rules import RuleSet
from sheetmill.sources.tables import Warehouse
from tests.test_load import PURCHASES, config, rows_of, write_sheet

RULES = RuleSet.reference()
NAMES = ("tmp", "src", "stg", "dw")


def everything(warehouse, configs):
    """All tables of all feeds, sorted."""
    found = {}
    for c in configs:
        for layer in NAMES:
            df = warehouse.read(c.tables[layer])
            found[c.tables[layer]] = (df.columns, rows_of(df, *df.columns))
        found[c.tables["rej"]] = rows_of(warehouse.read_rejects(c.tables["rej"]), *REJECT_SCHEMA.names)
    return found


def sheets_of_two_kinds(folder, n):
    """Feeds whose tables differ in content only, of two kinds."""
    for i in range(n):
        rows = [["po_number", "n"], [f"p{i}", str(i)], [f"p{i}", "2"], ["q", "x" if i == 1 else "3"], ["r", "4"]]
        write_sheet(folder, f"a{i}", rows)
        write_sheet(folder, f"b{i}", [["po_number", "day", "n"], [f"p{i}", "1/2/2024", "5"], ["q", "", "7", "more"]])
    return [config(f"{kind}{i}") for kind in "ab" for i in range(n)]


def test_feeds_loaded_together_equal_feeds_loaded_alone(spark, tmp_path, ctx):
    configs = sheets_of_two_kinds(tmp_path / "sheets", 3)
    together, alone = (Warehouse(spark, str(tmp_path / name)) for name in ("one", "two"))
    results = load_feeds(spark, str(tmp_path / "sheets"), configs, ctx, together)
    assert not [r.error for r in results.values() if r.error]
    for c in configs:
        (own,) = load_feeds(spark, str(tmp_path / "sheets"), [c], ctx, alone).values()
        assert own == results[c.job_name]
    assert everything(together, configs) == everything(alone, configs)
    assert len(list((tmp_path / "one" / "_batches").iterdir())) == 2


def jobs_so_far(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_jobs_grow_with_kinds_of_feeds_not_with_feeds(spark, tmp_path, ctx):
    jobs = {}
    for n in (1, 100):
        configs = sheets_of_two_kinds(tmp_path / f"sheets{n}", n)
        before = jobs_so_far(spark)
        results = load_feeds(spark, str(tmp_path / f"sheets{n}"), configs, ctx, Warehouse(spark, str(tmp_path / f"wh{n}")))
        jobs[n] = jobs_so_far(spark) - before
        assert not [r.error for r in results.values() if r.error]
    assert len(results) == 200
    assert sum(r.counts["dw"] for r in results.values()) == 99 * 3 + 2 + 100  # a1 rejects a row
    assert jobs[1] > 0 and jobs[100] <= 2 * jobs[1]


def test_a_bad_feed_in_a_batch_stops_only_itself(spark, tmp_path, ctx, monkeypatch):
    configs = sheets_of_two_kinds(tmp_path / "sheets", 2)
    real = plan.assemble

    def assemble(rows, *args):
        broken = F.when(F.col("feed") == "a1", F.raise_error(F.lit("stop"))).otherwise(F.col(ROW_ID))
        return real(rows.withColumn(ROW_ID, broken.cast("long")), *args)

    monkeypatch.setattr(plan, "assemble", assemble)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    results = load_feeds(spark, str(tmp_path / "sheets"), configs, ctx, warehouse)
    assert [job for job, r in results.items() if r.error] == ["a1"]
    assert warehouse.read("dw.a0").count() == 3 and warehouse.location("dw.a1") is None


def test_batches_and_last_steps_run_side_by_side(spark, tmp_path, ctx, monkeypatch):
    """Writers of survivors and copies wait for each other, and so do the first writers of both batches."""
    configs = sheets_of_two_kinds(tmp_path / "sheets", 1)
    meet = {"tmp": threading.Barrier(2, timeout=120), "dw": threading.Barrier(4, timeout=120)}
    meet["copies"] = meet["dw"]
    real = plan._BatchLoad._write

    def write(self, df, layer, by=None):
        if layer in meet:
            meet[layer].wait()
        return real(self, df, layer, by)

    monkeypatch.setattr(plan._BatchLoad, "_write", write)
    results = load_feeds(spark, str(tmp_path / "sheets"), configs, ctx, Warehouse(spark, str(tmp_path / "wh")))
    assert [r.error for r in results.values()] == [None, None]


def test_one_feed_can_be_cancelled(spark, tmp_path, ctx, monkeypatch):
    configs = sheets_of_two_kinds(tmp_path / "sheets", 1)
    begun, real = threading.Event(), plan.src_to_stg

    def slow(src, schema, *args):
        if "day" not in schema.definition:
            return real(src, schema, *args)

        def wait(batches):
            time.sleep(60)
            yield from batches

        begun.set()
        return real(src.mapInArrow(wait, src.schema), schema, *args)

    monkeypatch.setattr(plan, "src_to_stg", slow)
    with ThreadPoolExecutor(1) as pool:
        loading = pool.submit(
            load_feeds, spark, str(tmp_path / "sheets"), configs, ctx, Warehouse(spark, str(tmp_path / "wh"))
        )
        assert begun.wait(120)
        while not loading.done():
            cancel_feed(spark, ctx, "b0")
            time.sleep(0.5)
        results = loading.result()
    assert "cancel" in str(results["b0"].error).lower()
    assert results["a0"].error is None


@pytest.mark.parametrize("catalog", [False, True])
@pytest.mark.parametrize("idempotent", [False, True])
@pytest.mark.parametrize("stop", LAYERS)
def test_a_stopped_load_goes_on(spark, tmp_path, ctx, monkeypatch, stop, idempotent, catalog):
    """A load that fails in some layer; the same run goes on there, without the exports, later in the day."""
    kinds = sheets_of_two_kinds(tmp_path / "sheets", 2)
    prefix = f"{stop}{int(idempotent)}{int(catalog)}"
    configs = [
        FeedConfig(c.job_name, {t: f"{t}.{prefix}_{c.job_name}" for t in c.tables}, c.primary_key) for c in kinds
    ]
    whole = Warehouse(spark, str(tmp_path / "whole"))
    unbroken = load_feeds(spark, str(tmp_path / "sheets"), configs, ctx, whole, idempotent=idempotent)
    warehouse = Warehouse(spark, None if catalog else str(tmp_path / "wh"))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    real = plan._BatchLoad._publish if stop != "tmp" else plan._BatchLoad._write
    table = {"route": "src", "end": "dw"}.get(stop, stop)

    def fails(self, layer, *args):
        if layer == table:
            raise OSError("stop")
        return real(self, layer, *args)

    def fails_early(self, df, layer, by=None):
        if layer == table:
            raise OSError("stop")
        return real(self, df, layer, by)

    def load(sheets, run, **options):
        return load_feeds(
            spark, str(sheets), configs, run, warehouse, idempotent=idempotent, ledger=ledger, **options
        )

    with monkeypatch.context() as patch:
        patch.setattr(plan._BatchLoad, "_write" if stop == "tmp" else "_publish", fails_early if stop == "tmp" else fails)
        broken = load(tmp_path / "sheets", ctx)
    assert {str(r.error) for r in broken.values()} == {"stop"}
    later = RunContext(ctx.job_id, ctx.job_date, datetime(2024, 1, 5, 19) if stop != "tmp" else ctx.load_datetime)
    written = []
    real_write = plan._BatchLoad._write

    def write(self, df, layer, by=None):
        written.append(layer)
        return real_write(self, df, layer, by)

    monkeypatch.setattr(plan._BatchLoad, "_write", write)
    results = load(tmp_path / ("sheets" if stop == "tmp" else "gone"), later, resume=True)
    assert results == unbroken
    assert not set(written) & set(LAYERS[: LAYERS.index(stop)])
    assert everything(warehouse, configs) == everything(whole, configs)
    written.clear()
    assert load(tmp_path / "gone", later, resume=True) == unbroken  # nothing is left to do
    assert written == []


def test_a_run_begins_anew_where_its_tables_are_gone(spark, tmp_path, ctx):
    """Another run replaced the tables, or the feed is configured otherwise: the ledger does not count."""
    configs = sheets_of_two_kinds(tmp_path / "sheets", 1)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))

    def load(run, own=configs, **options):
        return load_feeds(spark, str(tmp_path / "sheets"), own, run, warehouse, resume=True, **options)

    first = load(ctx)
    load(RunContext.of("run_2", "20240106", ctx.load_datetime), configs[:1])
    ledger = Ledger(spark, f"{warehouse.store}/_ledger")
    assert len(ledger.batches(ctx)) == 2
    assert load(ctx) == first
    assert len(ledger.batches(ctx)) == 3  # a0 was loaded again, b0 was not
    assert {r.job_id for r in warehouse.read("dw.a0").collect()} == {"run_1"}
    other = FeedConfig("b0", configs[1].tables, ("po_number", "n"))
    assert load(ctx, [configs[0], other])["b0"].error is None
    assert len(ledger.batches(ctx)) == 4
    assert load(ctx, rules=RuleSet.aligned())["a0"].error is None
    assert len(ledger.batches(ctx)) == 6


def test_one_scan_makes_src_and_rejects(spark, tmp_path, ctx):
    schema = SchemaInfo(("a", "b"), numeric=("b",))
    rows = [(1, " x ", "1"), (2, "y", "z"), (3, None, None), (4, "w", "1,000"), (5, "", "-")]
    spark.createDataFrame(rows, f"{ROW_ID} long, a string, b string").write.parquet(str(tmp_path / "tmp"))
    tmp = spark.read.parquet(str(tmp_path / "tmp"))
    routed = route_rows(tmp, schema, ctx, RULES, ";")
    text = routed._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Filter (" not in text
    routed.write.partitionBy("_route").parquet(str(tmp_path / "routed"))
    stored = spark.read.schema(routed.schema).parquet(str(tmp_path / "routed"))
    src, rej = (stored.where(f"_route = '{r}'") for r in ("src", "rej"))
    assert "PartitionFilters: [isnotnull(_route" in src._jdf.queryExecution().executedPlan().toString()
    want = ext_to_src(tmp, schema, ctx, RULES, ";")
    assert rows_of(src, *want.columns) == rows_of(want, *want.columns)
    names = REJECT_SCHEMA.names
    assert rows_of(rej, *names) == rows_of(rej_datatype(tmp, schema, ctx, RULES, ";"), *names)
    assert rows_of(stored.where("_route = 'leaked'"), "row") == [("w;1,000",)]


def test_ledger_keeps_the_columns_of_runs(spark, tmp_path, ctx):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    ledger = Ledger(spark, f"{warehouse.store}/_ledger")
    assert ledger.schemas().collect() == []
    for run, values in (("a/1", PURCHASES), ("b 'x'", [["po_number", "new"], ["1", "2"]])):
        write_sheet(tmp_path / "sheets", "p", values)
        own = RunContext.of(run, "20240105", ctx.load_datetime)
        load_feeds(spark, str(tmp_path / "sheets"), [config("p")], own, warehouse)
    assert ledger.schemas().schema == HISTORY
    assert rows_of(ledger.schemas(), "job_id", "pos", "col", "grp") == sorted(
        [("a/1", i, c, g) for i, (c, g) in enumerate(
            [("po_number", None), ("branch_id", "numeric"), ("day", None), ("amount", "numeric"), ("amount_1", "numeric")]
        )] + [("b 'x'", 0, "po_number", "numeric"), ("b 'x'", 1, "new", "numeric")], key=repr,
    )
    changes = rows_of(schema_changes(ledger.schemas()), "job_id", "change", "col", "old_col")
    assert [c[1:] for c in changes if c[0] == "b 'x'"] == [
        ("lost", None, "amount"), ("lost", None, "amount_1"), ("lost", None, "day"),
        ("renamed", "new", "branch_id"), ("retyped", "po_number", "po_number"),
    ]


def test_schema_changes(spark):
    def run(feed, day, job, columns):
        at = datetime(2024, 1, day, 7)
        return [(feed, at.date(), job, at, i, c, g) for i, (c, g) in enumerate(columns)]

    rows = [
        *run("f", 1, "a", [("x", None), ("y", "numeric"), ("z", "date")]),
        *run("f", 2, "b", [("x", None), ("y2", "numeric"), ("z", None)]),
        *run("f", 3, "c", [("z", None), ("x", None)]),
        *run("f", 4, "d", [("z", None), ("x", None)]),
        *run("g", 2, "b", [("only", None)]),
        *run("h", 1, "a", [("p", None)]),
        *run("h", 2, "b", [("q", "date")]),
    ]
    found = schema_changes(spark.createDataFrame(rows, HISTORY))
    names = ("feed", "job_id", "change", "col", "old_col", "pos", "old_pos", "grp", "old_grp")
    assert rows_of(found, *names) == sorted([
        ("f", "b", "renamed", "y2", "y", 1, 1, "numeric", "numeric"),
        ("f", "b", "retyped", "z", "z", 2, 2, None, "date"),
        ("f", "c", "lost", None, "y2", None, 1, None, "numeric"),
        ("f", "c", "moved", "x", "x", 1, 0, None, None),
        ("f", "c", "moved", "z", "z", 0, 2, None, None),
        ("h", "b", "new", "q", None, 0, None, "date", None),
        ("h", "b", "lost", None, "p", None, 0, None, None),
    ], key=repr)


@pytest.mark.parametrize("seed", range(5))
def test_merged_ballots_equal_a_full_vote(spark, seed):
    """Cells dealt to parts at random, and the parts merged in two steps."""
    import random

    from sheetmill.operators.profile import decide, labelled, merge_votes, partial_votes, vote

    rng = random.Random(seed)
    values = ["2024-01-05", "7%", "12", "1.5", "x", "", None]
    rows = [
        (rng.choice("fg"), rng.randrange(3), i, rng.choice(values[: rng.choice([2, 5, 7])])) for i in range(200)
    ]
    cells = labelled(spark.createDataFrame(rows, f"feed string, pos int, {ROW_ID} long, value string"), RULES)
    keys = ["feed", "pos"]
    whole = vote(cells, keys)
    parts = [partial_votes(cells.where(f"pmod(xxhash64({ROW_ID}, {seed}), 4) = {k}"), keys) for k in range(4)]
    left, right = parts[0].unionByName(parts[1]), parts[2].unionByName(parts[3])
    merged = decide(merge_votes(merge_votes(left, keys).unionByName(merge_votes(right, keys)), keys), keys)
    assert merged.columns == whole.columns
    assert rows_of(merged, *whole.columns) == rows_of(whole, *whole.columns)


def test_a_block_sample_reads_some_files_only(spark, tmp_path):
    from sheetmill.operators.profile import block_sample, infer_schema

    rows = spark.range(20_000).selectExpr(f"id AS {ROW_ID}", "CAST(id AS STRING) AS n", "IF(id % 9 = 0, '-', 'x') AS t")
    rows.repartition(40).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    found = block_sample(table, files=4, limit=300, seed=1)
    assert found.columns == table.columns
    positions = {r[0] for r in found.collect()}
    assert len(positions) == 300 and positions == {r[0] for r in block_sample(table, 4, limit=300, seed=1).collect()}
    files = {r.f for r in table.selectExpr("_metadata.file_path AS f", ROW_ID).where(F.col(ROW_ID).isin(list(positions))).collect()}
    assert len(files) == 4
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: [file_path" in scan  # which file listing uses: other files are not opened
    sampled = spark.createDataFrame(found.collect(), found.schema)
    assert infer_schema(sampled, ["n", "t"], RULES) == infer_schema(table, ["n", "t"], RULES)
    assert block_sample(table, files=99, fraction=1.0, limit=50_000).count() == 20_000
