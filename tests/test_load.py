"""Readers, writers and whole loads, including feeds that change between runs."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import threading
import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest

from sheetmill.__main__ import main
from sheetmill.model import (
    REJECT_SCHEMA,
    ROW_ID,
    BadConfig,
    FeedConfig,
    FeedError,
    RunContext,
    load_configs,
)
from sheetmill.operators.validate import audit_columns
from sheetmill.plans.load import load_feeds
from sheetmill.rules import RuleSet
from sheetmill.session import scratch_path
from sheetmill.sources import tables
from sheetmill.sources.landing import landing_path, read_landing, write_landing
from sheetmill.sources.sheets import read_sheets
from sheetmill.sources.tables import Warehouse

ALIGNED = RuleSet.aligned()


def write_sheet(folder, feed, values, name="sheet.json", cells=None):
    path = folder / feed
    path.mkdir(parents=True, exist_ok=True)
    document = {"majorDimension": "ROWS", "values": values}
    if cells:
        document["range"] = cells
    (path / name).write_text(json.dumps(document, indent=1))


def config(job, keys=("po_number",), delimiter="|"):
    tables = {layer: f"{layer}.{job}" for layer in FeedConfig.LAYERS}
    return FeedConfig(job, tables, tuple(keys), delimiter)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# Sources


def test_read_sheets(spark, tmp_path):
    write_sheet(tmp_path, "a", [["h1", "h2"], [1, None], ["x\ny"], []])
    write_sheet(tmp_path, "b", [["h"]], "1.json", "'My Sheet'!A1:Z1")
    write_sheet(tmp_path, "b", [["later"], ["last"]], "2.json", "Sheet!$A$501:Z1000")
    got = rows_of(read_sheets(spark, str(tmp_path)), "feed", ROW_ID, "cells")
    assert got == [
        ("a", 0, ["h1", "h2"]),
        ("a", 1, ["1", None]),
        ("a", 2, ["x\ny"]),
        ("a", 3, []),
        ("b", 0, ["h"]),
        ("b", 500, ["later"]),
        ("b", 501, ["last"]),
    ]


def test_damaged_sheet_fails(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text('{"values": [["h"], ["1"')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_sheets(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("delimiter", ["|", ",", ";"])
def test_landing_keeps_awkward_cells(spark, tmp_path, ctx, delimiter):
    cells = ['a"b', '"', "a|b,c;d", "back\\slash", 'end\\"', "in\rside", " edge ", "é", "#x", "x"]
    rows = [(str(i), c) for i, c in enumerate(cells)]
    path = landing_path(str(tmp_path), "job", ctx)
    write_landing(spark.createDataFrame(rows, "i string, c string"), path, delimiter)
    assert rows_of(read_landing(spark, path, ["i", "c"], delimiter), "i", "c") == rows


def test_landing_blank_and_short_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a|b|c\n1||""\n2\n3|x|y\n')
    got = rows_of(read_landing(spark, str(tmp_path), ["a", "b", "c"]), "a", "b", "c")
    assert got == [("1", None, None), ("2", None, None), ("3", "x", "y")]


def test_landing_keeps_rows_without_text(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("",), (None,), ("b",)], "c string")
    write_landing(rows, str(tmp_path / "x"))
    got = rows_of(read_landing(spark, str(tmp_path / "x"), ["c"]), "c")
    assert got == [("a",), ("b",), (None,), (None,)]


def test_landing_path_differs_by_run(ctx):
    other = RunContext.of("run_2", "20240105", ctx.load_datetime)
    assert landing_path("f", "a", ctx) == "f/a/20240105/run_1"
    assert len({landing_path("f", j, c) for j in "ab" for c in (ctx, other)}) == 4


@pytest.mark.parametrize("catalog", [False, True])
def test_replace_changes_the_columns(spark, tmp_path, catalog):
    warehouse = Warehouse(spark, None if catalog else str(tmp_path))
    warehouse.replace(spark.createDataFrame([(1, "x")], "a int, b string"), "stg.replaced")
    again = warehouse.replace(spark.createDataFrame([(2.5,)], "c double"), "stg.replaced")
    assert again.columns == ["c"]
    assert rows_of(warehouse.read("stg.replaced"), "c") == [(2.5,)]


@pytest.mark.parametrize("catalog", [False, True])
@pytest.mark.parametrize("idempotent", [False, True])
def test_rejects_append(spark, tmp_path, ctx, catalog, idempotent):
    warehouse = Warehouse(spark, None if catalog else str(tmp_path))
    table = f"rej.appended_{idempotent}"

    def rejects(context, values):
        columns = "row string, rej_reason string, rej_detail string"
        base = spark.createDataFrame([(v, "r", "d") for v in values], columns)
        return base.select("*", *audit_columns(context))

    first = RunContext.of("manual__2024-01-05T07:00:00+00:00 'x'", "20240105", ctx.load_datetime)
    later = RunContext.of("0", "20240106", ctx.load_datetime)

    def store(context, values):
        return warehouse.append_rejects(
            rejects(context, values), table, context if idempotent else None
        )

    if idempotent:
        # The partition folder is the one a plain append writes to.
        warehouse.append_rejects(rejects(first, ["old"]), table)
    store(first, ["a", "b"])
    store(later, ["c"])
    stored = store(first, ["a", "b"])
    assert [(f.name, f.dataType) for f in stored.schema] == [
        (f.name, f.dataType) for f in REJECT_SCHEMA
    ]
    expected = ["a", "b", "c"] if idempotent else ["a", "a", "b", "b", "c"]
    assert [r[0] for r in rows_of(stored, "row")] == expected
    assert {r.job_id for r in stored.collect()} == {first.job_id, later.job_id}
    assert rows_of(stored, "row", "job_id", "job_date")[-1] == ("c", "0", date(2024, 1, 6))
    if idempotent:
        assert [r.row for r in store(first, []).collect()] == ["c"]


@pytest.mark.parametrize("name", ["plain", "a.b.c", ".x", "x."])
def test_table_needs_two_parts(spark, name):
    with pytest.raises(FeedError, match="dataset.table"):
        Warehouse(spark, "base").path(name)


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared) and first != second


# Configuration


def test_config_from_yaml(tmp_path):
    (tmp_path / "a.yaml").write_text(
        "project_id: p\njob_name: a\nschedule:\ndag_params:\n  field_delimiter: ';'\n"
        "gsheet:\n  gsheet_id: id\n  range: S!A1:Z\n"
        "bq_tables: {tmp: t.a, src: s.a, stg: g.a, dw: d.a, rej: r.a}\n"
        "bq_schema:\n  primary_key:\n  - x\n  - y\n"
    )
    (found,) = load_configs(str(tmp_path))
    assert found.job_name == "a" and found.delimiter == ";" and found.schedule is None
    assert found.primary_key == ("x", "y") and found.tables["dw"] == "d.a"


def test_config_names_every_table():
    with pytest.raises(FeedError, match="rej"):
        FeedConfig("a", {"tmp": "t.a", "src": "s.a", "stg": "g.a", "dw": "d.a"}, ("x",))


def test_run_context_reads_the_clock_in_the_load_zone():
    ctx = RunContext.of("r", "20240229")
    assert ctx.job_date == date(2024, 2, 29)
    assert ctx.load_datetime.tzinfo is None


# Whole loads

PURCHASES = [
    ["PO Number", "Branch ID", "Day", "Amount", "Amount"],
    ["PO-1", "1", "1/2/2024", "10", "5%"],
    ["PO-2", "2", "1/3/2024", "x", "7%"],
    ["PO-1", "3", "1/4/2024", "12", ""],
    ["PO-3", "4", "n/a", "1,500"],
    [" PO-4\n", "5", "", "14", "7.5%", " "],
    ["PO-5", "6", "", "15", "1%", "extra"],
]


def test_load(spark, tmp_path, ctx):
    sheets, warehouse = tmp_path / "sheets", Warehouse(spark, str(tmp_path / "wh"))
    write_sheet(sheets, "purchases", PURCHASES)
    result = load_feeds(spark, str(sheets), [config("purchases")], ctx, warehouse)["purchases"]
    assert result.error is None
    assert result.schema.definition == ("po_number", "branch_id", "day", "amount", "amount_1")
    assert result.schema.numeric == ("branch_id", "amount", "amount_1")
    assert result.counts == {
        "tmp": 5, "src": 3, "rej_datatype": 1, "rej_duplicate": 1, "surplus": 1, "dw": 2, "leaked": 1,
    }
    assert warehouse.read("tmp.purchases").count() == 5
    assert rows_of(warehouse.read("src.purchases"), ROW_ID, "po_number") == [
        (1, "PO-1"), (3, "PO-1"), (5, "PO-4"),
    ]
    assert rows_of(warehouse.read("dw.purchases"), "po_number", "day", "amount", "amount_1") == [
        ("PO-1", "1/2/2024", 10.0, 0.05),
        ("PO-4", None, 14.0, 0.075),
    ]
    assert rows_of(warehouse.read_rejects("rej.purchases"), "rej_reason", "rej_detail", "row") == [
        ("DATATYPE MISMATCH", "amount: x", "PO-2|2|1/3/2024|x|7%"),
        ("DUPLICATE RECORD", "po_number: PO-1", "PO-1|3|1/4/2024|12|"),
        ("SURPLUS CELLS", "columns: 5|cells: 6", "PO-5|6||15|1%|extra"),
    ]
    stored = warehouse.read_rejects("rej.purchases").first()
    assert stored.load_datetime == datetime(2024, 1, 5, 7) and stored.job_id == "run_1"


def test_same_run_twice_gives_the_same_tables(spark, tmp_path, ctx):
    sheets, warehouse = tmp_path / "sheets", Warehouse(spark, str(tmp_path / "wh"))
    write_sheet(sheets, "p", PURCHASES)
    layers = []
    for _ in range(2):
        load_feeds(spark, str(sheets), [config("p")], ctx, warehouse, ALIGNED, idempotent=True)
        layers.append(
            [rows_of(warehouse.read(f"{t}.p"), "po_number", "amount") for t in ("src", "stg", "dw")]
            + [rows_of(warehouse.read_rejects("rej.p"), *REJECT_SCHEMA.names)]
        )
    assert layers[0] == layers[1]


def test_one_bad_feed_does_not_stop_the_others(spark, tmp_path, ctx):
    sheets, warehouse = tmp_path / "sheets", Warehouse(spark, str(tmp_path / "wh"))
    write_sheet(sheets, "good", PURCHASES)
    write_sheet(sheets, "clash", [["a", "a", "a_1"], ["1", "2", "3"]])
    write_sheet(sheets, "audit", [["po_number", "row"], ["1", "2"]])
    write_sheet(sheets, "keyless", [["a"], ["1"]])
    write_sheet(sheets, "torn", PURCHASES, "1.json")
    (sheets / "torn" / "2.json").write_text('{"range": "S!A9:Z9", "values": [["PO-9"], ["PO-')
    write_sheet(sheets, "holed", PURCHASES, "1.json", "S!A1:Z7")
    write_sheet(sheets, "holed", [["PO-9"]], "2.json", "S!A9:Z9")
    for name in ("1.json", "2.json"):
        write_sheet(sheets, "twice", PURCHASES, name)
    write_sheet(sheets, "unasked", [["a"], ["1"]])
    (sheets / "unasked" / "x.json").write_text("{")
    jobs = ("good", "clash", "audit", "keyless", "absent", "torn", "twice", "holed")
    configs = [config(j) for j in jobs]
    results = load_feeds(spark, str(sheets), configs, ctx, warehouse)
    assert {job: str(r.error) if r.error else None for job, r in results.items()} == {
        "good": None,
        "clash": "column names repeat after cleaning: ['a_1']",
        "audit": "column names collide with audit columns: ['row']",
        "keyless": "primary key columns are missing from the feed: ['po_number']",
        "absent": "No data found for: ['absent']",
        "torn": "a document cannot be parsed",
        "twice": "documents cover the same rows",
        "holed": "rows are missing between documents",
    }
    assert warehouse.read("dw.good").count() == 2
    assert not (tmp_path / "wh" / "dw" / "unasked").exists()
    assert not (tmp_path / "wh" / "tmp" / "keyless").exists()


def test_overlapping_ranges_stop_the_feed(spark, tmp_path, ctx):
    sheets, warehouse = tmp_path / "sheets", Warehouse(spark, str(tmp_path / "wh"))
    write_sheet(sheets, "s", [["po_number"], ["x"], ["a"]], "1.json", "S!A1:Z3")
    write_sheet(sheets, "s", [["a"], ["b"]], "2.json", "S!A3:Z4")
    write_sheet(sheets, "s", [["z"]], "3.json", "S!A9:Z9")
    result = load_feeds(spark, str(sheets), [config("s")], ctx, warehouse)["s"]
    assert "same rows" in str(result.error)


@pytest.mark.parametrize("job", ["my feed", "a+b", "é", "x%y"])
def test_ranges_and_folders(spark, tmp_path, ctx, job):
    """A sheet whose range starts in row 3, with an awkward name, in an awkward folder."""
    sheets, warehouse = tmp_path / "sheets", Warehouse(spark, str(tmp_path / "wh"))
    write_sheet(sheets, job, PURCHASES[:3], "1.json", "'Q!B7'!A3:Z5")
    write_sheet(sheets, job, PURCHASES[3:4], "2.json", "A6:Z6")
    write_sheet(sheets, job, PURCHASES[4:5], "3.json", "$A$7:$Z")
    tables = {layer: f"{layer}.t" for layer in FeedConfig.LAYERS}
    result = load_feeds(spark, str(sheets), [FeedConfig(job, tables, ("po_number",))], ctx, warehouse)[job]
    assert result.error is None
    assert rows_of(warehouse.read("tmp.t"), ROW_ID, "po_number") == [
        (3, "PO-1"), (4, "PO-2"), (5, "PO-1"), (6, "PO-3"),
    ]


@pytest.mark.parametrize("catalog", [False, True])
def test_failed_replace_keeps_the_table(spark, tmp_path, catalog):
    warehouse = Warehouse(spark, None if catalog else str(tmp_path))
    warehouse.replace(spark.createDataFrame([(1,)], "a int"), "stg.kept")
    broken = spark.range(3).selectExpr("IF(id = 2, raise_error('stop'), id) AS b")
    with pytest.raises(Exception, match="stop"):
        warehouse.replace(broken, "stg.kept")
    assert rows_of(warehouse.read("stg.kept"), "a") == [(1,)]
    if not catalog:
        assert [p.name for p in (tmp_path / "stg").iterdir()] == ["kept"]
        assert len(list((tmp_path / "stg" / "kept" / "data").iterdir())) == 1


STEPS = ["next_name", "put_record", "publish", "_show", "_forget", "delete_record", "read_records"]


@pytest.mark.parametrize("catalog", [False, True])
@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("late", [False, True])
def test_a_swap_that_fails_anywhere_leaves_a_table(spark, tmp_path, monkeypatch, catalog, step, late):
    """Each step raises, before or after it did its work; the table is the old or the new one, and stays usable."""
    warehouse = Warehouse(spark, None if catalog else str(tmp_path), keep=0)
    name = f"stg.swapped_{step}_{late}_{catalog}".lower()

    def put(value):
        warehouse.replace(spark.createDataFrame([(value,)], "a int"), name)

    put(1)
    where = Warehouse if hasattr(Warehouse, step) else tables
    real = getattr(where, step)

    def fails(*args, **kwargs):
        if late:
            real(*args, **kwargs)
        raise OSError("stop")

    with monkeypatch.context() as patch, warnings.catch_warnings():
        warnings.simplefilter("ignore")
        patch.setattr(where, step, fails)
        try:
            put(2)
        except OSError:
            pass
    ((value,),) = rows_of(warehouse.read(name), "a")
    assert value in (1, 2)
    put(3)
    assert rows_of(warehouse.read(name), "a") == [(3,)]


@pytest.mark.parametrize("catalog", [False, True])
def test_readers_meet_the_old_or_the_new_table(spark, tmp_path, catalog):
    warehouse = Warehouse(spark, None if catalog else str(tmp_path))
    name = "stg.read_meanwhile"
    frames = [spark.createDataFrame([(i, i)], f"a int, c{i % 2} int") for i in range(6)]
    warehouse.replace(frames[0], name)
    early = warehouse.read(name)
    done, seen = threading.Event(), []

    def read():
        while not done.is_set():
            seen.append([r.a for r in warehouse.read(name).collect()])

    with ThreadPoolExecutor(1) as pool:
        reading = pool.submit(read)
        for frame in frames[1:]:
            warehouse.replace(frame, name)
        done.set()
        reading.result()
    assert seen and all(len(rows) == 1 for rows in seen)
    assert [rows[0] for rows in seen] == sorted(rows[0] for rows in seen)
    if not catalog:
        assert early.schema.names == ["a", "c0"]
        assert len(list((tmp_path / "stg" / "read_meanwhile" / "data").iterdir())) == 2  # one kept for readers


def test_catalog_tables_of_others_are_left_alone(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS stg")
    spark.range(2).write.mode("overwrite").saveAsTable("stg.others")
    with pytest.raises(FeedError, match="of its own"):
        Warehouse(spark).replace(spark.range(1), "stg.others")
    assert spark.table("stg.others").count() == 2


def reject_rows(spark, context, values):
    base = spark.createDataFrame([(v, "r", "d") for v in values], "row string, rej_reason string, rej_detail string")
    return base.select("*", *audit_columns(context))


def test_rejects_of_feeds_are_appended_side_by_side(spark, tmp_path, ctx, monkeypatch):
    """Both attempts are written, and number their records, before either is in the log."""
    meet, real = threading.Barrier(2, timeout=60), tables.put_record

    def put_record(*args):
        meet.wait()
        real(*args)

    monkeypatch.setattr(tables, "put_record", put_record)
    warehouse = Warehouse(spark, str(tmp_path))
    with ThreadPoolExecutor(2) as pool:
        rejects = [reject_rows(spark, ctx, [v]) for v in "ab"]
        list(pool.map(lambda df: warehouse.append_rejects(df, "rej.shared"), rejects))
    assert rows_of(warehouse.read_rejects("rej.shared"), "row") == [("a",), ("b",)]


APPEND = """
import sys
from datetime import datetime
from pyspark.sql import SparkSession
from sheetmill.model import RunContext
from sheetmill.operators.validate import audit_columns
from sheetmill.sources.tables import Warehouse
base, run = sys.argv[1:]
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "1").getOrCreate())
ctx = RunContext.of(run, "20240105", datetime(2024, 1, 5, 7))
for i in range(4):
    rows = spark.createDataFrame([(f"{run}{i}", "r", "d")], "row string, rej_reason string, rej_detail string")
    Warehouse(spark, base).append_rejects(rows.select("*", *audit_columns(ctx)), "rej.shared")
"""


def test_two_processes_append_to_one_table(spark, tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    environment = {**os.environ, "PYTHONPATH": root}
    runs = [
        subprocess.Popen([sys.executable, "-c", APPEND, str(tmp_path), run], env=environment, stderr=subprocess.DEVNULL)
        for run in ("x", "y")
    ]
    assert [p.wait(timeout=240) for p in runs] == [0, 0]
    stored = Warehouse(spark, str(tmp_path)).read_rejects("rej.shared")
    assert rows_of(stored, "row") == sorted((f"{run}{i}",) for run in "xy" for i in range(4))


def test_uncommitted_attempts_are_not_read(spark, tmp_path, ctx, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.append_rejects(reject_rows(spark, ctx, ["a"]), "rej.t")

    def fails(*args):
        raise OSError("stop")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "put_record", fails)
        with pytest.raises(OSError, match="stop"):
            warehouse.append_rejects(reject_rows(spark, ctx, ["b"]), "rej.t")
    assert rows_of(warehouse.read_rejects("rej.t"), "row") == [("a",)]
    assert len(list((tmp_path / "rej" / "t" / "data").iterdir())) == 1


@pytest.mark.parametrize("catalog", [False, True])
def test_rejects_of_one_run(spark, tmp_path, ctx, catalog):
    """Folders of other runs are not read; an attempt of two runs loses only the replaced one."""
    warehouse = Warehouse(spark, None if catalog else str(tmp_path))
    later = RunContext.of("it's \\\\ later", "20240106", ctx.load_datetime)
    both = reject_rows(spark, ctx, ["a"]).unionByName(reject_rows(spark, later, ["b"]))
    warehouse.append_rejects(both, "rej.runs")
    warehouse.append_rejects(reject_rows(spark, ctx, ["c"]), "rej.runs")
    assert rows_of(warehouse.read_rejects("rej.runs", later), "row") == [("b",)]
    warehouse.append_rejects(reject_rows(spark, later, ["d"]), "rej.runs", later)
    assert rows_of(warehouse.read_rejects("rej.runs"), "row") == [("a",), ("c",), ("d",)]
    assert rows_of(warehouse.read_rejects("rej.runs", later), "row") == [("d",)]
    assert rows_of(warehouse.read_rejects("rej.runs", ctx), "row") == [("a",), ("c",)]
    if catalog:
        assert rows_of(spark.table("rej.runs"), "row") == [("a",), ("c",), ("d",)]


def test_unusable_configurations_do_not_stop_the_others(spark, tmp_path, ctx):
    write_sheet(tmp_path / "sheets", "a", [["x"], ["1"]])
    (tmp_path / "a.yaml").write_text(
        "job_name: a\ndag_params: {field_delimiter: '|'}\n"
        "bq_tables: {tmp: t.a, src: s.a, stg: g.a, dw: d.a, rej: r.a}\nbq_schema: {primary_key: [x]}\n"
    )
    (tmp_path / "b.yaml").write_text("job_name: [")
    (tmp_path / "c.yaml").write_text("job_name: c\n")
    configs = load_configs(str(tmp_path))
    assert [type(c) for c in configs] == [FeedConfig, BadConfig, BadConfig]
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    results = load_feeds(spark, str(tmp_path / "sheets"), configs, ctx, warehouse)
    assert [job for job, r in results.items() if r.error] == ["b", "c"]
    assert results["a"].counts["dw"] == 1


def test_header_only_feed(spark, tmp_path, ctx):
    sheets, warehouse = tmp_path / "sheets", Warehouse(spark, str(tmp_path / "wh"))
    write_sheet(sheets, "p", [["po_number", "n"]])
    result = load_feeds(spark, str(sheets), [config("p")], ctx, warehouse)["p"]
    assert result.error is None and result.schema.typed == ()
    assert warehouse.read("dw.p").columns[:2] == ["po_number", "n"]
    assert warehouse.read("dw.p").count() == 0


def test_sampled_inference(spark, tmp_path, ctx):
    sheets, warehouse = tmp_path / "sheets", Warehouse(spark, str(tmp_path / "wh"))
    write_sheet(sheets, "p", [["po_number", "n"], *[[f"P{i}", str(i)] for i in range(500)]])
    result = load_feeds(spark, str(sheets), [config("p")], ctx, warehouse, sample_limit=100)["p"]
    assert result.error is None and result.schema.numeric == ("n",)


DRIFT = {
    "added": ([["po_number", "n", "new"], ["a", "1", "x"]], ("po_number", "n", "new"), ("n",)),
    "removed": ([["po_number"], ["a"]], ("po_number",), ()),
    "renamed": ([["po_number", "m"], ["a", "1"]], ("po_number", "m"), ("m",)),
    "reordered": ([["n", "po_number"], ["1", "a"]], ("n", "po_number"), ("n",)),
    "retyped": ([["po_number", "n"], ["a", "text"]], ("po_number", "n"), ()),
}


@pytest.mark.parametrize("change", DRIFT)
def test_drift(spark, tmp_path, ctx, change):
    values, definition, numeric = DRIFT[change]
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    write_sheet(tmp_path / "one", "p", [["po_number", "n"], ["a", "1"], ["b", "2"], ["c", "x"]])
    load_feeds(spark, str(tmp_path / "one"), [config("p")], ctx, warehouse)
    assert warehouse.read("dw.p").columns[:2] == ["po_number", "n"]
    write_sheet(tmp_path / "two", "p", values)
    later = RunContext.of("run_2", "20240106", ctx.load_datetime)
    result = load_feeds(spark, str(tmp_path / "two"), [config("p")], later, warehouse)["p"]
    assert result.error is None
    assert (result.schema.definition, result.schema.numeric) == (definition, numeric)
    for layer in ("tmp", "src", "stg", "dw"):
        assert warehouse.read(f"{layer}.p").count() == 1
    assert tuple(warehouse.read("dw.p").columns[: len(definition)]) == definition
    assert warehouse.read_rejects("rej.p").count() == 1


def test_intermediate_tables_are_discarded(spark, tmp_path, ctx):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    scratch_path(spark, "x")  # the session's own folder
    before = set(shared.glob("*/*"))
    write_sheet(tmp_path / "sheets", "p", PURCHASES)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    load_feeds(spark, str(tmp_path / "sheets"), [config("p")], ctx, warehouse)
    assert set(shared.glob("*/*")) == before


CONTROL = [
    ["job_name", "Status", "schedule", "field_delimiter", "gsheet_id", "range"]
    + ["gcs_bucket", "gcs_folder", "tmp_table", "src_table", "stg_table", "dw_table", "rej_table"]
    + ["primary_keys"],
    ["p", "ok", "@daily", "|", "id", "S!A1:Z", "b", "f", "t.p", "s.p", "g.p", "d.p", "r.p", "po_number"],
    ["q", "DISABLED", "", "|", "id", "S!A1:Z", "b", "f", "t.q", "s.q", "g.q", "d.q", "r.q", "a, b"],
]


def test_command_line_with_control_sheet(spark, tmp_path, capsys):
    write_sheet(tmp_path / "sheets", "p", PURCHASES)
    write_sheet(tmp_path / "sheets", "q", PURCHASES)
    write_sheet(tmp_path / "control", "pipeline_control", CONTROL)
    common = ["--sheets", str(tmp_path / "sheets"), "--job-id", "r1", "--date", "20240105"]
    common += ["--warehouse", str(tmp_path / "wh"), "--control", str(tmp_path / "control")]
    assert main(common, spark) == 0
    assert "dw=2" in capsys.readouterr().out
    assert Warehouse(spark, str(tmp_path / "wh")).read("d.p").count() == 2
    assert main([*common, "--resume"], spark) == 0
    assert "dw=2" in capsys.readouterr().out
    assert not (tmp_path / "wh" / "d" / "q").exists()
    with pytest.raises(FeedError, match="DISABLED"):
        main([*common, "--job", "q"], spark)


def test_command_line_with_yaml(spark, tmp_path, capsys):
    write_sheet(tmp_path / "sheets", "a", [["x", "y"], ["1", "2"]])
    for job in "ab":
        (tmp_path / f"{job}.yaml").write_text(
            f"job_name: {job}\ndag_params: {{field_delimiter: '|'}}\n"
            f"bq_tables: {{tmp: t.{job}, src: s.{job}, stg: g.{job}, dw: d.{job}, rej: r.{job}}}\n"
            "bq_schema: {primary_key: [x]}\n"
        )
    common = ["--sheets", str(tmp_path / "sheets"), "--job-id", "r1", "--date", "20240105"]
    common += ["--warehouse", str(tmp_path / "wh"), "--configs", str(tmp_path)]
    assert main([*common, "--job", "a"], spark) == 0
    assert main(common, spark) == 1
    assert "b: failed: No data found" in capsys.readouterr().err


def test_feeds_may_share_rejects_only(spark, tmp_path, ctx):
    for job in "ab":
        write_sheet(tmp_path / "sheets", job, PURCHASES)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    one, two = config("a"), config("b")
    shared = [replace(c, tables={**c.tables, "rej": "rej.all"}) for c in (one, two)]
    results = load_feeds(spark, str(tmp_path / "sheets"), shared, ctx, warehouse)
    assert [r.error for r in results.values()] == [None, None]
    assert warehouse.read_rejects("rej.all").count() == 6
    with pytest.raises(FeedError, match=r"more than one.*rej\.all"):
        load_feeds(spark, str(tmp_path / "sheets"), shared, ctx, warehouse, idempotent=True)
    clash = replace(two, tables={**two.tables, "dw": one.tables["dw"]})
    with pytest.raises(FeedError, match=r"more than one.*dw\.a"):
        load_feeds(spark, str(tmp_path / "sheets"), [one, clash], ctx, warehouse)
