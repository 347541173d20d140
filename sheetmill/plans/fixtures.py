"""Feeds derived from the given tables, as SQL both Spark and the checking engine can run.

Each fixture is a projection over a whole table; ``ARRAY`` stands for the array constructor,
which the engines name differently.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetmill.model import ROW_ID, RunContext, SchemaInfo

CTX = RunContext.of("run_1", "20240105", datetime(2024, 1, 5, 7))
DELIMITER = "|"
KEYS = ("po_number", "branch_id", "transaction_date")
COLUMNS = (*KEYS, "amount", "discount", "priority")
#: Groups that inference finds under the default rules.
INFERRED = SchemaInfo(COLUMNS, ("transaction_date",), ("branch_id", "amount", "discount"))
#: The same feed with the date column left as text.
FORCED = SchemaInfo(COLUMNS, (), ("branch_id", "amount", "discount"))


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


_K = "(o_orderkey - CASE WHEN o_orderkey % 20 = 19 THEN 1 ELSE 0 END)"
_MONTH = _s(f"{_K} % 12 + 1")
_DAY = _s(f"{_K} % 28 + 1")
_WHOLE = _s("CAST(floor(o_totalprice) AS BIGINT)")

PURCHASES = {
    ROW_ID: "o_orderkey",
    "po_number": f"'PO-' || lpad({_s(_K)}, 8, '0')",
    "branch_id": f"CASE WHEN {_K} % 97 = 0 THEN NULL ELSE {_s(_K + ' % 50')} END",
    "transaction_date": f"""CASE WHEN {_K} % 31 = 0 THEN NULL
        WHEN {_K} % 29 = 0 THEN 'n/a'
        WHEN {_K} % 10 IN (0, 1) THEN {_MONTH} || '/' || {_DAY} || '/2024'
        WHEN {_K} % 10 = 2 THEN {_MONTH} || '/' || {_DAY} || '/24'
        WHEN {_K} % 10 = 3 THEN {_DAY} || '-Jan-2024'
        ELSE '2024-' || lpad({_MONTH}, 2, '0') || '-' || lpad({_DAY}, 2, '0') END""",
    "amount": f"""CASE WHEN o_orderkey % 30 = 0 THEN NULL
        WHEN o_orderkey % 41 = 0 THEN 'abc'
        WHEN o_orderkey % 25 = 0 THEN '1,' || lpad({_s('o_orderkey % 1000')}, 3, '0') || '.50'
        WHEN o_orderkey % 53 = 0 THEN '-12'
        WHEN o_orderkey % 2 = 0 THEN {_WHOLE}
        ELSE {_WHOLE} || '.25' END""",
    "discount": """CASE o_orderkey % 7 WHEN 0 THEN '7.5%' WHEN 1 THEN '10%' WHEN 2 THEN NULL
        ELSE '0.05' END""",
    "priority": "o_orderpriority",
}
#: Purchases whose whole business key is missing now and then.
NULL_KEYS = {
    name: f"CASE WHEN o_orderkey % 100 = 0 THEN NULL ELSE {rule} END" if name in KEYS else rule
    for name, rule in PURCHASES.items()
}
#: Purchases loaded by several runs.
RUN_ROWS = {
    **PURCHASES,
    "job_id": "'run_' || lower(o_orderstatus)",
    "job_date": "CASE WHEN o_orderstatus = 'P' THEN DATE '2024-01-04' ELSE DATE '2024-01-05' END",
}
RUN_CTX = RunContext.of("run_f", "20240105", datetime(2024, 1, 5, 7))

#: Purchases of a later run: the branch has another name, dates have become words, the discount is gone and the
#: clerk is new.
DRIFTED = {
    ROW_ID: PURCHASES[ROW_ID],
    "po_number": PURCHASES["po_number"],
    "branch": PURCHASES["branch_id"],
    "transaction_date": "CASE WHEN o_orderkey % 3 = 0 THEN PURCHASE_DATE ELSE 'day ' || o_orderstatus END".replace(
        "PURCHASE_DATE", PURCHASES["transaction_date"]
    ),
    "amount": PURCHASES["amount"],
    "clerk": "o_orderstatus",
    "priority": "o_orderpriority",
    "customer": _s("o_custkey"),
}
DRIFTED_COLUMNS = tuple(c for c in DRIFTED if c != ROW_ID)
DRIFTED_CTX = RunContext.of("run_2", "20240106", datetime(2024, 1, 6, 7))

HEADERS = {
    "feed": "p_brand",
    "pos": "p_partkey",
    "header": """CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN ' ' || p_name
        WHEN 2 THEN p_name || ' (IDR)' WHEN 3 THEN replace(p_name, ' ', '  ') ELSE '' END""",
}

_KEY_TEXT = _s("o_orderkey")
RAGGED = {
    ROW_ID: "o_orderkey",
    "cells": f"""CASE o_orderkey % 3 WHEN 0 THEN ARRAY({_KEY_TEXT}, o_orderstatus)
        WHEN 1 THEN ARRAY({_KEY_TEXT}, o_orderstatus, o_orderpriority)
        ELSE ARRAY({_KEY_TEXT}, o_orderstatus, o_orderpriority, {_s('o_custkey')}) END""",
}
RAGGED_WIDTH = 3

# Code points 9, 10 and 160 around a whole text: a tab, a line feed and a no-break space.
CELLS = {
    "doc_id": "doc_id",
    "cell": """CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN chr(9) || text || chr(160)
        ELSE chr(160) || chr(10) || text || ' ' || chr(9) END""",
}
LANDING = {
    "doc_id": _s("doc_id"),
    "text": CELLS["cell"],
    "origin": "lang || '|' || coalesce(source, '') || ' \"' || lang || '\"'",
    "n_chars": _s("n_chars"),
}

FEEDS = {
    "feed": "event_type",
    ROW_ID: "event_id + 1",
    "cells": f"""ARRAY({_s('CAST(floor(value) AS BIGINT)')} || CASE WHEN event_id % 2 = 0
        THEN '.5' ELSE '' END, {_s('user_id')}, props)""",
}

#: A feed without a control row.
UNKNOWN_JOB = "signup"
#: Columns that hold text only.
TEXT_COLUMNS = ("name", "brand")
TEXTS = {ROW_ID: "p_partkey", "name": "p_name", "brand": "p_brand"}
CONTROL_STATUS = """CASE length(event_type) % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'DISABLED'
    ELSE 'OK' END"""
KEY_LISTS = {
    "job_name": "c_name",
    "primary_keys": """CASE c_custkey % 4 WHEN 0 THEN 'event_id, user_id' WHEN 1 THEN ''
        WHEN 2 THEN NULL ELSE c_name || ' ,' || c_mktsegment || ',' END""",
}

#: Sheets for loading many feeds at once: table, row key, header and cells.
SHEETS = {
    "purchases": (
        "orders",
        "o_orderkey",
        ("PO Number", " Branch ID", "Transaction-Date", "AMOUNT", "discount (%)", "Priority"),
        tuple(PURCHASES[c] for c in COLUMNS),
    ),
    "catalogue": (
        "part",
        "p_partkey",
        ("Name", "Brand", "Size", "Price", "Price"),
        (
            "' ' || replace(p_name, ' ', chr(10))",
            "p_brand",
            _s("p_size"),
            _s("CAST(round(p_retailprice * 100) AS BIGINT)"),
            f"{_s('p_size')} || '.5%'",
        ),
    ),
    "site visits": (
        "events",
        "event_id",
        ("User", "Day", "Kind"),
        (
            _s("user_id"),
            f"{_s('month(ts)')} || '/' || {_s('day(ts)')} || '/' || {_s('year(ts)')}",
            "event_type",
        ),
    ),
    "suppliers": (
        "supplier",
        "s_suppkey",
        ("Supplier", "Nation"),
        ("s_name", _s("s_nationkey")),
    ),
}
SHEET_KEYS = {
    "purchases": "po_number, branch_id, transaction_date",
    "catalogue": "name, brand",
    "site visits": "user, day",
    "suppliers": "supplier",
}
SHEET_STATUS = {"purchases": "OK", "catalogue": "ok", "site visits": "Ok", "suppliers": "DISABLED"}
#: Rows of a sheet above its exported range.
SHEET_START = {"purchases": 0, "catalogue": 2, "site visits": 0, "suppliers": 4}
#: Sheet rows per exported document.
DOCUMENT_ROWS = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(source: DataFrame, rules: dict[str, str]) -> DataFrame:
    exprs = [f"{rule.replace('ARRAY(', 'array(')} AS `{name}`" for name, rule in rules.items()]
    return source.selectExpr(*exprs)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "orders"), PURCHASES)


def export_sheets(spark: SparkSession, sf_dir: str, feeds: list[str], path: str) -> None:
    """Write feeds as value documents of many rows, one document per line.

    The header is a document of its own, in the sheet's first exported row.
    """
    documents = spark.createDataFrame(
        [
            (feed, f"'{feed}!'!A{SHEET_START[feed] + 1}:Z{SHEET_START[feed] + 1}", [list(SHEETS[feed][2])])
            for feed in feeds
        ],
        "feed string, range string, values array<array<string>>",
    )
    for feed in feeds:
        name, key, _, cells = SHEETS[feed]
        rows = table(spark, sf_dir, name).selectExpr(
            f"{key} AS place",
            f"{key} DIV {DOCUMENT_ROWS} AS part",
            f"struct({key}, array({', '.join(cells)}) AS cells) AS line",
        )
        first = f"(part * {DOCUMENT_ROWS} + {SHEET_START[feed]} + 2)"
        documents = documents.unionByName(
            rows.groupBy("part")
            .agg(F.sort_array(F.collect_list("line")).alias("lines"))
            .selectExpr(
                f"'{feed}' AS feed",
                f"concat('\\'{feed}!\\'!A', {first}, ':Z', {first} + {DOCUMENT_ROWS - 1}) AS range",
                "transform(lines, l -> l.cells) AS values",
            )
        )
    documents.write.partitionBy("feed").json(path)


def control_sheet(spark: SparkSession) -> DataFrame:
    """Control rows for the exported sheets."""
    rows = [
        (
            i, feed, SHEET_STATUS[feed], "@daily", DELIMITER, f"sheet-{feed}", f"{feed}!A1:Z",
            "landing", feed, *(f"{layer}.{feed.replace(' ', '_')}" for layer in ("tmp", "src", "stg")),
            f"dw.{feed.replace(' ', '_')}", f"rej.{feed.replace(' ', '_')}", SHEET_KEYS[feed],
        )
        for i, feed in enumerate(SHEETS)
    ]
    # A row without tables: its job cannot run, the others do.
    broken = (len(rows), "broken", "OK", "@daily", DELIMITER, "x", "x", "x", "x", *[None] * 5, "a")
    rows.append(broken)
    return spark.createDataFrame(
        rows,
        "pos int, job_name string, status string, schedule string, field_delimiter string, "
        "gsheet_id string, range string, gcs_bucket string, gcs_folder string, "
        "tmp_table string, src_table string, stg_table string, dw_table string, "
        "rej_table string, primary_keys string",
    )
