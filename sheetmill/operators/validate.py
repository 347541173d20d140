"""Format checks that route rows to SRC or to the rejects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetmill.functions.formats import matches
from sheetmill.functions.text import quoted, row_text, strip
from sheetmill.model import REJECT_SCHEMA, ROW_ID, RunContext, SchemaInfo
from sheetmill.rules import DATATYPE_MISMATCH, LOAD_ZONE, RuleSet


def load_clock(utc: Column) -> Column:
    """A time in UTC as the local time that loads are stamped with."""
    return F.convert_timezone(F.lit("UTC"), F.lit(LOAD_ZONE), utc.cast("timestamp_ntz"))


def run_context(spark: SparkSession, job_id: str, ds_nodash: str) -> RunContext:
    """A run stamped by the session's clock, which is read once."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    now = spark.range(1).select(load_clock(utc).alias("now")).first()["now"]
    return RunContext.of(job_id, ds_nodash, now)


def audit_columns(ctx: RunContext) -> list[Column]:
    return [
        F.lit(ctx.load_datetime.isoformat(sep=" ")).cast("timestamp_ntz").alias("load_datetime"),
        F.lit(ctx.job_date).alias("job_date"),
        F.lit(ctx.job_id).alias("job_id"),
    ]


def accepted(schema: SchemaInfo, rules: RuleSet) -> Column:
    """True where every typed column passes its accept test."""
    tests = [matches(quoted(c), rules.accept_date) for c in schema.date]
    tests += [matches(quoted(c), rules.accept_numeric) for c in schema.numeric]
    return reduce(Column.__and__, tests, F.lit(True))


def failures(schema: SchemaInfo, rules: RuleSet) -> list[tuple[str, Column]]:
    failures = [(c, ~matches(quoted(c), rules.reject_date)) for c in schema.date]
    failures += [(c, ~matches(quoted(c), rules.reject_numeric)) for c in schema.numeric]
    return failures


def rejected(schema: SchemaInfo, rules: RuleSet) -> Column:
    """True where any typed column fails its reject test."""
    return reduce(Column.__or__, [fails for _, fails in failures(schema, rules)], F.lit(False))


def reject_detail(schema: SchemaInfo, rules: RuleSet, delimiter: str) -> Column:
    """``"col: value"`` of each failing column, dates first, joined by the delimiter."""
    details = [
        F.when(fails, F.concat(F.lit(f"{c}: "), quoted(c)))
        for c, fails in failures(schema, rules)
    ]
    return F.concat_ws(delimiter, *details) if details else F.lit("")


def route(schema: SchemaInfo, rules: RuleSet) -> Column:
    """``src``, ``rej`` or ``leaked``: a row neither side takes under the default rules."""
    return (
        F.when(accepted(schema, rules), "src")
        .when(rejected(schema, rules), "rej")
        .otherwise("leaked")
    )


def ext_to_src(
    tmp: DataFrame,
    schema: SchemaInfo,
    ctx: RunContext,
    rules: RuleSet,
    delimiter: str = "|",
    order: str = ROW_ID,
    stripped: bool = False,
) -> DataFrame:
    """Accepted rows: trimmed text columns, audit columns and the raw row.

    ``stripped`` tells that the cells are clean text already, as ``assemble`` leaves them.
    """
    cells = {c: quoted(c) if stripped else strip(quoted(c).cast("string")) for c in schema.definition}
    return tmp.filter(accepted(schema, rules)).select(
        *[cell.alias(c) for c, cell in cells.items()],
        *audit_columns(ctx),
        row_text(schema.definition, delimiter).alias("row"),
        quoted(order).alias(ROW_ID),
    )


def route_rows(
    tmp: DataFrame,
    schema: SchemaInfo,
    ctx: RunContext,
    rules: RuleSet,
    delimiter: str = "|",
    *keep: Column,
    order: str = ROW_ID,
    stripped: bool = False,
) -> DataFrame:
    """Every row once, with its route: the columns of ``ext_to_src``, then ``rej_reason`` and ``rej_detail``
    of rejected rows, ``keep`` and ``_route``.

    Written by ``_route``, its parts are SRC and the datatype rejects, so TMP is scanned once for both.
    """
    cells = {c: quoted(c) if stripped else strip(quoted(c).cast("string")) for c in schema.definition}
    where = route(schema, rules)
    return tmp.select(
        *[cell.alias(c) for c, cell in cells.items()],
        *audit_columns(ctx),
        row_text(schema.definition, delimiter).alias("row"),
        quoted(order).alias(ROW_ID),
        F.when(where == "rej", DATATYPE_MISMATCH).alias("rej_reason"),
        F.when(where == "rej", reject_detail(schema, rules, delimiter)).alias("rej_detail"),
        *keep,
        where.alias("_route"),
    )


def rej_datatype(
    tmp: DataFrame,
    schema: SchemaInfo,
    ctx: RunContext,
    rules: RuleSet,
    delimiter: str = "|",
    *keep: Column,
) -> DataFrame:
    """Rows that fail a format check, in the layout of the reject table.

    Without typed columns nothing can fail and the result is empty. Columns in ``keep`` are
    carried along after the reject layout.
    """
    rows = tmp.filter(rejected(schema, rules)).select(
        row_text(schema.definition, delimiter).alias("row"),
        F.lit(DATATYPE_MISMATCH).alias("rej_reason"),
        reject_detail(schema, rules, delimiter).alias("rej_detail"),
        *audit_columns(ctx),
        *keep,
    )
    return rows if keep else rows.select(*REJECT_SCHEMA.names)
