"""From accepted text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetmill.functions.formats import to_date, to_number, to_text
from sheetmill.functions.text import quoted
from sheetmill.model import AUDIT_COLUMNS, ROW_ID, RunContext, SchemaInfo
from sheetmill.rules import RuleSet


def run_slice(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Rows of one run."""
    return df.filter((F.col("job_id") == ctx.job_id) & (F.col("job_date") == F.lit(ctx.job_date)))


def typed(column: str, schema: SchemaInfo, rules: RuleSet) -> Column:
    if column in schema.date:
        return to_date(quoted(column), rules)
    if column in schema.numeric:
        return to_number(quoted(column))
    return to_text(quoted(column))


def src_to_stg(
    src: DataFrame, schema: SchemaInfo, ctx: RunContext, rules: RuleSet, *keep: Column
) -> DataFrame:
    """The run's rows with dates and doubles in place of text; blanks are NULL.

    Columns in ``keep`` are carried along after the layout.
    """
    return run_slice(src, ctx).select(
        *[typed(c, schema, rules).alias(c) for c in schema.definition],
        *AUDIT_COLUMNS,
        "row",
        ROW_ID,
        *keep,
    )
