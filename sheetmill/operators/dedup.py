"""One row per business key; the others become rejects.

Within a run the first sheet row of a key survives; where positions repeat, which sheets do
not, a hash of the row settles it. Survivors and duplicates are planned apart, but follow the same
order, so every row is in exactly one of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetmill.functions.text import quoted, value_text
from sheetmill.model import AUDIT_COLUMNS, REJECT_SCHEMA, ROW_ID, RunContext, SchemaInfo
from sheetmill.operators.cast import run_slice
from sheetmill.operators.ranking import BLOCK_POSITIONS, rank_rows
from sheetmill.operators.validate import audit_columns
from sheetmill.rules import DUPLICATE_RECORD


def _content(df: DataFrame) -> Column:
    return F.xxhash64(*map(quoted, df.columns))


def dedup_rank(
    stg: DataFrame, keys: Sequence[str], ctx: RunContext, block: int | None = BLOCK_POSITIONS
) -> DataFrame:
    """Add ``rownum`` within the business key; NULL keys count as equal."""
    return rank_rows(run_slice(stg, ctx), keys, ROW_ID, block=block, then=[_content(stg)])


def repeated_keys(stg: DataFrame, keys: Sequence[str], ctx: RunContext) -> DataFrame:
    """Keys held by several rows of the run, with the first of these rows.

    Only key columns are read, and copies are combined before the shuffle.
    """
    return (
        run_slice(stg, ctx)
        .groupBy(*[quoted(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
        .agg(F.min(ROW_ID).alias("_first"), F.count("*").alias("_copies"))
        .filter("_copies > 1")
        .drop("_copies")
    )


def _same_key(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & quoted(k).eqNullSafe(F.col(f"_key_{i}"))
    return same


def stg_to_dw(
    stg: DataFrame,
    schema: SchemaInfo,
    keys: Sequence[str],
    ctx: RunContext,
    repeated: DataFrame | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """First row of every business key, in each part of the table that the columns ``within`` make; they are kept.

    Ranking shuffles whole rows, but its ``rownum = 1`` filter lets Spark drop all but one
    row per key and task before the shuffle, so a hot key costs a row per task and not its
    whole group. Where positions do not repeat, rows may be looked up in the keys that occur more
    than once (``repeated``) instead; with that side broadcast they stay where they are.
    """
    schema.require_keys(keys)
    keys = [*within, *keys]
    rows = run_slice(stg, ctx)
    if repeated is None:
        first = Window.partitionBy(*map(quoted, keys)).orderBy(ROW_ID, _content(stg))
        kept = rows.withColumn("rownum", F.row_number().over(first)).filter("rownum = 1")
    else:
        kept = rows.join(repeated, _same_key(keys), "left").filter(
            F.col("_first").isNull() | (F.col(ROW_ID) == F.col("_first"))
        )
    return kept.select(*map(quoted, schema.definition), *AUDIT_COLUMNS, *map(quoted, within))


def duplicate_rows(
    stg: DataFrame,
    keys: Sequence[str],
    ctx: RunContext,
    repeated: DataFrame | None = None,
    distinct_positions: bool = False,
) -> DataFrame:
    """Every row of the run but the first of its key.

    The other side has one row per repeated key. It is broadcast when Spark finds it small
    enough; otherwise both sides are sorted and merged, and hot keys are split at run time. Where positions
    are known to be distinct, as those of a whole sheet are, that is all; otherwise rows at a key's
    first position are told apart by their content, which shuffles the copies again.
    """
    if repeated is None:
        repeated = repeated_keys(stg, keys, ctx)
    rows = run_slice(stg, ctx)
    if distinct_positions:
        return rows.join(repeated, _same_key(keys) & (F.col(ROW_ID) > F.col("_first"))).select(*rows.columns)
    copies = rows.join(repeated, _same_key(keys) & (F.col(ROW_ID) >= F.col("_first")))
    # Of rows at the first position one survives; elsewhere numbers do not matter.
    tie = Window.partitionBy(*map(quoted, keys), ROW_ID).orderBy(_content(stg))
    nth = copies.withColumn("_nth", F.row_number().over(tie))
    return nth.where((F.col(ROW_ID) > F.col("_first")) | (F.col("_nth") > 1)).select(*rows.columns)


def duplicate_detail(df: DataFrame, keys: Sequence[str], delimiter: str) -> Column:
    """``"key: value"`` of each key column, NULL written as ``NULL``."""
    parts = [
        F.concat(
            F.lit(f"{k}: "), F.coalesce(value_text(quoted(k), df.schema[k].dataType), F.lit("NULL"))
        )
        for k in keys
    ]
    return F.concat_ws(delimiter, *parts)


def rej_duplicate(
    stg: DataFrame,
    keys: Sequence[str],
    ctx: RunContext,
    delimiter: str = "|",
    repeated: DataFrame | None = None,
    distinct_positions: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    """Duplicate rows in the layout of the reject table, then the columns ``within``, which part the table."""
    return duplicate_rows(stg, [*within, *keys], ctx, repeated, distinct_positions).select(
        "row",
        F.lit(DUPLICATE_RECORD).alias("rej_reason"),
        duplicate_detail(stg, keys, delimiter).alias("rej_detail"),
        *audit_columns(ctx),
        *map(quoted, within),
    )
