"""What became of the rows: rejects by cause, and counts that must add up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sheetmill.functions.text import quoted
from sheetmill.model import RunContext, SchemaInfo
from sheetmill.operators.cast import run_slice, src_to_stg
from sheetmill.operators.validate import audit_columns, ext_to_src, failures, rejected, route
from sheetmill.rules import DATATYPE_MISMATCH, DUPLICATE_RECORD, RuleSet


def reject_summary(
    tmp: DataFrame,
    stg: DataFrame,
    schema: SchemaInfo,
    keys: Sequence[str],
    ctx: RunContext,
    rules: RuleSet,
) -> DataFrame:
    """Rejects by run and reason (``column_name`` NULL), and by failing column.

    One scan of TMP counts all causes side by side, and one of STG the copies of each key.
    """
    names = dict(enumerate(schema.typed))
    causes = {-1: rejected(schema, rules), **dict(enumerate(f for _, f in failures(schema, rules)))}
    failing = tmp.agg(*[F.count_if(test).alias(str(i)) for i, test in causes.items()])
    cells = [
        F.struct(
            F.lit(DATATYPE_MISMATCH).alias("rej_reason"),
            F.lit(names.get(i)).cast("string").alias("column_name"),
            F.col(str(i)).alias("n_rows"),
        )
        for i in causes
    ]
    mismatched = failing.select(F.inline(F.array(*cells)))
    copies = run_slice(stg, ctx).groupBy(*map(quoted, keys)).agg(F.count("*").alias("n"))
    repeated = copies.select(
        F.lit(DUPLICATE_RECORD).alias("rej_reason"),
        F.lit(None).cast("string").alias("column_name"),
        (F.col("n") - 1).alias("n_rows"),
    )
    repeated = repeated.groupBy("rej_reason", "column_name").agg(F.sum("n_rows").alias("n_rows"))
    _, job_date, job_id = audit_columns(ctx)
    return (
        mismatched.unionByName(repeated)
        .where("n_rows > 0")
        .select(job_id, job_date, "rej_reason", "column_name", "n_rows")
    )


def reconcile(
    tmp: DataFrame,
    stg: DataFrame,
    schema: SchemaInfo,
    keys: Sequence[str],
    ctx: RunContext,
    rules: RuleSet,
) -> DataFrame:
    """``(layer, n_rows)`` with tmp = src + rej_datatype + leaked and src = dw + rej_duplicate."""
    where = route(schema, rules)
    routed = (
        tmp.select(where.alias("route"))
        .agg(
            F.count("*").alias("tmp"),
            F.count_if(F.col("route") == "src").alias("src"),
            F.count_if(F.col("route") == "rej").alias("rej_datatype"),
            F.count_if(F.col("route") == "leaked").alias("leaked"),
        )
        .unpivot([], ["tmp", "src", "rej_datatype", "leaked"], "layer", "n_rows")
    )
    copies = run_slice(stg, ctx).groupBy(*map(quoted, keys)).agg(F.count("*").alias("n"))
    kept = copies.agg(
        F.count("*").alias("dw"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rej_duplicate"),
    ).unpivot([], ["dw", "rej_duplicate"], "layer", "n_rows")
    return routed.unionByName(kept)


def typed_rows(
    tmp: DataFrame, schema: SchemaInfo, ctx: RunContext, rules: RuleSet, delimiter: str = "|"
) -> DataFrame:
    """STG straight from TMP, without the tables in between."""
    return src_to_stg(ext_to_src(tmp, schema, ctx, rules, delimiter), schema, ctx, rules)
