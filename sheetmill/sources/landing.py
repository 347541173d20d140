"""Delimited landing files: a header, minimal quoting, one folder per job, date and run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sheetmill.functions.text import blank_to_null, quoted
from sheetmill.model import RunContext


def _format(delimiter: str) -> dict[str, str]:
    # Quotes are doubled, edges are kept and only "\n" ends a line, so a cell that holds a
    # quote, the delimiter or "\r" comes back as it was.
    return {
        "sep": delimiter,
        "header": "true",
        "quote": '"',
        "escape": '"',
        "lineSep": "\n",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "encoding": "UTF-8",
    }


def landing_path(folder: str, job_name: str, ctx: RunContext) -> str:
    return f"{folder}/{job_name}/{ctx.job_date:%Y%m%d}/{ctx.job_id}"


def write_landing(df: DataFrame, path: str, delimiter: str = "|") -> None:
    """Write text columns. Missing cells are blank, since a line without any text is dropped."""
    cells = df.select(*[F.coalesce(quoted(c), F.lit("")).alias(c) for c in df.columns])
    cells.write.mode("overwrite").options(**_format(delimiter)).csv(path)


def read_landing(
    spark: SparkSession, path: str, columns: Sequence[str], delimiter: str = "|"
) -> DataFrame:
    """Load as text columns. Short lines end in NULLs and blank cells are NULL."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    loaded = spark.read.schema(schema).options(**_format(delimiter)).csv(path)
    return loaded.select(*[blank_to_null(quoted(c)).alias(c) for c in columns])
