"""Exported sheet values as rows of cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sheetmill.model import ROW_ID

_VALUES = T.StructType(
    [
        T.StructField("range", T.StringType()),
        T.StructField("values", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("_damaged", T.StringType()),
    ]
)
#: Row position that marks a document that could not be parsed.
DAMAGED_ROW = -1


def read_sheets(
    spark: SparkSession, path: str, multi_line: bool = True, mark_damaged: bool = False
) -> DataFrame:
    """Read ``<path>/<feed>/*.json`` value documents as ``(feed, _src_row, cells, ...)``.

    A document holds ``values`` (a list of rows) and optionally the ``range`` it covers, such
    as ``Sheet!A50001:Z100000`` or ``A3:Z``. A large feed is exported as many ranges, which are
    read in parallel; ``_src_row`` is the row's position in the whole sheet, counted from 0, and
    ``doc_first`` to ``doc_last`` are those its document covers: as far as the range says, or the
    values go. A feed's header is its first exported row.
    With ``multi_line=False`` every line of a file is a document. A filter on ``feed`` keeps
    the files of other feeds from being opened.

    A damaged document fails the read, or with ``mark_damaged`` becomes a single row at
    position ``DAMAGED_ROW``; its rows are never left out in silence.
    """
    documents = (
        spark.read.schema(_VALUES)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE" if mark_damaged else "FAILFAST")
        .option("columnNameOfCorruptRecord", "_damaged")
        .option("recursiveFileLookup", True)
        .json(path)
    )
    # Paths are percent-encoded, but a plus sign is one.
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    folder = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    # What follows the sheet's name, which may hold exclamation marks itself.
    cells = F.regexp_extract("range", r"([^!]*)\z", 1)
    named = F.instr("range", "!") > 0
    pair = r"^\$?[A-Za-z]{1,3}\$?([0-9]+)(?::.*)?\z"
    start = F.when(named | F.contains(cells, F.lit(":")), F.regexp_extract(cells, pair, 1))
    stop = F.regexp_extract(cells, r":\$?[A-Za-z]{1,3}\$?([0-9]+)\z", 1)
    offset = F.coalesce(F.nullif(start, F.lit("")).cast("long") - 1, F.lit(0))
    declared = F.coalesce(F.nullif(stop, F.lit("")).cast("long") - 1, F.lit(-1))
    reached = F.greatest(declared, offset + F.size("values") - 1)
    whole = F.col("_damaged").isNull()
    damaged = F.array(F.lit(None).cast("array<string>"))
    rows = documents.select(
        F.regexp_replace(folder, "^feed=", "").alias("feed"),
        F.when(whole, offset).otherwise(DAMAGED_ROW).alias("offset"),
        F.when(whole, reached).alias("doc_last"),
        F.posexplode(F.when(whole, F.col("values")).otherwise(damaged)).alias("pos", "cells"),
    )
    return rows.select(
        "feed",
        (F.col("offset") + F.col("pos")).alias(ROW_ID),
        "cells",
        F.col("offset").alias("doc_first"),
        "doc_last",
    )
