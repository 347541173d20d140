"""From sheet rows to a wide all-text table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetmill.functions.text import blank_to_null, clean_cell, sanitize_header
from sheetmill.model import REJECT_SCHEMA, ROW_ID, FeedError, RunContext, SchemaInfo
from sheetmill.operators.ranking import BLOCK_POSITIONS, rank_rows
from sheetmill.operators.validate import audit_columns
from sheetmill.rules import SURPLUS_CELLS


def dedup_headers(
    headers: DataFrame, feed: str = "feed", pos: str = "pos", block: int | None = BLOCK_POSITIONS
) -> DataFrame:
    """Add ``name``: the 2nd, 3rd... repeat of a ``clean`` name gets ``_1``, ``_2``..."""
    numbered = rank_rows(headers, [feed, "clean"], pos, out="_nth", block=block)
    name = F.when(F.col("_nth") == 1, F.col("clean")).otherwise(
        F.concat_ws("_", "clean", (F.col("_nth") - 1).cast("string"))
    )
    return numbered.withColumn("name", name).drop("_nth")


def header_rows(rows: DataFrame) -> DataFrame:
    """``(feed, _header)``: the first exported row of every feed, which holds its header."""
    return rows.filter(F.col(ROW_ID) >= 0).groupBy("feed").agg(F.min(ROW_ID).alias("_header"))


def with_header(rows: DataFrame) -> DataFrame:
    """Add ``_header`` to the rows of every feed that has one.

    The side of one row per feed is broadcast at every size: a shuffle by feed would put the whole of a feed in one task.
    """
    return rows.join(F.broadcast(header_rows(rows)), "feed")


def feed_headers(rows: DataFrame) -> DataFrame:
    """``(feed, pos, header, clean, name)`` for the header row of every feed."""
    first = with_header(rows).filter(F.col(ROW_ID) == F.col("_header"))
    cells = first.select("feed", F.posexplode("cells").alias("pos", "header"))
    # A feed's header has as many cells as the sheet has columns, so its groups are small.
    return dedup_headers(cells.withColumn("clean", sanitize_header(F.col("header"))), block=None)


def collect_headers(rows: DataFrame) -> dict[str, list[str]]:
    """Column names of every feed, in sheet order (one driver value per sheet column)."""
    found: dict[str, list[tuple[int, str]]] = {}
    for r in feed_headers(rows).select("feed", "pos", "name").collect():
        found.setdefault(r.feed, []).append((r.pos, r.name))
    return {feed: [name for _, name in sorted(names)] for feed, names in found.items()}


def require_data(expected: Iterable[str], headers: Mapping[str, Sequence[str]]) -> None:
    """Stop when a feed delivered no values at all."""
    empty = sorted(feed for feed in expected if not headers.get(feed))
    if empty:
        raise FeedError(f"No data found for: {empty}")


@dataclass(frozen=True)
class FeedShape:
    """What a feed's rows look like: rows per width (None if damaged), the header's position, and
    documents that cover rows of others or leave rows out before them."""

    widths: Mapping[int | None, int]
    header: int = 0
    overlaps: int = 0
    gaps: int = 0

    def require_whole(self) -> None:
        """Stop when a document is damaged, or the exported ranges overlap or leave rows out."""
        if None in self.widths:
            raise FeedError("a document cannot be parsed")
        if self.overlaps:
            raise FeedError("documents cover the same rows")
        if self.gaps:
            raise FeedError("rows are missing between documents")


def feed_shapes(rows: DataFrame) -> dict[str, FeedShape]:
    """Shape of every feed: a few driver values per feed.

    Documents are compared as intervals of rows. ``rows`` without the columns ``doc_first`` and
    ``doc_last`` are taken as documents of one row.
    """
    if "doc_first" not in rows.columns:
        rows = rows.withColumn("doc_first", F.col(ROW_ID)).withColumn("doc_last", F.col(ROW_ID))
    cells = F.coalesce("cells", F.array().cast("array<string>"))
    counts = rows.groupBy("feed", F.when(F.col(ROW_ID) >= 0, F.size(cells)).alias("width")).agg(
        F.count("*").alias("n")
    )
    widths: dict[str, dict[int | None, int]] = {}
    for r in counts.collect():
        widths.setdefault(r.feed, {})[r.width] = r.n
    documents = (
        rows.filter(F.col(ROW_ID) >= 0)
        .groupBy("feed", "doc_first", "doc_last")
        .agg(F.count("*").alias("n"), F.min(ROW_ID).alias("first"))
    )
    before = Window.partitionBy("feed").orderBy("doc_first", "doc_last").rowsBetween(
        Window.unboundedPreceding, -1
    )
    reached = documents.withColumn("reached", F.max("doc_last").over(before))
    # More rows than the range has: several documents of the same range.
    twice = F.col("n") > F.col("doc_last") - F.col("doc_first") + 1
    found = reached.groupBy("feed").agg(
        F.min("first").alias("header"),
        F.count_if((F.col("doc_first") <= F.col("reached")) | twice).alias("overlaps"),
        F.count_if(F.col("doc_first") > F.col("reached") + 1).alias("gaps"),
    )
    whole = {r.feed: r for r in found.collect()}
    return {
        feed: FeedShape(own, *(whole[feed][k] for k in ("header", "overlaps", "gaps")))
        if feed in whole
        else FeedShape(own)
        for feed, own in widths.items()
    }


def _surplus(width: int) -> Column:
    """True where a row holds text beyond its feed's columns."""
    rest = F.slice("cells", width + 1, F.greatest(F.size("cells") - width, F.lit(0)))
    return F.coalesce(F.exists(rest, lambda c: blank_to_null(clean_cell(c)).isNotNull()), F.lit(False))


def assemble(rows: DataFrame, names: Sequence[str], header: int = 0, *keep: Column) -> DataFrame:
    """Wide all-text table of one feed, or of feeds with the same columns: cells cleaned, missing or blank cells
    NULL, then the columns in ``keep``.

    Rows with text beyond the header's cells do not fit; ``surplus_rejects`` has them.
    """
    SchemaInfo(tuple(names))
    cells = [
        blank_to_null(clean_cell(F.get("cells", F.lit(i)))).alias(name)
        for i, name in enumerate(names)
    ]
    return rows.filter((F.col(ROW_ID) > header) & ~_surplus(len(names))).select(ROW_ID, *cells, *keep)


def surplus_rejects(
    rows: DataFrame,
    names: Sequence[str],
    ctx: RunContext,
    delimiter: str = "|",
    header: int = 0,
    *keep: Column,
) -> DataFrame:
    """Rows with more text than columns, all their cells kept, in the layout of the reject table; then the columns in
    ``keep``."""
    cells = F.transform("cells", lambda c: F.coalesce(clean_cell(c), F.lit("")))
    detail = F.concat(F.lit(f"columns: {len(names)}{delimiter}cells: "), F.size("cells"))
    found = rows.filter((F.col(ROW_ID) > header) & _surplus(len(names))).select(
        F.concat_ws(delimiter, cells).alias("row"),
        F.lit(SURPLUS_CELLS).alias("rej_reason"),
        detail.alias("rej_detail"),
        *audit_columns(ctx),
        *keep,
    )
    return found if keep else found.select(*REJECT_SCHEMA.names)
