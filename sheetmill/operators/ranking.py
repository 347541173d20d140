"""Row numbers within a key that may hold a large part of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetmill.functions.text import quoted

#: Positions per block. As positions of a feed do not repeat, no block holds more rows.
BLOCK_POSITIONS = 1 << 22


def rank_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str = "rownum",
    block: int | None = BLOCK_POSITIONS,
    then: Sequence[Column] = (),
) -> DataFrame:
    """Number the rows of each key by the integer column ``order``, starting at 1.

    NULL keys form one group; a NULL position is an error. A window alone would sort a whole key
    in one task. Here every key is cut into ranges of ``block`` positions: rows are numbered
    within their range, and the counts of the key's ranges before it are added. Outlying positions
    only make ranges empty. ``then`` settles equal positions. ``block=None`` ranks by one window,
    for groups known to be small.
    """
    position = F.coalesce(
        quoted(order).cast("long"), F.raise_error(F.lit(f"{order} is NULL")).cast("long")
    )
    own = [quoted(k) for k in keys]
    if block is None:
        window = Window.partitionBy(*own).orderBy(position, *then)
        return df.withColumn(out, F.row_number().over(window).cast("long"))
    blocked = df.withColumn("_position", position).withColumn(
        "_block", F.floor(F.col("_position") / block)
    )
    grouping = [*own, F.col("_block")]
    local = Window.partitionBy(*grouping).orderBy("_position", *then)
    ranked = blocked.withColumn("_local", F.row_number().over(local))
    # Rows are combined before the shuffle: one per key, range and task.
    counts = blocked.groupBy(*grouping).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*own).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.withColumn("_before", F.sum("_n").over(earlier))
        .where("_before > 0")
        .select(
            *[k.alias(f"_off_{i}") for i, k in enumerate(own)],
            F.col("_block").alias("_off_block"),
            "_before",
        )
    )
    same = F.col("_block") == F.col("_off_block")
    for i, k in enumerate(own):
        same = same & k.eqNullSafe(F.col(f"_off_{i}"))
    return ranked.join(offsets, same, "left").select(
        *[quoted(c) for c in df.columns],
        (F.col("_local") + F.coalesce("_before", F.lit(0))).alias(out),
    )
