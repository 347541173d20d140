"""Mix sources to target weights.

Method: words are summed by source and hash bucket. A source's budget is a threshold on the
hash; only the bucket in which the threshold falls is refined by the next bits. Rows are then
kept by comparing their hash with the threshold, without sorting. A larger budget keeps
whatever a smaller one keeps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetmill.llm.common import WORD, text_or_empty, written

_BITS, _LEVELS = 12, 3


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets per source from (source, source_size).

    Sources by code point, null last, get ``weights`` in turn. They share ``share`` times all
    sizes by weight; no target exceeds ``most`` times its source, and what that leaves over is
    shared again. In order of size per weight the full sources come first, so one running sum
    finds them. One row per source is handled, not the rows behind it.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (turn % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = most * F.col("source_size")
    everything = Window.partitionBy()
    table = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        # The level if this source and all after it were below their caps.
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("budget") - F.col("full")) / F.sum("weight").over(rest))
    )
    # Levels rise up to the first source that is not full, whose level holds, and fall after it.
    table = table.withColumn(
        "water", F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(everything)
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("water"), F.col("cap")))
    return table.select("source", "source_size", target.alias("target"))


def _digit(level: int) -> Column:
    shift = 64 - _BITS * (level + 1)
    return F.shiftrightunsigned(F.col("h"), shift).bitwiseAND((1 << _BITS) - 1)


def _hash(id_col: str, text_col: str, seed: int) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), text_or_empty(F.col(text_col)), F.lit(seed))


def source_cuts(
    docs: DataFrame,
    weights: Sequence[float],
    share: float,
    most: float,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, source, size, h), and per source (source, source_size, target, times, prefix).

    A row is taken ``times`` times, and once more if the leading bits of ``h`` are below ``prefix``.
    """
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text_or_empty(F.col(text_col)), F.lit(WORD)).cast("long").alias("size"),
            _hash(id_col, text_col, seed).alias("h"),
        ),
        "sizes",
    )
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    cuts = source_targets(sums, weights, share, most).withColumn("times", times.cast("long"))
    cuts = written(
        cuts.withColumn("left", F.col("target") - F.col("times") * F.col("source_size")).withColumn(
            "prefix", F.lit(0).cast("long")
        ),
        "targets",
    )
    # Nested thresholds: `prefix` holds the digits fixed so far, `left` the words still to take
    # from below the boundary bucket.
    for level in range(_LEVELS):
        known = F.shiftrightunsigned(F.col("h"), 64 - _BITS * level) if level else F.lit(0).cast("long")
        inside = rows.join(
            cuts.select(F.col("source").alias("s"), F.col("prefix").alias("p")),
            F.col("source").eqNullSafe(F.col("s")) & (known == F.col("p")),
        )
        counts = inside.groupBy("source", _digit(level).alias("digit")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("source").orderBy("digit")
        counts = counts.withColumn("upto", F.sum("words").over(run)).alias("c")
        t = cuts.alias("t")
        # The bucket in which the running sum crosses the budget is refined, whatever is empty before
        # it. The last level rounds to the nearer end of that bucket.
        last = level == _LEVELS - 1
        half = F.col("c.words") / 2 if last else F.lit(0)
        fits = F.col("c.upto") - half <= F.col("t.left")
        after = F.max(F.when(fits, F.col("c.digit"))) + 1
        crossed = F.min(F.when(~fits, F.col("c.digit")))
        below = (
            t.join(counts, F.col("t.source").eqNullSafe(F.col("c.source")), "left")
            .groupBy("t.source", "t.source_size", "t.target", "t.times", "t.left", "t.prefix")
            .agg(
                (F.coalesce(after, F.lit(0)) if last else F.coalesce(crossed, after, F.lit(0))).alias("digit"),
                F.coalesce(F.max(F.when(fits, F.col("c.upto"))), F.lit(0)).alias("words"),
            )
        )
        cuts = written(
            below.select(
                "source",
                "source_size",
                "target",
                "times",
                (F.col("left") - F.col("words")).alias("left"),
                (F.col("prefix") * (1 << _BITS) + F.col("digit")).alias("prefix"),
            ),
            "thresholds",
        )
    return rows, cuts.drop("left")


def _copies(h: Column) -> Column:
    extra = F.shiftrightunsigned(h, 64 - _BITS * _LEVELS) < F.col("prefix")
    return F.col("times") + extra.cast("long")


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, **options
) -> DataFrame:
    """Decide how often each document enters the mix.

    A document's size is its number of words. Every document is taken ``floor(target / source
    size)`` times, and once more if its hash is below the source's threshold.

    Returns doc_id, source, size, source_size, target, copies, taken.

    Null and empty texts have size 0 and follow their source's threshold. Null sources form one
    source. The hash is that of id and text, so reruns agree and repeated rows share a decision.
    An empty table gives no rows; further columns of ``docs`` are not read.

    Sums are made before each shuffle, so a hot source is one row per task and bucket. The
    histogram holds at most 4096 buckets per source and level, whatever the number of rows.
    """
    rows, cuts = source_cuts(docs, weights, share, most, **options)
    picked = rows.alias("r").join(cuts.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
    copies = _copies(F.col("h"))
    return picked.select(
        "doc_id",
        "r.source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed_rows(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 0,
) -> DataFrame:
    """The rows of ``docs`` as often as ``mix_sources`` takes them, with all their columns."""
    names = {"id_col": id_col, "text_col": text_col, "source_col": source_col, "seed": seed}
    _, cuts = source_cuts(docs, weights, share, most, **names)
    every = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    keyed = docs.select(every, F.col(source_col).cast("string").alias("own"), _hash(id_col, text_col, seed).alias("h"))
    picked = keyed.join(cuts.select("source", "times", "prefix"), F.col("own").eqNullSafe(F.col("source")))
    copies = _copies(F.col("h"))
    return (
        picked.select("row", copies.alias("copies"))
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("row.*")
    )
