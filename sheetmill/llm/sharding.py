"""Contiguous shards of near-equal byte size.

Method: rows are laid out in one global order, cut into buckets of bounded size. Totals per
bucket give global prefix sums of bytes and rows, and the order is cut at equal byte targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sheetmill.llm.common import text_or_empty, unit_hash, written


def byte_shards(
    docs: DataFrame,
    n_shards: int = 8,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = 4096,
    whole_share: float = 0.02,
) -> DataFrame:
    """Put every row into one of ``n_shards`` contiguous shards of near-equal size.

    A row's size is the bytes of its text plus one. The order is that of groups of equal texts:
    first the big groups by falling size, then the others by hash. Groups of up to
    ``whole_share`` of a shard go to one shard as a whole; bigger ones are cut only where a
    target falls into them, so one group may hold any part of the data.

    Returns doc_id, size, text_crc32, law, shard, slot (from 0 without gaps), grown_shard (null).

    Null texts have size 1 like empty ones, with which they form a group. Repeated rows get slots of
    their own. An empty table gives no rows; further columns of ``docs`` are not read.

    Big groups are at most ``2 * n_shards / whole_share``, the only rows that are broadcast.
    They are dealt to buckets by a hash of the id, so no bucket depends on one text or source.
    """
    body = text_or_empty(F.col(text_col))
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(body).alias("h"),
        ),
        "sizes",
    )
    key = ["h", "text_crc32", "size"]
    groups = rows.groupBy(*key).agg(F.count("*").alias("n"))
    total = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    all_bytes, all_rows = total["bytes"] or 0, total["rows"]
    share = whole_share / n_shards
    n = F.col("n")
    big = groups.where((n * F.col("size") > share * all_bytes) | (n > share * all_rows))
    largest = Window.orderBy(F.desc(n * F.col("size")), F.desc("n"), *key)
    parts = F.ceil(n / bucket_rows)
    big = big.select(
        *key, parts.alias("parts"), (F.sum(parts).over(largest) - parts).cast("long").alias("base")
    )
    big = written(big, "big_groups")
    first_small = big.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    small_buckets = -(-all_rows // bucket_rows) or 1

    deal = F.when(
        F.col("parts").isNotNull(), F.col("base") + F.floor(unit_hash(F.col("doc_id")) * F.col("parts"))
    ).otherwise(first_small + F.floor(unit_hash(F.col("h")) * small_buckets))
    dealt = rows.join(F.broadcast(big), key, "left").select(
        "doc_id",
        *key,
        F.col("parts").isNull().alias("whole"),
        deal.cast("long").alias("bucket"),
    )
    order = Window.partitionBy("bucket").orderBy(*key, "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    first = Window.partitionBy("bucket", *key).orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        dealt.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
        .withColumn("ahead", F.count(F.lit(1)).over(order))
        .withColumn("start", F.when(F.col("whole"), F.first("before").over(first)).otherwise(F.col("before")))
    )
    placed = written(placed, "placed")
    # One row per bucket: about rows / bucket_rows of them.
    totals = placed.groupBy("bucket").agg(F.sum("size").alias("b"), F.count("*").alias("r"))
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("b").over(upto), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("r").over(upto), F.lit(0)).alias("rows_before"),
    )
    target = F.lit(max(all_bytes, 1) / n_shards)
    shard = F.floor((F.col("bytes_before") + F.col("start")) / target)
    numbered = placed.join(offsets, "bucket").select(
        "doc_id",
        "size",
        "text_crc32",
        F.least(shard, F.lit(n_shards - 1)).cast("int").alias("shard"),
        (F.col("rows_before") + F.col("ahead")).alias("place"),
    )
    starts = numbered.groupBy("shard").agg(F.min("place").alias("first"))
    return numbered.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
