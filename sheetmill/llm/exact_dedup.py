"""Exact duplicates of texts, batch against immutable snapshot.

Method: a static binary-fuse filter per bucket of a snapshot's digests screens the digests of an
incoming batch. What the filter lets through joins the snapshot's exact bucket, where texts are
compared byte by byte. Duplicates within the batch are grouped separately.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetmill.llm.common import SPACE, text_or_empty, written

_SEED = np.uint64(0x9E3779B97F4A7C15)
_FILTER = "bucket long, seed long, segment long, segments long, prints binary"
_KEY = ["bucket", "digest", "sha", "octets"]


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), SPACE + "+", "")


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys + _SEED * np.array([seed], np.uint64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _cells(hashes: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three cells per key, in three neighbouring segments."""
    low, mask = np.uint64(32), np.uint64(segment - 1)
    first = ((hashes >> low) * np.uint64(segment * segments)) >> low
    second = (first + np.uint64(segment)) ^ ((hashes >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (hashes & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """A 3-wise binary-fuse filter of distinct 64-bit ``keys`` (Graf and Lemire, 2022).

    Returns (seed, segment length, segments, 16-bit fingerprints). Every key is found; another
    one passes with a probability of 2**-16. Keys are peeled in rounds of all cells that hold
    one key only, so the work is vectorised.
    """
    keys = np.unique(np.asarray(keys).astype(np.int64).view(np.uint64))
    n = max(len(keys), 2)
    segment = 1 << max(2, int(math.log(n) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    segments = max(1, -(-int(n * factor) // segment) - 2)
    for seed in range(1, 1000):
        if seed % 10 == 0:
            segments += 1
        hashes = _mixed(keys, seed)
        cells = _cells(hashes, segment, segments)
        size = segment * (segments + 2)
        count = np.bincount(cells.ravel(), minlength=size)
        owners = np.bincount(cells.ravel(), np.tile(np.arange(len(keys), dtype=float), 3), size)
        owners = owners.astype(np.int64)
        rounds, left = [], len(keys)
        lone = np.flatnonzero(count == 1)
        while len(lone):
            peeled, at = np.unique(owners[lone], return_index=True)
            rounds.append((peeled, lone[at]))
            left -= len(peeled)
            gone = cells[:, peeled]
            np.subtract.at(count, gone.ravel(), 1)
            np.subtract.at(owners, gone.ravel(), np.tile(peeled, 3))
            touched = np.unique(gone)
            lone = touched[count[touched] == 1]
        if left == 0:
            prints = np.zeros(size, np.uint16)
            want = _prints(hashes)
            for peeled, at in reversed(rounds):
                three = prints[cells[:, peeled]]
                # The own cell is still empty, so it does not change the combination.
                prints[at] = want[peeled] ^ three[0] ^ three[1] ^ three[2]
            return seed, segment, segments, prints
    raise RuntimeError("no seed peels this bucket")


def maybe_contains(built: tuple[int, int, int, np.ndarray], keys: np.ndarray) -> np.ndarray:
    seed, segment, segments, prints = built
    hashes = _mixed(np.asarray(keys).astype(np.int64).view(np.uint64), seed)
    three = prints[_cells(hashes, segment, segments)]
    return three[0] ^ three[1] ^ three[2] == _prints(hashes)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    seed, segment, segments, prints = build_filter(group["digest"].to_numpy())
    return pd.DataFrame(
        [(int(group["bucket"].iloc[0]), seed, segment, segments, prints.tobytes())],
        columns=["bucket", "seed", "segment", "segments", "prints"],
    )


def _screen(incoming: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if filters.empty:
        return incoming.iloc[:0]
    f = filters.iloc[0]
    built = (int(f["seed"]), int(f["segment"]), int(f["segments"]), np.frombuffer(f["prints"], np.uint16))
    return incoming[maybe_contains(built, incoming["digest"].to_numpy())]


def filters_of(groups: DataFrame) -> DataFrame:
    """One filter row per bucket of a snapshot's groups; immutable like the snapshot."""
    return groups.select("bucket", "digest").groupBy("bucket").applyInPandas(_build, _FILTER)


def screened(groups: DataFrame, filters: DataFrame) -> DataFrame:
    """The incoming groups that the snapshot's filters let through."""
    keys = groups.select(*_KEY)
    return keys.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(_screen, keys.schema)


def exact_dedup(
    docs: DataFrame,
    *,
    snapshot: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = 500_000,
    least_buckets: int = 64,
) -> DataFrame:
    """Find texts that are identical without their white space.

    ``snapshot`` marks the rows of the immutable snapshot, the others are the incoming batch;
    by default the parity of the id's checksum decides, so either side may hold any text.
    Of equal texts the row with the most code points, then the smallest id, stays.

    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and empty texts are equal to each other. A null id stays only
    where its group has no other. Of rows that repeat id and text, exactly one is kept. An empty
    table gives no rows; further columns of ``docs`` are not read.

    Groups are aggregated before they are shuffled, so a hot group is one row per task. Texts
    move once, to compare the representatives of groups that occur on both sides.
    """
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text_or_empty(F.col(text_col)).alias("text"),
        F.coalesce(
            snapshot if snapshot is not None else F.crc32(F.col(id_col).cast("string")) % 2 == 0,
            F.lit(False),
        ).alias("old"),
    ).withColumn("norm", normalised(F.col("text")))
    buckets = max(least_buckets, -(-docs.count() // bucket_rows))
    digest = F.xxhash64("norm")
    rows = written(
        base.select(
            "doc_id",
            "old",
            F.length("text").alias("n_chars"),
            F.unhex(F.sha2("norm", 256)).alias("sha"),
            F.octet_length("norm").alias("octets"),
            digest.alias("digest"),
            F.pmod(digest, F.lit(buckets)).cast("long").alias("bucket"),
        ),
        "digests",
    )
    best = F.struct("n_chars", (-F.col("doc_id")).alias("minus_id"))
    groups = written(
        rows.groupBy("old", *_KEY).agg(F.count("*").alias("n"), F.max(best).alias("best")), "groups"
    )
    old, new = groups.where("old"), groups.where("not old")
    positive = screened(new, filters_of(old))

    # Byte checks: the representatives of a digest on either side, text against text.
    both = positive.join(old.select(*_KEY), _KEY)
    wanted = (
        groups.select(*_KEY, (-F.col("best.minus_id")).alias("doc_id"))
        .join(both, _KEY, "left_semi")
        .select("doc_id", "digest", "sha", "octets")
    )
    texts = base.select(F.col("doc_id").alias("id"), "norm")
    same = (
        wanted.join(texts, wanted.doc_id.eqNullSafe(texts.id) & (F.xxhash64(texts.norm) == wanted.digest))
        .groupBy("digest", "sha", "octets")
        .agg((F.min("norm") == F.max("norm")).alias("same"))
        .where("same")
        .select("sha", "octets", F.lit(True).alias("same"))
    )

    apart = (
        groups.select("old", "sha", "octets", "n", "best")
        .join(same, ["sha", "octets"], "left")
        .withColumn("side", F.when(F.col("old") | F.col("same"), 0).otherwise(1))
    )
    apart = written(apart.drop("same"), "sides")
    merged = apart.groupBy("sha", "octets", "side").agg(
        F.sum("n").alias("group_size"), F.max("best").alias("best")
    )
    found = apart.select("old", "sha", "octets", "side").join(merged, ["sha", "octets", "side"])
    joined = rows.select("doc_id", "old", "n_chars", "sha", "octets").join(found, ["old", "sha", "octets"])
    # Rows that repeat id and text: the longest one stands for them.
    copy = F.row_number().over(
        Window.partitionBy("sha", "octets", "side", "doc_id").orderBy(F.desc("n_chars"))
    )
    keep_id = -F.col("best.minus_id")
    return joined.withColumn("copy", copy).select(
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(keep_id) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def write_snapshot(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = 500_000,
    least_buckets: int = 64,
) -> None:
    """Store ``docs`` as an immutable snapshot below ``path``: its filters, and one text of each group.

    ``path/filters`` has one binary-fuse filter per bucket of digests; ``path/texts`` one row per group of texts that are
    identical without their white space: digest, bucket, sha, octets, keep_id (the smallest of the longest), n, norm.
    Null texts count as empty; a null id stands for its group only where there is no other; an empty table gives a snapshot
    that knows nothing. Groups are aggregated before they are shuffled.
    """
    buckets = max(least_buckets, -(-docs.count() // bucket_rows))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text")
    ).withColumn("norm", normalised(F.col("text")))
    digest = F.xxhash64("norm")
    best = F.struct(F.length("text").alias("n_chars"), (-F.col("doc_id")).alias("minus_id"))
    groups = (
        rows.select(
            best.alias("best"),
            F.unhex(F.sha2("norm", 256)).alias("sha"),
            F.octet_length("norm").alias("octets"),
            digest.alias("digest"),
            F.pmod(digest, F.lit(buckets)).cast("long").alias("bucket"),
            "norm",
        )
        .groupBy(*_KEY)
        .agg(F.count("*").alias("n"), F.max("best").alias("best"), F.first("norm").alias("norm"))
        .select(*_KEY, (-F.col("best.minus_id")).alias("keep_id"), "n", "norm")
    )
    groups.write.option("compression", "zstd").parquet(f"{path}/texts")
    stored = docs.sparkSession.read.schema(groups.schema).parquet(f"{path}/texts")
    filters_of(stored).withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/filters")


def dedup_batch(
    batch: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Decide a later batch against a stored snapshot.

    The snapshot's filters screen the batch's digests; what they let through is compared with the snapshot's texts
    byte by byte, and the others are grouped among themselves. Returns one row per input row: doc_id, in_snapshot,
    keep_id (of the snapshot's row, or of the batch's longest with the smallest id), kept. Of rows that the snapshot
    knows none is kept; of rows that repeat id and text, one is. Null texts count as empty; an empty batch gives no rows;
    further columns are not read. The snapshot's texts are read for digests that passed only.
    """
    spark = batch.sparkSession
    filters = spark.read.schema(f"{_FILTER}, buckets long").parquet(f"{path}/filters")
    first = filters.select("buckets").first()
    buckets = first[0] if first else 1
    rows = batch.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text")
    ).withColumn("norm", normalised(F.col("text")))
    digest = F.xxhash64("norm")
    rows = written(
        rows.select(
            "doc_id",
            F.length("text").alias("n_chars"),
            F.unhex(F.sha2("norm", 256)).alias("sha"),
            F.octet_length("norm").alias("octets"),
            digest.alias("digest"),
            F.pmod(digest, F.lit(buckets)).cast("long").alias("bucket"),
            "norm",
        ),
        "batch",
    )
    best = F.struct("n_chars", (-F.col("doc_id")).alias("minus_id"))
    groups = written(
        rows.groupBy(*_KEY).agg(F.max(best).alias("best"), F.first("norm").alias("norm")), "batch_groups"
    )
    passed = screened(groups, filters.drop("buckets"))
    texts = spark.read.parquet(f"{path}/texts").select(
        *_KEY, F.col("keep_id").alias("known_id"), F.col("norm").alias("known")
    )
    same = (
        groups.join(passed, _KEY)
        .join(texts, _KEY)
        .where("norm = known")
        .select("sha", "octets", "known_id", F.lit(True).alias("in_snapshot"))
    )
    own = groups.select("sha", "octets", (-F.col("best.minus_id")).alias("own_id"))
    found = own.join(same, ["sha", "octets"], "left")
    joined = rows.select("doc_id", "n_chars", "sha", "octets").join(found, ["sha", "octets"])
    copy = F.row_number().over(Window.partitionBy("sha", "octets", "doc_id").orderBy(F.desc("n_chars")))
    known = F.coalesce("in_snapshot", F.lit(False))
    return joined.withColumn("copy", copy).select(
        "doc_id",
        known.alias("in_snapshot"),
        F.when(known, F.col("known_id")).otherwise(F.col("own_id")).alias("keep_id"),
        (~known & F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("copy") == 1)).alias("kept"),
    )
