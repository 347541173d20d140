"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetmill.session import scratch_path

#: The white space that separates words, as bytes 0x20 and 0x09 to 0x0D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
WORD_GAP = r"[\x20\x09-\x0D]+"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def written(df: DataFrame, name: str, *, by: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Let Python tasks get at most so many texts at a time: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def unit_hash(*columns: Column) -> Column:
    """A repeatable number in [0, 1) from a 64-bit hash of ``columns``."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b: long).

    Returns one row (id, component) per node that is not the smallest of its component; the
    component is its smallest node. Nulls and loops are left out. Large-star and small-star
    steps (Kiveris et al., 2014) alternate until the edges are stars. Every round is a written
    table, aggregates before it shuffles, and joins by keys that the run-time skew split covers.
    """
    a, b = F.col("a"), F.col("b")
    stars = written(
        edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "edges",
    )
    state = None
    while True:
        both = stars.unionByName(stars.select(b.alias("a"), a.alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.where(b > a)
            .join(lowest, "a")
            .select(b.alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where(b > F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        stars = written(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "stars")
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state or not now[0]:
            return stars.select(a.alias("id"), b.alias("component"))
        state = now
