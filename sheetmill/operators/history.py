"""How the columns of feeds change from run to run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

#: A column of a feed in one run; ``grp`` is its type group, NULL for text.
HISTORY = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("job_date", T.DateType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("load_datetime", T.TimestampNTZType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("col", T.StringType()),
        T.StructField("grp", T.StringType()),
    ]
)


def schema_changes(history: DataFrame) -> DataFrame:
    """What changed in each feed from one of its runs to the next: one row per change.

    Runs of a feed follow each other by date, load time and id. Columns are matched by name: ``new`` and ``lost``
    ones have no match, ``retyped`` ones another type group, ``moved`` ones another position. A lost and a new
    column of the same position and group are one ``renamed`` column. Returns feed, job_date, job_id, change, col,
    old_col, pos, old_pos, grp, old_grp; of the first run of a feed nothing is reported. Feeds have as many
    columns as their sheets, so all joins and windows are by feed and run.
    """
    runs = history.select("feed", "job_date", "job_id", "load_datetime").distinct()
    in_order = Window.partitionBy("feed").orderBy("job_date", "load_datetime", "job_id")
    numbered = runs.withColumn("_run", F.row_number().over(in_order))
    columns = history.join(numbered, ["feed", "job_date", "job_id", "load_datetime"])
    now = columns.select("feed", "_run", "col", "pos", "grp")
    old = columns.select(
        "feed",
        (F.col("_run") + 1).alias("_run"),
        "col",
        F.col("pos").alias("old_pos"),
        F.col("grp").alias("old_grp"),
    )
    # Runs that have a run before them.
    later = numbered.where("_run > 1").select("feed", "_run", "job_date", "job_id")
    matched = now.join(old, ["feed", "_run", "col"], "full").join(later, ["feed", "_run"])
    matched = matched.select(
        "*", F.col("pos").isNull().alias("_lost"), F.col("old_pos").isNull().alias("_new")
    )
    kept = matched.where("not _lost and not _new")
    same = ["feed", "_run", "job_date", "job_id"]
    lost = matched.where("_lost").select(*same, F.col("col").alias("old_col"), "old_pos", "old_grp")
    new = matched.where("_new").select(*same, "col", "pos", "grp")
    paired = new.join(
        lost.withColumnRenamed("old_pos", "pos").withColumnRenamed("old_grp", "_grp"), [*same, "pos"], "full"
    )
    layout = [*same[:1], *same[2:], "change", "col", "old_col", "pos", "old_pos", "grp", "old_grp"]
    renamed = F.col("col").isNotNull() & F.col("old_col").isNotNull() & F.col("grp").eqNullSafe(F.col("_grp"))

    def change(kind: str, rows: DataFrame, **values) -> DataFrame:
        return rows.withColumns({"change": F.lit(kind), **values}).select(*layout)

    none = F.lit(None)
    text, number = none.cast("string"), none.cast("int")
    own = {"old_col": F.col("col")}
    differs = ~F.col("grp").eqNullSafe(F.col("old_grp"))
    changes = [
        change("retyped", kept.where(differs), **own),
        change("moved", kept.where(F.col("pos") != F.col("old_pos")), **own),
        change("renamed", paired.where(renamed), old_pos=F.col("pos"), old_grp=F.col("_grp")),
        change(
            "new", paired.where(F.col("col").isNotNull() & ~renamed), old_col=text, old_pos=number, old_grp=text
        ),
        change(
            "lost",
            paired.where(F.col("old_col").isNotNull() & ~renamed),
            col=text,
            old_pos=F.col("pos"),
            pos=number,
            grp=text,
            old_grp=F.col("_grp"),
        ),
    ]
    found = changes[0]
    for more in changes[1:]:
        found = found.unionByName(more)
    return found
