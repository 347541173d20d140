"""Inference of each column's type group from the cells themselves."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, functions as F

from sheetmill.functions.formats import LABELS, label_cell
from sheetmill.functions.text import clean_cell, quoted, strip
from sheetmill.model import ROW_ID, SchemaInfo
from sheetmill.operators.ingest import with_header
from sheetmill.rules import RuleSet

#: Share of rows and row limit of the sampled profile.
SAMPLE_FRACTION = 0.5
SAMPLE_LIMIT = 1000

#: Files that a sample of a stored table reads at most.
SAMPLE_FILES = 16


def profile_sample(
    tmp: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    limit: int = SAMPLE_LIMIT,
    seed: int | None = None,
    order: str = ROW_ID,
) -> DataFrame:
    """A sample of about ``fraction`` of the table, and at most ``limit`` rows.

    Rows are taken in the order of a hash of seed and position, so they come from all over the
    table, and the same ones every time.
    """
    digest = F.md5(F.concat(F.lit(f"{seed or 0}:"), quoted(order).cast("string")))
    below = F.lit(f"{min(int(fraction * 16**8), 16**8 - 1):08x}") if fraction < 1 else F.lit("g")
    return (
        tmp.withColumn("_digest", digest)
        .where(F.substring("_digest", 1, 8) < below)
        .orderBy("_digest", quoted(order))
        .limit(limit)
        .drop("_digest")
    )


def block_sample(
    table: DataFrame,
    files: int = SAMPLE_FILES,
    fraction: float = SAMPLE_FRACTION,
    limit: int = SAMPLE_LIMIT,
    seed: int | None = None,
    order: str = ROW_ID,
) -> DataFrame:
    """``profile_sample`` of ``files`` files of a stored table, chosen by a hash of their place.

    The other files are not opened, so what is read does not grow with the table. ``table`` must be read
    straight from files. Rows of one file may be alike: the fewer files, the less a sample says of the rest.
    """
    places = sorted(table.inputFiles(), key=lambda f: md5(f"{seed or 0}:{f}".encode()).digest())
    if len(places) > files:
        # Local places are written with one slash or three.
        named = [p.replace("file:///", "file:/", 1) for p in places[:files]]
        table = table.where(F.col("_metadata.file_path").isin(named))
    return profile_sample(table, fraction, limit, seed, order)


def cells_of(tmp: DataFrame, columns: Sequence[str], order: str = ROW_ID) -> DataFrame:
    """One row per cell: ``(order, pos, value)``."""
    return tmp.select(
        quoted(order).alias(order),
        F.posexplode(F.array(*map(quoted, columns))).alias("pos", "value"),
    )


def labelled(cells: DataFrame, rules: RuleSet) -> DataFrame:
    """Add ``label`` to ``value`` cells."""
    # A column of its own, so that a cell is stripped once and not for every pattern.
    stripped = cells.withColumn("stripped", strip(F.col("value")))
    return stripped.withColumn("label", label_cell(F.col("value"), rules, F.col("stripped")))


def partial_votes(cells: DataFrame, keys: Sequence[str], order: str = ROW_ID) -> DataFrame:
    """Ballots of labelled cells per group: how many cells have each label, and the first that does.

    Every label is a fixed-width buffer of one aggregation, so cells are combined before the only shuffle, which moves a
    row per group and task. Ballots of parts of a table, kept beside them, can be merged later.
    """
    aggregates = []
    for label in LABELS:
        is_label = F.col("label") == label
        aggregates.append(F.count_if(is_label).alias(f"n_{label.lower()}"))
        aggregates.append(F.min(F.when(is_label, quoted(order))).alias(f"first_{label.lower()}"))
    return cells.groupBy(*keys).agg(*aggregates)


def merge_votes(ballots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ballots of several parts as those of the whole, in any order and grouping."""
    aggregates = []
    for label in LABELS:
        n, first = f"n_{label.lower()}", f"first_{label.lower()}"
        aggregates += [F.sum(n).alias(n), F.min(first).alias(first)]
    return ballots.groupBy(*keys).agg(*aggregates)


def vote(cells: DataFrame, keys: Sequence[str], order: str = ROW_ID) -> DataFrame:
    """Label counts and the winning label per group of labelled cells."""
    return decide(partial_votes(cells, keys, order), keys)


def decide(votes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The winning label of each group's ballots.

    The most frequent label wins, a tie goes to the label met first, and a group without
    values is STRING.
    """
    best = F.array_max(
        F.array(
            *[
                F.struct(
                    F.col(f"n_{label.lower()}").alias("n"),
                    (-F.col(f"first_{label.lower()}")).alias("first"),
                    F.lit(label).alias("label"),
                )
                for label in LABELS
            ]
        )
    )
    return votes.select(
        *keys,
        F.when(best["n"] > 0, best["label"]).otherwise("STRING").alias("inferred"),
        *[F.col(f"n_{label.lower()}") for label in LABELS],
    )


def type_group(inferred: Column) -> Column:
    """DATE columns are dates, INT64 and FLOAT are numeric, STRING is neither."""
    return F.when(inferred == "DATE", "date").when(inferred.isin("INT64", "FLOAT"), "numeric")


def infer_types(
    tmp: DataFrame, columns: Sequence[str], rules: RuleSet, order: str = ROW_ID
) -> DataFrame:
    """``(col, pos, inferred, n_...)`` for the columns of one table."""
    votes = vote(labelled(cells_of(tmp, columns, order), rules), ["pos"], order)
    names = F.array(*[F.lit(c) for c in columns])
    return votes.select(F.get(names, F.col("pos")).alias("col"), *votes.columns)


def infer_feed_types(rows: DataFrame, rules: RuleSet) -> DataFrame:
    """``(feed, pos, inferred, n_...)`` for every feed at once, header rows left out."""
    body = with_header(rows).filter(F.col(ROW_ID) > F.col("_header"))
    cells = body.select(
        "feed", ROW_ID, F.posexplode("cells").alias("pos", "value")
    )
    # Cleaning strips the cell already.
    cleaned = cells.withColumn("value", clean_cell(F.col("value")))
    label = label_cell(F.col("value"), rules, F.col("value"))
    return vote(cleaned.withColumn("label", label), ["feed", "pos"])


def schema_groups(types: DataFrame) -> DataFrame:
    return types.select("col", "pos", "inferred", type_group(F.col("inferred")).alias("grp"))


def _schema(columns: Sequence[str], group_of: dict[int, str | None]) -> SchemaInfo:
    def members(group: str) -> tuple[str, ...]:
        return tuple(c for i, c in enumerate(columns) if group_of.get(i) == group)

    return SchemaInfo(tuple(columns), members("date"), members("numeric"))


def infer_schema(
    tmp: DataFrame,
    columns: Sequence[str],
    rules: RuleSet,
    order: str = ROW_ID,
    sample_limit: int | None = None,
    seed: int | None = None,
) -> SchemaInfo:
    """Column groups of one table, by default from all rows.

    With ``sample_limit`` only so many rows, chosen by a hash of their position, are looked at.
    """
    if sample_limit is not None:
        rows = profile_sample(tmp.select(order, *map(quoted, columns)), limit=sample_limit, seed=seed)
        tmp = tmp.sparkSession.createDataFrame(rows.collect(), rows.schema)
    groups = schema_groups(infer_types(tmp, columns, rules, order)).collect()
    return _schema(columns, {r.pos: r.grp for r in groups})


def infer_feed_schemas(
    rows: DataFrame, headers: dict[str, list[str]], rules: RuleSet
) -> dict[str, SchemaInfo | Exception]:
    """Column groups of every feed from one job; a feed with unusable names keeps its error."""
    types = infer_feed_types(rows, rules)
    found: dict[str, dict[int, str | None]] = {}
    for r in types.select("feed", "pos", type_group(F.col("inferred")).alias("grp")).collect():
        found.setdefault(r.feed, {})[r.pos] = r.grp
    schemas: dict[str, SchemaInfo | Exception] = {}
    for feed, names in headers.items():
        try:
            schemas[feed] = _schema(names, found.get(feed, {}))
        except ValueError as error:
            schemas[feed] = error
    return schemas
