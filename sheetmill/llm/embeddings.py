"""Near-duplicate embeddings by an inverted multi-index.

Method: independent codebooks on the two halves of a vector form a product grid of cells. A
multi-sequence traversal merges the two ordered lists of codewords and visits the nearest cells
until the target recall is reached. What the visited cells hold is verified by its cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sheetmill.llm.common import components, written

#: Words of a codebook: at least so many at every size, and at most. The most make cells of ``cell_rows`` vectors up to
#: four thousand million vectors a label; beyond, cells grow and are split into blocks.
LEAST_WORDS, MOST_WORDS = 8, 2048

_KEY = ["label", "dim", "cell", "member_block", "visit_block"]


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of both halves, and the squared distance up to which cells are visited."""

    halves: tuple[np.ndarray, np.ndarray]
    reach: float

    @property
    def cells(self) -> int:
        return len(self.halves[0]) * len(self.halves[1])

    def bounds(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home cells, and per half the squared distance to each codeword's region, at least.

        A vector of another region lies beyond the plane between both codewords.
        """
        cut = self.halves[0].shape[1]
        lows, homes = [], []
        for book, part in zip(self.halves, (units[:, :cut], units[:, cut:])):
            distance = ((part**2).sum(1)[:, None] - 2 * part @ book.T) + (book**2).sum(1)
            home = distance.argmin(1)
            apart = np.sqrt(((book[:, None] - book[None]) ** 2).sum(2))[home]
            gap = distance - distance[np.arange(len(part)), home][:, None]
            low = np.divide(gap, 2 * apart, out=np.zeros_like(gap), where=apart > 0)
            lows.append(np.maximum(low, 0) ** 2)
            homes.append(home)
        return homes[0] * len(self.halves[1]) + homes[1], lows[0], lows[1]

    def visited(self, first: np.ndarray, second: np.ndarray) -> list[list[int]]:
        """Cells of each vector within reach, by rising distance.

        Both halves are ordered; codeword i of the first goes with a leading run of the second.
        """
        width, found = second.shape[1], []
        orders, values = np.argsort(second, 1), np.sort(second, 1)
        for row in range(len(first)):
            near = np.flatnonzero(first[row] <= self.reach)
            runs = np.searchsorted(values[row], self.reach - first[row, near], "right")
            i = np.repeat(near, runs)
            j = orders[row, np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)]
            order = np.argsort(first[row, i] + second[row, j], kind="stable")
            found.append((i * width + j)[order].tolist())
        return found


def units_of(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square over- or underflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(1, keepdims=True))


def _codebook(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    book = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        near = ((book**2).sum(1) - 2 * points @ book.T).argmin(1)
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        count = np.bincount(near, minlength=len(book))
        book[count > 0] = sums[count > 0] / count[count > 0, None]
    return book


def _needed(index: MultiIndex, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The reach at which each pair of vectors is found: when either visits the other's cell."""
    width = len(index.halves[1])
    sides = [index.bounds(left), index.bounds(right)]
    rows, found = np.arange(len(left)), []
    for (_, first, second), (home, _, _) in (sides, sides[::-1]):
        found.append(first[rows, home // width] + second[rows, home % width])
    return np.minimum(*found)


def fit_index(
    units: np.ndarray,
    k: int,
    least: float,
    recall: float,
    seed: int = 7,
    labels: np.ndarray | None = None,
) -> MultiIndex:
    """Codebooks of ``k`` words per half, and the reach for a target recall.

    Two unit vectors of cosine ``least`` are at a squared distance of 2 - 2 * least, so a recall
    of 1 needs no cell beyond it. For a lower target, codebooks are fitted on one half of the sample and the reach is
    measured on the other: at the greater of two quantiles, that of its own links (other vectors of equal label) and that of
    links planted at just this cosine in random directions, which are there even if the sample has none of its own.
    """
    rng, cut = np.random.default_rng(seed), max(1, units.shape[1] // 2)
    limit = 2 - 2 * least + 1e-9
    exact = recall >= 1 or units.shape[1] < 2 or len(units) < 2
    seen, held = (units, units) if exact else (units[::2], units[1::2])
    books = (_codebook(seen[:, :cut], k, rng), _codebook(seen[:, cut:], k, rng))
    index = MultiIndex(books, limit)
    if exact:
        return index
    some = held[np.arange(max(len(held), 10_000)) % len(held)][:20_000]
    noise = rng.normal(size=some.shape)
    noise -= (noise * some).sum(1, keepdims=True) * some
    noise /= np.sqrt((noise**2).sum(1, keepdims=True))
    needed = [_needed(index, some, least * some + math.sqrt(max(0.0, 1 - least**2)) * noise)]
    own = np.zeros(len(held), np.int64) if labels is None else np.unique(labels, return_inverse=True)[1][1::2]
    for i in range(0, len(held), 512):
        x, y = np.nonzero((held[i : i + 512] @ held.T >= least) & (own[i : i + 512, None] == own))
        x, y = x[i + x < y], y[i + x < y]
        needed.append(_needed(index, held[i + x], held[y]))
    links = np.concatenate(needed[1:])
    reach = max(float(np.quantile(n, recall, method="higher")) for n in (needed[0], links) if len(n))
    return MultiIndex(books, min(limit, reach))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _placed(indexes: dict[int, MultiIndex]):
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                home, first, second = indexes[int(dim)].bounds(units_of(_matrix(part.column("vector"))))
                visits = indexes[int(dim)].visited(first, second)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(home, pa.int32()), pa.array(visits, pa.list_(pa.int32()))],
                    names=["node", "home", "visits"],
                )

    return placed


def _verify(least: float):
    def verify(table: pa.Table) -> pa.Table:
        member = table.column("member").to_numpy(zero_copy_only=False).astype(bool)
        units = units_of(_matrix(table.column("vector")))
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        home, visits = table.column("home").to_numpy(), table.column("visits")
        m, q = np.flatnonzero(member), np.flatnonzero(~member)
        degree, root = np.zeros(len(node), np.int64), node.copy()
        pairs = []
        for at in range(0, len(q), 512):
            rows = q[at : at + 512]
            near = (units[rows] @ units[m].T >= least) & (node[rows][:, None] != node[m])
            degree[rows] = near @ copies[m]
            x, y = np.nonzero(near)
            pairs.append(np.stack([rows[x], m[y]]))
        x, y = np.concatenate(pairs, 1) if pairs else np.zeros((2, 0), np.int64)
        # A member that does not visit the other's cell learns of the link here.
        order = np.argsort(y, kind="stable")
        x, y = x[order], y[order]
        for one in np.unique(y):
            mine = x[np.searchsorted(y, one) : np.searchsorted(y, one, "right")]
            unseen = ~np.isin(home[mine], visits[int(one)].as_py())
            degree[one] += copies[mine[unseen]].sum()
        while True:  # the smallest node along the links of this cell
            before = root.copy()
            np.minimum.at(root, x, root[y])
            np.minimum.at(root, y, root[x])
            if (before == root).all():
                break
        told = (degree > 0) | (root != node)
        return pa.table({"node": node[told], "degree": degree[told], "root": root[told]})

    return verify


def near_embeddings(
    vectors: DataFrame,
    least: float = 0.93,
    *,
    recall: float = 1.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    sample_rows: int = 20_000,
    cell_rows: int = 1000,
    block_rows: int = 4096,
) -> DataFrame:
    """Link vectors of equal label whose cosine, in double precision, is ``least`` or more.

    Returns one row per input row: vec_id, n_links (other rows linked directly), component_id
    (smallest id reachable by links, or its own), kept (vec_id = component_id).

    Null labels, and vectors that are null, empty, zero or hold null or non-finite components,
    link with nothing. Vectors of different lengths are not compared. Rows that repeat an id are
    rows of their own and link like any other. Null ids never name a component unless it has
    no other; then it is null. An empty table gives no rows; further columns are not read.

    With ``recall`` below 1 cells are visited up to the reach that finds this share of links in the sample, so links
    may be missed; with 1 none is, but nearly every cell of unclustered vectors is visited.
    Codebooks are fitted on about ``sample_rows`` vectors of each length; every vector is indexed.
    Equal vectors of a label are one node, found by an aggregation. Cells above ``block_rows`` are
    split into blocks of members and of visitors. A cell's task returns a row per vector, not per
    link, so dense groups give no more rows than loose ones.
    """
    vector = F.col(vector_col)
    plain: Column = (
        F.col(label_col).isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(plain, F.col(label_col)).alias("label"),
        F.when(plain, vector).alias("vector"),
    ).withColumn("node", F.when(F.col("label").isNotNull(), F.xxhash64("label", "vector")))
    nodes = written(
        rows.where("node is not null")
        .groupBy("node", "label", "vector")
        .agg(F.count("*").cast("long").alias("copies"))
        .withColumn("dim", F.size("vector")),
        "nodes",
    )
    # A few numbers per length: how many vectors, and the largest label.
    sizes = (
        nodes.groupBy("dim", "label")
        .agg(F.count("*").alias("n"))
        .groupBy("dim")
        .agg(F.sum("n").alias("n"), F.max("n").alias("most"))
        .collect()
    )
    indexes = {}
    for size in sizes:
        own = nodes.where(F.col("dim") == size["dim"])
        share = min(1.0, sample_rows / size["n"])
        chosen = F.shiftrightunsigned(F.xxhash64("node"), 11) < F.lit(int(share * (1 << 53)))
        sample = own.where(chosen).select("node", "label", "vector").toPandas().sort_values("node")
        if not len(sample):
            sample = own.limit(1).toPandas()
        k = min(MOST_WORDS, max(LEAST_WORDS, math.ceil(math.sqrt(size["most"] / cell_rows))))
        units = units_of(np.stack(sample["vector"].tolist()))
        indexes[size["dim"]] = fit_index(units, k, least, recall, labels=sample["label"].to_numpy())
    placed = nodes.select("node", "dim", "vector").mapInArrow(
        _placed(indexes), "node long, home int, visits array<int>"
    )
    placed = written(nodes.join(placed, "node"), "placed")
    member = placed.withColumn("cell", F.col("home")).withColumn("member", F.lit(True))
    visitor = placed.withColumn("cell", F.explode("visits")).withColumn("member", F.lit(False))
    everyone = member.unionByName(visitor)
    cell = ["label", "dim", "cell"]
    blocks = everyone.groupBy(*cell).agg(
        F.ceil(F.count_if("member") / block_rows).cast("int").alias("member_blocks"),
        F.ceil(F.count_if(~F.col("member")) / block_rows).cast("int").alias("visit_blocks"),
    )
    everyone = everyone.join(blocks.where("member_blocks > 0"), cell)
    own_block = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    all_blocks = lambda n: F.sequence(F.lit(0), n - 1)
    members, visits = F.col("member_blocks"), F.col("visit_blocks")
    dealt = (
        everyone.withColumn("own", F.when(F.col("member"), own_block(members)).otherwise(own_block(visits)))
        .withColumn("other", F.explode(F.when(F.col("member"), all_blocks(visits)).otherwise(all_blocks(members))))
        .withColumn("member_block", F.when(F.col("member"), F.col("own")).otherwise(F.col("other")))
        .withColumn("visit_block", F.when(F.col("member"), F.col("other")).otherwise(F.col("own")))
        .select(*_KEY, "member", "node", "copies", "home", "visits", "vector")
    )
    seen = written(
        dealt.groupBy(*_KEY).applyInArrow(_verify(least), "node long, degree long, root long"), "seen"
    )
    found = components(seen.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degrees = seen.groupBy("node").agg(F.sum("degree").alias("degree"))
    summary = nodes.select("node", "copies").join(degrees, "node", "left").join(
        found.withColumnRenamed("id", "node"), "node", "left"
    )
    labelled = rows.select("vec_id", "node").join(summary, "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    names = labelled.where("node is not null").groupBy("component").agg(F.min("vec_id").alias("smallest"))
    smallest = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("smallest"))
    return labelled.join(names, "component", "left").select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("degree", F.lit(0)), F.lit(0)).alias("n_links"),
        smallest.alias("component_id"),
        F.col("vec_id").eqNullSafe(smallest).alias("kept"),
    )
