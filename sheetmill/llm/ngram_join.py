"""Jaccard join of documents over word n-grams.

Method: set relations let the join skip work. Long index lists are kept in blocks of like positions, each ordered by
size; the further down its sets a block's n-gram stands, the larger they must be, so a set skips the head of each block, and
whole blocks. Answers are derived from those of highly similar sets: in long lists every set is first compared with
the leader of each list it is in. What a pair of later ones has in common follows, up to the few n-grams in which they
differ from their leaders, from what the leaders have in common; that decides most pairs, and only the others are
read. As only components are asked for, pairs in one component are not compared at all. In short lists the
positions of all common entries of a pair bound its overlap before any set is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetmill.llm.common import components, small_batches, text_or_empty, written

#: Counters of frequent n-grams: a fixed number, so what is broadcast is 4 MB at most.
_COUNTERS = 1 << 22
#: Counters whose classes go to the driver as one row, a byte each.
_PAGE = 1 << 12
#: N-grams seen less often by a task are noise of the counters.
_NOTICED = 8
#: Least and most bits of a set's sketch; there are about half as many as n-grams. Two sets differ
#: in at least as many n-grams as their sketches in bits.
_BITS = (512, 1 << 14)
#: Lists of up to so many entries are short: their pairs are counted.
_SHORT = 16
#: Entries of a long list that are compared in one go.
_BLOCK = 4096
_PAIRS = 1 << 19

_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BYTES = np.random.default_rng(20).integers(0, 2**63, 256, np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ONE
    x = (x ^ (x >> np.uint64(29))) * _TWO
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    base = int(_TWO)
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of ``data``, A-Z lower-cased, and where the words start."""
    raw = np.frombuffer(data, np.uint8)
    solid = ~_SPACES[raw]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(1 << max(21, len(raw).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[_LOWER[raw]] * up[: len(raw)])])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return _mix(hashes + (ends - starts).astype(np.uint64) * _TWO), starts


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text.

    A text with fewer words has its whole sequence as the only n-gram; without words, none.
    """
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sets, batch, size = [], [], 0
    for data in [*coded, None]:
        if batch and (data is None or size + len(data) > 1 << 20):
            hashes, starts = word_hashes(b"\n".join(batch))
            lengths = np.array([len(b) + 1 for b in batch])
            bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
            grams = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
            for k in range(words):
                grams = grams * _ONE + hashes[k : k + len(grams)]
            grams = _mix(grams)
            for a, b in zip(bounds[:-1], bounds[1:]):
                if b - a >= words:
                    sets.append(np.unique(grams[a : b - words + 1]))
                elif b > a:
                    whole = np.full(1, b - a, np.uint64)
                    for h in hashes[a:b]:
                        whole = whole * _TWO + h
                    sets.append(_mix(whole))
                else:
                    sets.append(np.zeros(0, np.uint64))
            batch, size = [], 0
        if data is not None:
            batch.append(data)
            size += len(data)
    return sets


def set_id(grams: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(grams: np.ndarray) -> bytes:
    """Parities of the counts of a set's n-grams by their last bits."""
    width = min(max(1 << max(0, len(grams) // 2 - 1).bit_length(), _BITS[0]), _BITS[1])
    cells = np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(cells.astype(np.uint8)).tobytes()


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (one per row, in 64-bit words) as they would be with ``words`` words."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def difference(a: bytes, b: bytes) -> int:
    """How many n-grams two sets differ in at least."""
    x, y = (np.frombuffer(v, np.uint64)[None] for v in (a, b))
    words = min(x.shape[1], y.shape[1])
    return int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())


def _scan(words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_COUNTERS, np.uint32)
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            for s in sets:
                counts[(s >> np.uint64(42)).astype(np.int64)] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([set_id(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.nulls(len(sets), pa.int64()),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                ],
                names=["doc_id", "text_hash", "set_id", "n", "counter", "bits"],
            )
        often = np.flatnonzero(counts >= _NOTICED)
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.nulls(len(often), pa.int64())] * 3,
                pa.array(counts[often], pa.int64()),
                pa.array(often, pa.int64()),
                pa.nulls(len(often), pa.binary()),
            ],
            names=["doc_id", "text_hash", "set_id", "n", "counter", "bits"],
        )

    return scan


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequency classes of whole pages of counters, without the pages in which all are 0."""
    classes = np.zeros(_COUNTERS, np.uint8)
    for batch in batches:
        n = batch.column("n").to_numpy().astype(float)
        classes[batch.column("counter").to_numpy()] = np.log2(np.maximum(n, 1))
    pages = classes.reshape(-1, _PAGE)
    some = np.flatnonzero(pages.any(1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int64()), pa.array([pages[p].tobytes() for p in some], pa.binary())],
        names=["page", "classes"],
    )


def frequency_classes(counted: DataFrame) -> np.ndarray:
    """For each counter the whole part of the binary logarithm of its sum in ``counted`` (counter, n), a byte each.

    The driver gets these bytes in pages, not a row per counter: those are hundreds of thousands on some GB of texts.
    """
    sums = counted.groupBy("counter").agg(F.sum("n").alias("n"))
    dealt = sums.withColumn("page", F.floor(F.col("counter") / _PAGE)).repartition("page")
    pages = dealt.select("counter", "n").mapInArrow(_pages, "page long, classes binary").toPandas()
    classes = np.zeros(_COUNTERS, np.uint8)
    for page, found in zip(pages["page"].tolist(), pages["classes"]):
        classes[page * _PAGE : (page + 1) * _PAGE] = np.frombuffer(found, np.uint8)
    return classes


def _prefixes(words: int, num: int, den: int, classes: np.ndarray):
    """Index entries of each set's prefix: rare n-grams first, by (frequency class, hash)."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for s in shingle_sets(batch.column("text").to_pylist(), words):
                n, key = len(s), set_id(s)
                if not n or key in seen:  # copies give the same entries
                    continue
                seen.add(key)
                rank = classes[(s >> np.uint64(42)).astype(np.int64)]
                order = np.argsort(rank, kind="stable")[: n - -(-num * n // den) + 1]
                entries = (s[order].view(np.int64), rank[order].astype(np.int32))
                fill = (np.full(len(order), key), np.full(len(order), n), np.arange(len(order)))
                for column, values in zip(columns, (*entries, *fill)):
                    column.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in columns],
                    names=["token", "class", "set_id", "n", "pos"],
                )

    return prefixes


def _set_rows(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_id(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["set_id", "grams"],
            )

    return rows


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of two sets, and how many n-grams they share."""
    for batch in batches:
        a, b = batch.column("grams_a").to_pylist(), batch.column("grams_b").to_pylist()
        sizes = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            sizes.append((len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
        counts = [pa.array(c, pa.int64()) for c in zip(*sizes)] if sizes else [pa.nulls(0, pa.int64())] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), *counts], names=["a", "b", "na", "nb", "common"]
        )


def position_block(pos: np.ndarray) -> np.ndarray:
    """Blocks of like positions: 0, 1 to 2, 3 to 6..."""
    return np.log2(pos + 1).astype(np.int64)


class _Lists:
    """Entries of whole lists, ordered by list, block of positions and size, and the pairs among them."""

    def __init__(self, table: pa.Table, num: int, den: int):
        self.num, self.den = num, den
        token, low, high = (table.column(c).to_numpy() for c in ("token", "low", "high"))
        new = (token[1:] != token[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        lists = np.cumsum(np.concatenate([[False], new]))
        blocks = position_block(table.column("pos").to_numpy())
        table = table.take(pa.array(np.lexsort((table.column("n").to_numpy(), blocks, lists))))
        get = lambda name: table.column(name).to_numpy()
        self.token, self.set_id, self.component = get("token"), get("set_id"), get("component")
        self.n, self.pos, self.block = get("n"), get("pos"), get("block")
        keys = np.stack([self.token, get("low"), get("high")])
        self.cross = keys[1] != keys[2]
        #: The number of each entry's list.
        self.list = np.cumsum(np.concatenate([[0], (keys[:, 1:] != keys[:, :-1]).any(0)]))
        bits = table.column("bits").to_pylist()
        self.width = np.array([len(b) // 8 for b in bits], np.int64)
        #: By width: the sketches that are as wide or wider, folded, and where each entry's is.
        self.sketches: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        widths = np.unique(self.width)
        for width in widths.tolist():
            parts, place, size = [], np.full(len(bits), -1, np.int64), 0
            for own in widths[widths >= width].tolist():
                rows = np.flatnonzero(self.width == own)
                raw = np.frombuffer(b"".join(bits[r] for r in rows), np.uint64).reshape(len(rows), own)
                parts.append(folded(raw, width))
                place[rows] = size + np.arange(len(rows))
                size += len(rows)
            self.sketches[width] = np.concatenate(parts), place

    def pairs(self, seeds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, differing bits) of pairs of a seed and any entry of its list that may be linked and
        are in different components.

        In each block of positions of its list a seed visits a stretch of sizes only, which may be empty. If the block's
        first position is p, at most n - p n-grams of a set of n there are at or after the common one, and the
        pair needs num (n + own n) / (num + den) of them.
        """
        num, den, n = self.num, self.den, self.n
        blocks = position_block(self.pos)
        span = int(n.max()) + 2
        key = (self.list * (int(blocks.max()) + 1) + blocks) * span + n
        begins, counts, owners = [], [], []
        for block in np.unique(blocks).tolist():
            rows = np.flatnonzero(seeds)
            first = (1 << block) - 1
            least = -(-(num * n[rows] + (num + den) * first) // den)
            own = ((num + den) * (n[rows] - self.pos[rows]) - num * n[rows]) // num  # its own position
            most = np.minimum(np.minimum(n[rows] * den // num, own), span - 1)
            rows, least, most = (x[least <= most] for x in (rows, least, most))
            base = (self.list[rows] * (int(blocks.max()) + 1) + block) * span
            begin = np.searchsorted(key, base + least, "left")
            begins.append(begin)
            counts.append(np.searchsorted(key, base + most, "right") - begin)
            owners.append(rows)
        begin, count, rows = np.concatenate(begins), np.concatenate(counts), np.concatenate(owners)
        some = count > 0
        begin, count, rows = begin[some], count[some], rows[some]
        upto = np.cumsum(count)
        first = 0
        while first < len(rows):
            base = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, base + _PAIRS, "right")))
            some = slice(first, last)
            i = np.repeat(rows[some], count[some])
            j = np.arange(len(i)) + np.repeat(begin[some] - (upto[some] - count[some] - base), count[some])
            # Two seeds meet once.
            fresh = (i != j) & (~seeds[j] | (i < j))
            yield self._admitted(i[fresh], j[fresh])
            first = last

    def _admitted(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, pos = self.n, self.pos
        total = n[i] + n[j]
        need = -(-self.num * total // (self.num + self.den))
        keep = self.component[i] != self.component[j]
        # Positions: what follows the common n-gram must suffice.
        keep &= 1 + np.minimum(n[i] - pos[i], n[j] - pos[j]) - 1 >= need
        keep &= ~self.cross[i] | (self.block[i] != self.block[j])
        i, j, allowed = i[keep], j[keep], (total - 2 * need)[keep]
        differ = np.zeros(len(i), np.int64)
        narrow = np.minimum(self.width[i], self.width[j])
        for width, (sketches, place) in self.sketches.items():
            some = np.flatnonzero(narrow == width)
            for word in range(width if len(some) else 0):
                column = sketches[:, word]
                differ[some] += np.bitwise_count(column[place[i[some]]] ^ column[place[j[some]]])
        keep = differ <= allowed
        return i[keep], j[keep], differ[keep]

    def possible(self) -> np.ndarray:
        """The sets that some pair has.

        Most sets of a dense group already fit the next ones in their list; only the others visit
        all of it.
        """
        fits = np.zeros(len(self.token), bool)
        rows = np.arange(len(self.token))
        for step in (1, 2, 3, 5, 8, 13, 21, 34):
            if step < len(rows):
                i = rows[:-step][self.list[step:] == self.list[:-step]]
                i = i[~(fits[i] & fits[i + step])]
                small, large = np.minimum(self.n[i], self.n[i + step]), np.maximum(self.n[i], self.n[i + step])
                low = small * self.den >= large * self.num
                for side in self._admitted(i[low], i[low] + step)[:2]:
                    fits[side] = True
        fits = np.isin(self.set_id, self.set_id[fits])
        for i, j, _ in self.pairs(~fits):
            fits[i] = fits[j] = True
        return np.unique(self.set_id[fits])

    def _outsiders(self) -> np.ndarray:
        """Entries that are not in the largest component of their list. All pairs of different
        components have one."""
        order = np.lexsort((self.component, self.list))
        key = np.stack([self.list[order], self.component[order]])
        new = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)])
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(order)))
        group = np.cumsum(new) - 1
        lists = key[0, starts]
        by = np.lexsort((-size, lists))
        top = np.concatenate([[True], lists[by][1:] != lists[by][:-1]])
        largest = np.zeros(len(starts), bool)
        largest[by[top]] = True
        outside = np.empty(len(order), bool)
        outside[order] = ~largest[group]
        return outside

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """For each component of each list the most similar pair that leaves it; for the largest,
        those of the others do."""
        found = [x for x in self.pairs(self._outsiders()) if len(x[0])]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        i, j, differ = (np.concatenate(c) for c in zip(*found))
        ratio = differ / (self.n[i] + self.n[j])
        chosen = []
        for side in (i, j):
            order = np.lexsort((ratio, self.component[side], self.list[side]))
            key = np.stack([self.component[side][order], self.list[side][order]])
            new = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)])
            chosen.append(order[new])
        keep = np.unique(np.concatenate(chosen))
        return i[keep], j[keep]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of different components that may be linked."""
        found = [x[:2] for x in self.pairs(self._outsiders()) if len(x[0])]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found))


def _similar(num: int, den: int):
    """Pairs whose sketches do not rule a link out."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            allowed = total - 2 * -(-num * total // (num + den))
            bits = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())
            good = [difference(a, b) <= most for (a, b), most in zip(bits, allowed.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]
            ).filter(pa.array(good, pa.bool_()))

    return similar


def _proposals(mode: str, num: int, den: int):
    def proposals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> pa.RecordBatch:
            lists = _Lists(table, num, den)
            if mode == "possible":
                return pa.RecordBatch.from_arrays([pa.array(lists.possible())], names=["set_id"])
            i, j = getattr(lists, mode)()
            a, b = lists.set_id[i], lists.set_id[j]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
            )

        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            # The last list may go on in the next batch.
            key = [rest.column(c).to_numpy() for c in ("token", "low", "high")]
            same = (key[0] == key[0][-1]) & (key[1] == key[1][-1]) & (key[2] == key[2][-1])
            whole = int(np.argmax(same))
            if whole >= _BLOCK:
                yield found(rest.slice(0, whole))
                rest = rest.slice(whole)
        if rest is not None and rest.num_rows:
            yield found(rest)

    return proposals


def _is_link(common: Column, num: int, den: int) -> Column:
    return common * den >= (F.col("na") + F.col("nb") - common) * num


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of both sets and of what they share (na, nb, common)."""
    side = lambda x: sets.select(F.col("set_id").alias(x), F.col("grams").alias(f"grams_{x}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return both.mapInArrow(_overlaps, "a long, b long, na long, nb long, common long")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sets are linked, with their sizes."""
    return written(_compared(pairs, sets).where(_is_link(F.col("common"), num, den)), "links")


def _models(links: DataFrame) -> DataFrame:
    """For sets that are linked to a leader, the most similar one (model), the size of the set (n) and of the model, and
    what they share."""
    sides = [
        links.select(
            F.col(a).alias("set_id"),
            F.col(b).alias("model"),
            F.col(f"n{a}").alias("n"),
            F.col(f"n{b}").alias("model_n"),
            "common",
        )
        for a, b in ("ab", "ba")
    ]
    nearest = F.struct((2 * F.col("common") - F.col("model_n")).alias("near"), "model", "n", "model_n", "common")
    found = sides[0].unionByName(sides[1]).groupBy("set_id").agg(F.max(nearest).alias("best"))
    return found.select("set_id", "best.model", "best.n", "best.model_n", "best.common")


def _derived(pairs: DataFrame, models: DataFrame, leaders: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked, most of them by what their models share.

    A leader, and a set without one, is its own model. With x and y the models of a and b, a and b share at least
    what x and y share less x's n-grams that a lacks and y's that b lacks, and at most that and a's n-grams that x lacks
    and b's that y lacks. Where both bounds give one answer, it holds; otherwise the sets are compared.
    """
    followers = models.join(leaders, "set_id", "left_anti")

    def side(x: str) -> DataFrame:
        return followers.select(
            F.col("set_id").alias(x),
            F.col("model").alias(f"m{x}"),
            (F.col("n") - F.col("common")).alias(f"own_{x}"),
            (F.col("model_n") - F.col("common")).alias(f"lacks_{x}"),
        )

    known = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    zero = F.lit(0).cast("long")
    known = known.select(
        "a",
        "b",
        *[F.coalesce(f"m{x}", F.col(x)).alias(f"m{x}") for x in "ab"],
        *[F.coalesce(f"{c}_{x}", zero).alias(f"{c}_{x}") for c in ("own", "lacks") for x in "ab"],
    )
    known = written(
        known.withColumns({"x": F.least("ma", "mb"), "y": F.greatest("ma", "mb")}), "pairs_of_models"
    )
    shared = written(
        _compared(known.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), sets), "models_shared"
    ).select(
        F.col("a").alias("x"), F.col("b").alias("y"), F.col("na").alias("nx"), F.col("nb").alias("ny"), "common"
    )
    first = F.col("ma") == F.col("x")
    sized = known.join(shared, ["x", "y"]).withColumns(
        {
            "na": F.when(first, F.col("nx")).otherwise(F.col("ny")) + F.col("own_a") - F.col("lacks_a"),
            "nb": F.when(first, F.col("ny")).otherwise(F.col("nx")) + F.col("own_b") - F.col("lacks_b"),
        }
    )
    fewest = F.greatest(F.col("common") - F.col("lacks_a") - F.col("lacks_b"), zero)
    most = F.least(F.col("common") + F.col("own_a") + F.col("own_b"), "na", "nb")
    sized = sized.withColumns(
        {"sure": _is_link(fewest, num, den), "open": _is_link(most, num, den) & ~_is_link(fewest, num, den)}
    )
    sized = written(sized.select("a", "b", "sure", "open"), "derived")
    links = sized.where("sure").select("a", "b")
    return links.unionByName(_verified(sized.where("open"), sets, num, den).select("a", "b"))


def _short_pairs(entries: DataFrame, long_entries: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of short lists that may be linked.

    The prefix that ends first holds all common n-grams up to its end, and the pair's overlap is at
    most those and what follows it. Common entries of long lists are counted as if all were shared.
    """
    member = F.struct("set_id", "n")
    lists = entries.groupBy("token").agg(F.sort_array(F.collect_list(member)).alias("m"))

    def after(x: Column, i: Column) -> Column:
        return F.transform(
            F.slice(F.col("m"), i + 2, F.size("m")),
            lambda y: F.struct(
                x["set_id"].alias("a"), y["set_id"].alias("b"), x["n"].alias("na"), y["n"].alias("nb")
            ),
        )

    pairs = (
        lists.where(F.size("m") > 1)
        .select(F.explode(F.flatten(F.transform("m", after))).alias("p"))
        .select("p.*")
        .where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
        .groupBy("a", "b", "na", "nb")
        .agg(F.count("*").alias("common"))
    )
    extra = long_entries.groupBy("set_id").agg(F.count("*").alias("extra"))
    side = lambda x: extra.select(F.col("set_id").alias(x), F.col("extra").alias(f"extra_{x}"))
    shared = F.least(*(F.coalesce(f"extra_{x}", F.lit(0)) for x in "ab"))
    rest = F.greatest(*(F.ceil(num * F.col(n) / den) - 1 for n in ("na", "nb")))
    need = F.ceil(num * (F.col("na") + F.col("nb")) / (num + den))
    return (
        pairs.join(side("a"), "a", "left")
        .join(side("b"), "b", "left")
        .where(F.col("common") + shared + rest >= need)
        .select("a", "b", "na", "nb")
    )


def _ordered(entries: DataFrame, blocks: DataFrame, columns: list[str]) -> DataFrame:
    """Entries of long lists in blocks: each block with itself and with every other."""
    return (
        entries.join(blocks, "token")
        .withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select("token", "low", "high", "block", *columns)
        .repartition("token", "low", "high")
        .sortWithinPartitions("token", "low", "high", "n", "set_id")
    )


def ngram_join(
    docs: DataFrame,
    words: int = 4,
    least: tuple[int, int] = (85, 100),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    salt_rows: int = 4096,
) -> DataFrame:
    """Link documents whose sets of word n-grams have a Jaccard similarity of ``least`` or more.

    ``least`` is a fraction (numerator, denominator), compared in whole numbers. Words are
    stretches without white space, A-Z lower-cased. A text with fewer words has its whole sequence
    as its only n-gram; null, empty and blank texts have none and link with nothing.

    Returns one row per input row: doc_id, text_hash, n_shingles, set_id, component_id (smallest id
    reachable by links, or its own). Documents with equal sets are linked. Rows that repeat an id are
    documents of their own. Null ids never name a component; a set that only rows without id have is
    linked with nothing else, and its component is null. An empty table gives no rows; further columns
    are not read.

    N-grams and sets are 64-bit hashes. Equal sets are one node, found by an aggregation. Only
    prefixes are indexed, and entries of n-grams that one set has are dropped. Pairs are listed for
    short lists only; long ones are compared within tasks, in blocks, and pairs whose sets are
    connected already are skipped. An entry of a long list is copied to each of its list's blocks, so
    a list of N entries emits about N * N / ``_BLOCK`` rows (N up to ``_BLOCK``): that grows with the
    square of very large lists of different sets. The driver gets at most ``_COUNTERS`` bytes of frequency classes.
    Every step is a written table.
    """
    spark = docs.sparkSession
    num, den = least
    small_batches(spark)
    body = text_or_empty(F.col(text_col))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("text"))
    scanned = written(
        texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
            _scan(words), "doc_id long, text_hash long, set_id long, n long, counter long, bits binary"
        ),
        "sets",
    )
    rows = scanned.where("counter is null").select("doc_id", "text_hash", "set_id", "n")
    classes = frequency_classes(scanned.where("counter is not null").select("counter", "n"))
    shared = spark.sparkContext.broadcast(classes)

    def prefixes(batches):
        return _prefixes(words, num, den, shared.value)(batches)

    # Frequent n-grams are salted: so many sets may have them that no task should get them all.
    salts = F.ceil(F.pow(F.lit(2.0), "class") / salt_rows).cast("int")
    postings = (
        texts.select("text")
        .mapInArrow(prefixes, "token long, class int, set_id long, n long, pos long")
        .withColumn("salts", salts)
        .withColumn("salt", F.pmod(F.col("set_id"), F.col("salts")))
        .repartition("token", "salt")
    )
    own = Window.partitionBy("token", "salt")
    entries = written(
        postings.groupBy("token", "salt", "salts", "class", "set_id", "n")
        .agg(F.min("pos").alias("pos"))
        .withColumn("entries", F.count("*").over(own) * F.col("salts"))
        .where((F.col("entries") > 1) | (F.col("salts") > 1))
        .select("token", "set_id", "n", "pos", "entries", (F.col("salts") > 1).alias("salted")),
        "entries",
    )
    is_long = F.col("salted") | (F.col("entries") > _SHORT)
    long_entries = written(entries.where(is_long).drop("salted"), "long_entries")
    candidates = written(_short_pairs(entries.where(~is_long), long_entries, num, den), "candidates")
    looked_at = candidates.select(F.explode(F.array("a", "b")).alias("set_id"))
    looked_at = looked_at.unionByName(long_entries.select("set_id")).distinct()
    sketches = scanned.where("counter is null").join(looked_at, "set_id", "left_semi")
    sketches = written(sketches.select("set_id", "bits").dropDuplicates(["set_id"]), "sketches")
    side = lambda x: sketches.select(F.col("set_id").alias(x), F.col("bits").alias(f"bits_{x}"))
    candidates = written(
        candidates.join(side("a"), "a").join(side("b"), "b").mapInArrow(_similar(num, den), "a long, b long"),
        "similar",
    )

    # Long lists: the sets that may have a link there at all.
    blocks = long_entries.groupBy("token").agg(
        F.ceil(F.max("entries") / _BLOCK).cast("int").alias("blocks")
    )
    columns = ["set_id", "n", "pos", "component", "bits"]
    apart = long_entries.withColumn("component", F.col("set_id")).join(sketches, "set_id")
    possible = written(
        _ordered(apart, blocks, columns).mapInArrow(_proposals("possible", num, den), "set_id long").distinct(),
        "possible",
    )
    long_entries = long_entries.join(possible, "set_id", "left_semi")

    # The n-grams of all sets that may have a link.
    needed = candidates.select(F.explode(F.array("a", "b")).alias("set_id")).unionByName(possible).distinct()
    owners = rows.join(needed, "set_id").groupBy("set_id").agg(F.min("doc_id").alias("owner"))
    owners = written(owners, "owners")
    sets = written(
        texts.join(owners.select(F.col("owner").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .select("text")
        .mapInArrow(_set_rows(words), "set_id long, grams binary")
        .join(owners, "set_id", "left_semi")
        .dropDuplicates(["set_id"]),
        "grams",
    )

    # 1. Short lists' pairs, and in long lists every set against the leader: that of the smallest id.
    long_entries = written(long_entries.join(sets.select("set_id"), "set_id", "left_semi"), "compared")
    led = long_entries.join(owners, "set_id").select("token", "set_id", "n", "pos", "owner")
    leaders = led.groupBy("token").agg(F.min(F.struct("owner", "set_id", "n", "pos")).alias("first"))
    total = F.col("n") + F.col("first.n")
    fits = (
        (F.col("set_id") != F.col("first.set_id"))
        & (F.least("n", "first.n") * den >= F.greatest("n", "first.n") * num)
        & (
            F.least(F.col("n") - F.col("pos"), F.col("first.n") - F.col("first.pos"))
            >= F.ceil(num * total / (num + den))
        )
    )
    star = led.join(leaders, "token").where(fits)
    star = star.select(
        F.least("set_id", "first.set_id").alias("a"), F.greatest("set_id", "first.set_id").alias("b")
    )
    led_by = _verified(star.distinct(), sets, num, den)
    models = written(_models(led_by), "models")
    named = written(leaders.select(F.col("first.set_id").alias("set_id")).distinct(), "leaders")
    links = _verified(candidates.join(star.distinct(), ["a", "b"], "left_anti"), sets, num, den)
    links = links.select("a", "b").unionByName(led_by.select("a", "b"))
    found = written(components(links), "components")

    # 2. and 3. What the leaders leave: long lists that still hold several components.
    for mode in ("best", "all"):
        mapped = found.select(F.col("id").alias("set_id"), "component")
        parts = long_entries.join(mapped, "set_id", "left").withColumn(
            "component", F.coalesce("component", "set_id")
        )
        parts = written(parts, "open")
        several = (
            parts.groupBy("token")
            .agg(F.min("component").alias("x"), F.max("component").alias("y"))
            .where("x <> y")
            .join(blocks, "token")
            .select("token", "blocks")
        )
        opened = _ordered(parts.join(sketches, "set_id"), several, columns)
        pairs = opened.mapInArrow(_proposals(mode, num, den), "a long, b long").distinct()
        links = links.unionByName(_derived(pairs, models, named, sets, num, den))
        found = written(components(links), "components")

    labelled = rows.join(found.select(F.col("id").alias("set_id"), "component"), "set_id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "set_id"))
    names = labelled.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    return labelled.join(names, "component", "left").select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        "set_id",
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
    )
