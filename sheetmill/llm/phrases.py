"""Collocations: phrases whose words stand together more often than by chance.

Method, after ERA (Mansour et al., 2011), on words: the suffixes of all texts, cut to the longest
phrase length, are dealt by their first words into groups that fit a memory budget; prefixes above the
budget are made longer. Every group builds the subtrees of its prefixes on its own, as sorted rows with a leaf total
each, and reads the count of every phrase from the leaf totals below it. A prefix below the least count
needs no subtree: words, and then pairs of frequent words, are counted first; suffixes begin with two frequent pairs
and end before a rare one, and subtrees begin at the third word. Tasks know the frequent words and pairs by a filter of
bounded size, which may take a rare one for frequent and never the reverse; the counts themselves are exact.

A word of a language is named by a 64-bit hash. A second hash shows whether two words that matter share a
name; then all is done again with other hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetmill.llm.common import small_batches, text_or_empty, written
from sheetmill.llm.words import BLANKS, PIECE_ENDS, by_size, split_words

#: The filter's bits: 16 an entry, as a power of two between these.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26

#: Prefixes above this number of suffixes are made longer; a group has about four times as many.
PREFIX_ROWS = 100_000
GROUP_ROWS = 400_000

#: A task's arrays take up to about 100 times its batch of texts: rows of five words of 8 bytes, their order, their copies.
BATCH_BYTES = 1 << 20

#: Every task knows the prefixes to be made longer: of each length at most 2 to this power.
MOST_HEAVY = 20

_UNKNOWN = "und"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hash(words: pa.BinaryArray, seed: int) -> np.ndarray:
    """64-bit hashes of byte strings: polynomials of random numbers per byte, mixed."""
    if not len(words):
        return np.zeros(0, np.uint64)
    random = np.random.default_rng(seed)
    table = random.integers(0, 1 << 64, 256, np.uint64)
    base = random.integers(0, 1 << 62, dtype=np.uint64) * np.uint64(4) + np.uint64(3)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], lengths)
    powers = np.cumprod(np.full(max(1, lengths.max(initial=1)), base, np.uint64))
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[data] * powers[place], dtype=np.uint64)])
    ends = offsets - offsets[0]
    return _mixed(upto[ends[1:]] - upto[ends[:-1]] + _mixed(lengths.astype(np.uint64)))


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * np.uint64(0x9E3779B97F4A7C15) + _mixed(right))


class Filter:
    """Which hashes are frequent, with errors to one side; two bits an entry."""

    def __init__(self, bits: np.ndarray):
        self._bits, self._mask = bits, np.uint64(8 * len(bits) - 1)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for shift in (0, 32):
            place = (hashes >> np.uint64(shift)) & self._mask
            found &= (self._bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1) > 0
        return found


def _filter_of(hashes: DataFrame, column: str) -> Filter:
    """The filter of a table's hashes. Its bytes, MOST_BITS / 8 at most, are put together from words of 64 bits."""
    n = hashes.count()
    size = LEAST_BITS
    while size < min(16 * n, MOST_BITS):
        size *= 2
    places = F.array(F.col(column), F.shiftrightunsigned(column, 32))
    place = hashes.select(F.explode(places).alias("p")).select(F.col("p").bitwiseAND(size - 1).alias("p"))
    bit = F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits")
    longs = place.groupBy(F.shiftright("p", 6).alias("at")).agg(bit).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[longs.column("at").to_numpy()] = longs.column("bits").to_numpy()
    return Filter(bits.view(np.uint8))


@dataclass(frozen=True)
class _Scan:
    """How tasks read texts: bytes at a time, seed of the hashes and how many bits of them count."""

    size: int
    seed: int
    bits: int

    def clipped(self, hashes: np.ndarray) -> np.ndarray:
        """Zero stands for no word."""
        return np.maximum(hashes >> np.uint64(64 - self.bits), np.uint64(1))


def _word_batches(batches: Iterator[pa.RecordBatch], scan: _Scan, *seeds: int) -> Iterator[tuple]:
    """Per batch: the words, the languages, the distinct (language, word) as one number, for each word its place
    among these, and their hashes by each of ``seeds``."""
    for batch in by_size(batches, scan.size):
        words = split_words(batch.column("text"), BLANKS + PIECE_ENDS, lower=True)
        langs = batch.column("lang").dictionary_encode()
        of_text = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lang = np.repeat(of_text, np.diff(words.firsts))
        n = max(1, len(words.names))
        distinct, own = np.unique(lang * n + words.codes, return_inverse=True)
        names = langs.dictionary.cast(pa.binary())
        hashes = [
            _mixed(_word_hash(words.names, s)[distinct % n] ^ _word_hash(names, s + 1)[distinct // n])
            if len(distinct)
            else np.zeros(0, np.uint64)
            for s in seeds
        ]
        yield words, langs.dictionary, distinct, own, hashes


def _same_piece(words) -> np.ndarray:
    """For every word but the last whether the next one is in the same piece."""
    ends = np.zeros(256, bool)
    ends[list(PIECE_ENDS)] = True
    cuts = np.concatenate([[0], np.cumsum(ends[words.data], dtype=np.int32)])
    return cuts[words.starts[1:]] == cuts[words.ends[:-1]]


def _word_counts(rows: DataFrame, scan: _Scan) -> DataFrame:
    """Words by hash: h, total, n, lang, word, clash (several words of one hash); and per language one row without a
    word (total), with the number of all its words."""
    seed = scan.seed

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, langs, distinct, own, (h, check) in _word_batches(batches, scan, seed, seed + 2):
            h = scan.clipped(h)
            n = max(1, len(words.names))
            counts = np.bincount(own, minlength=len(distinct)) if len(own) else np.zeros(0, np.int64)
            totals = np.bincount(distinct // n, counts, len(langs)).astype(np.int64)
            lang_names = [_word_hash(langs.cast(pa.binary()), s) for s in (seed + 1, seed + 3)]
            no_word = pa.nulls(len(langs), pa.binary())
            named = pa.array(distinct // n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([h, lang_names[0]]).view(np.int64)),
                    pa.array(np.concatenate([check, lang_names[1]]).view(np.int64)),
                    pa.concat_arrays([langs.take(named), langs]),
                    pa.concat_arrays([words.names.take(pa.array(distinct % n)), no_word]),
                    pa.array(np.concatenate([counts, totals])),
                ],
                names=["h", "check", "lang", "word", "n"],
            )

    counted = rows.mapInArrow(count, "h long, check long, lang string, word binary, n long")
    return counted.groupBy("h", F.col("word").isNull().alias("total")).agg(
        F.sum("n").alias("n"),
        F.min("lang").alias("lang"),
        F.min("word").alias("word"),
        (F.min("check") != F.max("check")).alias("clash"),
    )


def _pair_counts(rows: DataFrame, scan: _Scan, frequent: Filter) -> DataFrame:
    """Pairs of neighbouring frequent words: w0, w1, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _, _, own, (h,) in _word_batches(batches, scan, scan.seed):
            h = scan.clipped(h)
            if len(own) < 2:
                continue
            known = frequent.of(h)[own]
            first = np.flatnonzero(_same_piece(words) & known[:-1] & known[1:])
            pairs, n = np.unique(own[first] * len(h) + own[first + 1], return_counts=True)
            sides = [pa.array(h[pairs // len(h)].view(np.int64)), pa.array(h[pairs % len(h)].view(np.int64))]
            yield pa.RecordBatch.from_arrays([*sides, pa.array(n)], names=["w0", "w1", "n"])

    counted = rows.mapInArrow(count, "w0 long, w1 long, n long")
    return counted.groupBy("w0", "w1").agg(F.sum("n").alias("n"))


def _pair_hashes(pairs: DataFrame) -> DataFrame:
    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(w).to_numpy().view(np.uint64) for w in ("w0", "w1"))
            yield pa.RecordBatch.from_arrays([pa.array(_paired(left, right).view(np.int64))], names=["h"])

    return pairs.select("w0", "w1").mapInArrow(paired, "h long")


def _sorted_totals(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with their totals."""
    order = np.lexsort(rows.T[::-1])
    rows, n = rows[order], n[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return rows[new], np.add.reduceat(n, np.flatnonzero(new)) if len(n) else n


@dataclass(frozen=True)
class _Prefixes:
    """How suffixes are dealt to ``parts``: by the hash of their first two words, or of one more for each
    size, from two on, at which ``heavy`` has the hash of their prefix (sorted)."""

    parts: int
    heavy: tuple[np.ndarray, ...] = ()

    def hashes(self, suffixes: np.ndarray, size: int) -> np.ndarray:
        hashes = suffixes[:, 0]
        for k in range(1, size):
            hashes = _paired(hashes, suffixes[:, k])
        return hashes

    def known(self, suffixes: np.ndarray) -> np.ndarray:
        """Words of each suffix's prefix."""
        known = np.full(len(suffixes), 2, np.int8)
        for size, heavy in enumerate(self.heavy, 2):
            known[(known == size) & np.isin(self.hashes(suffixes, size), heavy)] = size + 1
        return known

    def part(self, suffixes: np.ndarray, known: np.ndarray) -> np.ndarray:
        key = np.zeros(len(suffixes), np.uint64)
        for size in range(2, len(self.heavy) + 3):
            key = np.where(known == size, self.hashes(suffixes, size), key)
        return (key % np.uint64(self.parts)).astype(np.int32)


@dataclass(frozen=True)
class _Suffixes:
    """Suffixes of ``depth`` words that begin with two frequent pairs and end before a rare one."""

    scan: _Scan
    depth: int
    words_in: Filter
    pairs_in: Filter

    def of(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per batch the distinct suffixes in order (hashes; 0: no word), and how often each occurs."""
        for words, _, _, own, (h,) in _word_batches(batches, self.scan, self.scan.seed):
            h = self.scan.clipped(h)
            if len(own) < 2:
                continue
            known = self.words_in.of(h)[own]
            first = np.flatnonzero(_same_piece(words) & known[:-1] & known[1:])
            first = first[self.pairs_in.of(_paired(h[own[first]], h[own[first + 1]]))]
            goes_on = np.zeros(len(own) + self.depth, bool)
            goes_on[first] = True
            first = first[goes_on[first + 1]]
            found = np.zeros((len(first), self.depth), np.uint64)
            alive = np.ones(len(first), bool)
            for k in range(self.depth):
                found[alive, k] = h[own[first[alive] + k]]
                alive &= goes_on[first + k]
            yield _sorted_totals(found, np.ones(len(found), np.int64))


def _heavy_prefixes(
    rows: DataFrame, pairs: DataFrame, suffixes: _Suffixes, parts: int, prefix_rows: int
) -> _Prefixes:
    """Prefixes that occur more than ``prefix_rows`` times, by size: at most one for so many pairs of words."""
    sizes: list[np.ndarray] = []
    counts = _pair_hashes(pairs.where(F.col("n") > prefix_rows)).withColumn("n", F.lit(prefix_rows + 1))
    while len(sizes) < suffixes.depth - 2:
        found = counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > prefix_rows)
        heavy = np.sort(found.select("h").toArrow().column("h").to_numpy().view(np.uint64))
        if not len(heavy):
            break
        sizes.append(heavy)
        upto, size = _Prefixes(parts, tuple(sizes)), len(sizes) + 2

        def count(batches: Iterator[pa.RecordBatch], upto=upto, size=size) -> Iterator[pa.RecordBatch]:
            for own, n in suffixes.of(batches):
                longer = upto.known(own) == size
                keys, place = np.unique(upto.hashes(own[longer], size), return_inverse=True)
                n = np.bincount(place, n[longer], len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["h", "n"])

        counts = rows.mapInArrow(count, "h long, n long")
    return _Prefixes(parts, tuple(sizes))


def _blocks(rows: DataFrame, suffixes: _Suffixes, prefixes: _Prefixes) -> DataFrame:
    """Per batch and part one sorted block: suffixes, words of their prefixes, occurrences, each as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, n in suffixes.of(batches):
            known = prefixes.known(own)
            part = prefixes.part(own, known)
            order = np.argsort(part, kind="stable")
            names, starts = np.unique(part[order], return_index=True)
            ends = [*starts[1:], len(order)]
            blocks = [order[a:b] for a, b in zip(starts, ends)]
            columns = [pa.array([x[b].tobytes() for b in blocks], pa.binary()) for x in (own, known, n)]
            yield pa.RecordBatch.from_arrays([pa.array(names), *columns], names=["part", "words", "known", "n"])

    return rows.mapInArrow(pack, "part int, words binary, known binary, n binary")


def _subtrees(blocks: DataFrame, depth: int, least: int) -> DataFrame:
    """Counts of phrases of three words or more, read from the subtrees of every part: words, n. Nodes above a
    part's prefixes, which other parts may share, come as parts of their count."""

    def column(table: pa.Table, name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    def read(table: pa.Table) -> pa.Table:
        rows = column(table, "words", np.uint64).reshape(-1, depth)
        order = np.lexsort(rows.T[::-1])
        rows = rows[order]
        known, n = column(table, "known", np.int8)[order], column(table, "n", np.int64)[order]
        differs = rows[1:] != rows[:-1]
        phrases, counts = [], []
        for size in range(3, depth + 1):
            # A node: leaves that agree in their first words. Shorter leaves are none of its.
            new = np.concatenate([[True], differs[:, :size].any(axis=1)])
            at = np.flatnonzero(new)
            totals = np.add.reduceat(n, at)
            kept = (rows[at, size - 1] != 0) & ((totals >= least) | (known[at] > size))
            phrases.extend(r[:size] for r in rows[at[kept]].view(np.int64).tolist())
            counts.append(totals[kept])
        return pa.table(
            [pa.array(phrases, pa.list_(pa.int64())), pa.array(np.concatenate(counts))], names=["words", "n"]
        )

    found = blocks.groupBy("part").applyInArrow(read, "words array<bigint>, n long")
    return found.groupBy("words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def phrase_counts(
    docs: DataFrame,
    *,
    text_col: str = "text",
    group_col: str = "lang",
    longest: int = 5,
    least: int = 100,
    batch_bytes: int = BATCH_BYTES,
    prefix_rows: int = PREFIX_ROWS,
    group_rows: int = GROUP_ROWS,
    hash_bits: int = 64,
) -> tuple[DataFrame, DataFrame]:
    """Words (h, total, n, lang, word) and phrases (words: hashes, n) that occur ``least`` times or more.

    Rows of the first with ``total`` hold the number of all words of a language. Both are written tables. Words are
    named by ``hash_bits`` bits at first; where two that matter share a name, other hashes with more bits are taken.
    """
    small_batches(docs.sparkSession)
    lang = F.coalesce(F.col(group_col).cast("string"), F.lit(_UNKNOWN)).alias("lang")
    rows = docs.select(lang, text_or_empty(F.col(text_col)).alias("text"))
    scan = _Scan(batch_bytes, 1, hash_bits)
    while True:
        words = _word_counts(rows, scan).where(F.col("total") | (F.col("n") >= least))
        words = written(words, "words")
        if words.where("clash").isEmpty():
            break
        scan = _Scan(batch_bytes, scan.seed + 10, min(64, scan.bits + 16))
    frequent = _filter_of(words.where("not total"), "h")
    pairs = written(_pair_counts(rows, scan, frequent).where(F.col("n") >= least), "pairs")
    phrases = pairs.select(F.array("w0", "w1").alias("words"), "n")
    if longest > 2:
        suffixes = _Suffixes(scan, longest, frequent, _filter_of(_pair_hashes(pairs), "h"))
        total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        prefix_rows = max(prefix_rows, total >> MOST_HEAVY)
        prefixes = _heavy_prefixes(rows, pairs, suffixes, max(1, -(-total // group_rows)), prefix_rows)
        phrases = phrases.unionByName(_subtrees(_blocks(rows, suffixes, prefixes), longest, least))
    return words, written(phrases, "phrases")


def _cut_scores(words: DataFrame, phrases: DataFrame, longest: int) -> DataFrame:
    """Per phrase (words, a, lang, n) its lowest-scoring cut (l, r, score)."""
    alone = words.where("not total").select(F.array("h").alias("words"), "n")
    every = alone.unionByName(phrases)
    size = F.size("words")
    cuts = phrases.select(
        "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    ).withColumns({"left": F.expr("slice(words, 1, k)"), "right": F.expr("slice(words, k + 1, size(words) - k)")})
    lefts = every.select(F.col("words").alias("left"), F.col("n").alias("l"))
    rights = every.select(F.col("words").alias("right"), F.col("n").alias("r"))
    own = words.where("not total").select(F.col("h").alias("first"), "lang")
    totals = words.where("total").select("lang", F.col("n").alias("n"))
    named = (
        cuts.join(lefts, "left")
        .join(rights, "right")
        .withColumn("first", F.get("words", F.lit(0)))
        .join(own, "first")
        .join(totals, "lang")
    )
    # The product may have more than 64 bits; the quotient has not.
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    scored = named.withColumns({f"{c}_wide": column for c, column in wide.items()}).withColumn(
        "score", F.expr("(a_wide * n_wide * 1000BD) div (l_wide * r_wide)")
    )
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return scored.groupBy("words", "a", "lang", "n").agg(best).select(
        "words", "a", "lang", "n", "best.l", "best.r", "best.score"
    )


def _maximal(phrases: DataFrame, longest: int) -> DataFrame:
    """Phrases that no longer one holds as often.

    If a longer phrase holds one as often, so does every phrase between them, and one of these is a word longer.
    """
    inner = F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))
    held = (
        phrases.where(F.size("words") > 2)
        .select(F.explode(inner).alias("words"), F.col("n").alias("longer"))
        .groupBy("words")
        .agg(F.max("longer").alias("longer"))
    )
    kept = phrases.join(held, "words", "left")
    return kept.where(F.col("longer").isNull() | (F.col("longer") < F.col("n"))).select("words", "n")


def collocations(
    docs: DataFrame, *, most: int = 2000, longest: int = 5, least: int = 100, **options
) -> DataFrame:
    """The ``most`` phrases of highest score per language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z and split at ``.,;:!?`` and line ends into pieces, these at blanks into words. A phrase is
    2 to ``longest`` words that stand together in pieces of a language ``least`` times or more (a); n are all
    its words. Cut in two parts that occur l and r times, it scores floor(1000 a n / (l r)) at its lowest cut. Phrases
    inside a longer one that occurs as often are left out. Order: score, a, both descending, phrase.

    Null languages count as ``und``, null texts as empty; repeated rows count each; an empty table gives no rows; ids
    and further columns are not read. Hot words and languages are combined within tasks before every shuffle, and
    only suffixes of frequent pairs are shuffled.
    """
    words, phrases = phrase_counts(docs, longest=longest, least=least, **options)
    kept = _maximal(phrases, longest)
    scored = written(_cut_scores(words, phrases, longest).join(kept.select("words"), "words", "left_semi"), "scored")
    better = "partition by lang order by score desc, a desc"
    near_top = scored.withColumn("place", F.expr(f"rank() over ({better})")).where(F.col("place") <= most)
    spelled = (
        near_top.select("*", F.posexplode("words").alias("pos", "h"))
        .join(words.where("not total").select("h", F.col("word").cast("string").alias("word")), "h")
        .groupBy("words", "lang", "a", "l", "r", "n", "score")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("parts"))
        .withColumn("phrase", F.array_join("parts.word", " "))
    )
    rank = F.expr("row_number() over (partition by lang order by score desc, a desc, phrase)")
    return (
        spelled.withColumn("rank", rank.cast("long"))
        .where(F.col("rank") <= most)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
