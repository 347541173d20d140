"""Token ids as directly addressable codes.

Method: an id is split into chunks of eight bits. Level k holds chunk k of every id that has
one, and a bitmap that says which of them go on to level k + 1. A rank directory over each
bitmap gives an id's place on the next level, so any id is read without decoding its block.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from sheetmill.llm.common import small_batches, text_or_empty
from sheetmill.session import scratch_path

#: Bits of a bitmap that one entry of its rank directory covers.
BLOCK = 512

#: The parts a table is written in at most; their offsets are broadcast.
MOST_PARTS = 100_000

_LEVEL = pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())])
_SEGMENT = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("before", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("levels", pa.list_(_LEVEL)),
    ]
)
#: The file format: one row per segment. `before` counts the ids of earlier segments of a part.
SEGMENT = (
    "part int, segment int, before long, n_tokens long, doc_ids array<bigint>, lengths array<bigint>,"
    " levels array<struct<chunks: binary, more: binary, ranks: binary>>"
)


def to_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of ``ids`` (unsigned, up to 32 bits); no id, no level."""
    levels, rest = [], np.asarray(ids, np.uint32)
    while len(rest):
        more = rest > 0xFF
        bitmap = np.packbits(more, bitorder="little")
        whole = len(rest) // BLOCK
        ones = np.bitwise_count(bitmap[: whole * BLOCK // 8]).reshape(whole, BLOCK // 8).sum(1, np.uint32)
        levels.append(
            {
                "chunks": rest.astype(np.uint8).tobytes(),
                "more": bitmap.tobytes(),
                "ranks": np.concatenate([[0], np.cumsum(ones)]).astype("<u4").tobytes(),
            }
        )
        rest = rest[more] >> np.uint32(8)
    return levels


def token_at(levels: list[dict[str, bytes]], i: int) -> int:
    """Id number ``i`` of a segment, by one chunk and one rank per level."""
    value = 0
    for k, level in enumerate(levels):
        value |= level["chunks"][i] << (8 * k)
        more = level["more"]
        if not more[i >> 3] >> (i & 7) & 1:
            break
        block = i // BLOCK
        rank = int.from_bytes(level["ranks"][4 * block : 4 * block + 4], "little")
        low = block * BLOCK // 8
        within = int.from_bytes(more[low : (i >> 3) + 1], "little") & ((1 << (i - block * BLOCK)) - 1)
        i = rank + within.bit_count()
    return value


def from_levels(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment."""
    ids = np.zeros(0, np.uint32)
    for k in reversed(range(len(levels))):
        chunks = np.frombuffer(levels[k]["chunks"], np.uint8).astype(np.uint32)
        if k + 1 < len(levels):
            bits = np.frombuffer(levels[k]["more"], np.uint8)
            more = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            chunks[more] |= ids << np.uint32(8)
        ids = chunks
    return ids


#: White space as the pre-tokenizer sees it, for regular expressions.
_SPACES = (
    r"\t\n\x0b\x0c\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def _joined(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` of these starts and sizes, one after the other."""
    before = np.cumsum(sizes) - sizes
    shift = np.repeat(starts - before, sizes)
    return pool[np.arange(len(shift)) + shift]


class Words:
    """Encodes texts through the library, each distinct word once.

    The pre-tokenizer never joins a visible character with white space after it, and gives a space
    to the visible character that follows. So a text whose spaces all stand alone may be cut
    before each of them, and the ids of the parts are those of the whole. Other texts are
    encoded whole. A run of letters ends where punctuation follows, so words are cut there, too, and
    only the two parts are remembered. A run of letters is one word to the pre-tokenizer and goes to the library's model
    as it is. What two times ``most`` new parts did not meet again is forgotten.
    """

    _odd = f" ([{_SPACES}]|$)"
    _letters = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
    _cut = r"(?s)^(?P<head> ?[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-@\[-`{-~].*)?$"

    def __init__(self, path: str, most: int = 250_000):
        self._tokenizer, self._most = Tokenizer.from_file(path), most
        self._model = self._tokenizer.model
        # How the pre-tokenizer writes the bytes of letters and the space before them.
        shown = {c: self._shown(c) for c in {" ", *map(chr, range(0xC0, 0x100))}}
        self._bytes = str.maketrans({c: w for c, w in shown.items() if c != w})
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _shown(self, char: str) -> str:
        return "".join(word for word, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(char))

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = []
        for at in range(0, len(texts), 10_000):
            some = self._tokenizer.encode_batch_fast(texts[at : at + 10_000], add_special_tokens=False)
            found += [np.asarray(f.ids, "<u4").tobytes() for f in some]
        return found

    def _encode_new(self, parts: list[str]) -> None:
        known, rest = self._new, []
        letters, tokenize, names = self._letters.fullmatch, self._model.tokenize, self._bytes
        space = " ".translate(names)
        for part in parts:
            if letters(part):
                shown = part.replace(" ", space) if part.isascii() else part.translate(names)
                known[part] = array("I", [t.id for t in tokenize(shown)]).tobytes()
            else:
                rest.append(part)
        known.update(zip(rest, self._ids(rest)))

    def _learn(self, parts: list[str]) -> list[bytes]:
        """Ids of each of ``parts``, which are distinct."""
        if len(self._new) > self._most:
            self._new, self._old = {}, self._new
        coded = list(map(self._new.get, parts))
        missing = [k for k, ids in enumerate(coded) if ids is None]
        unknown = []
        for k in missing:
            part = parts[k]
            ids = self._old.get(part)
            if ids is None:
                unknown.append(part)
            else:
                self._new[part] = ids
        self._encode_new(unknown)
        for k in missing:
            coded[k] = self._new[parts[k]]
        return coded

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of distinct words, and where each word's begin and how many they are."""
        cut = pc.extract_regex(words, self._cut)
        head = pc.coalesce(pc.struct_field(cut, "head"), words)  # a word that begins otherwise stays whole
        tail = pc.coalesce(pc.struct_field(cut, "tail"), pa.scalar("", words.type))
        coded = pa.concat_arrays([head, tail]).dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False).reshape(2, -1).T
        found = self._learn(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), "<u4")
        starts = (np.cumsum(sizes) - sizes)[place]
        own = sizes[place].sum(axis=1)
        return _joined(pool, starts.ravel(), sizes[place].ravel()), np.cumsum(own) - own, own

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and for every text, and at last for all, the number of ids before it."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        odd = pc.match_substring_regex(texts, self._odd).to_numpy(zero_copy_only=False)
        whole, plain = np.flatnonzero(odd), np.flatnonzero(~odd)
        own = [np.frombuffer(ids, "<u4") for ids in self._ids(texts.take(pa.array(whole)).to_pylist())]
        sizes = np.zeros(len(texts), np.int64)
        sizes[whole] = list(map(len, own))
        ids = np.zeros(0, np.uint32)
        if len(plain):
            parts = pc.split_pattern(texts.take(pa.array(plain)), " ")
            offsets = parts.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            words = parts.flatten().dictionary_encode()
            place = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            first = offsets[:-1]
            openings, where = np.unique(place[first], return_inverse=True)
            spaced = pc.binary_join_element_wise("", words.dictionary, " ")
            opening = words.dictionary.take(pa.array(openings))
            place[first] = len(spaced) + where
            pool, starts, lengths = self._distinct(pa.concat_arrays([spaced, opening]))
            ids = _joined(pool, starts[place], lengths[place])
            upto = np.concatenate([[0], np.cumsum(lengths[place])])[offsets]
            sizes[plain] = np.diff(upto)
        before = np.concatenate([[0], np.cumsum(sizes)])
        if len(whole):
            # Texts encoded whole are put between the others.
            source = np.concatenate([ids, *own])
            starts = np.zeros(len(texts), np.int64)
            starts[plain] = np.cumsum(sizes[plain]) - sizes[plain]
            starts[whole] = len(ids) + np.cumsum(sizes[whole]) - sizes[whole]
            ids = _joined(source, starts, sizes)
        return ids, before


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    """One per process."""
    return Words(path)


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def write_codes(
    docs: DataFrame,
    tokenizer_path: str,
    path: str,
    *,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_rows: int = 8192,
    segment_tokens: int = 1 << 20,
    batch_bytes: int = 12 << 20,
) -> None:
    """Encode every text and write its ids, ``end_id`` last, in ascending id order to ``path``.

    Files hold one row per segment (``SEGMENT``), parts in ascending order. Null texts count as
    empty and give the end id only; null ids come first; rows that repeat an id are ordered by
    their text's hash; an empty table gives a table without rows. Further columns are not read.

    Texts are shuffled once, by ranges of (id, hash). A task holds one batch of texts, about
    ``batch_bytes``, and one segment of ids.
    """
    small_batches(docs.sparkSession)
    parts = min(MOST_PARTS, max(1, -(-docs.count() // part_rows)))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer_path)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []  # document ids, lengths, tokens

        def flush():
            nonlocal number, before, held
            tokens = np.concatenate([t for _, _, t in held])
            row = {
                "part": part,
                "segment": number,
                "before": before,
                "n_tokens": len(tokens),
                "doc_ids": [d for ids, _, _ in held for d in ids],
                "lengths": np.concatenate([n for _, n, _ in held]).tolist(),
                "levels": to_levels(tokens),
            }
            number, before, held = number + 1, before + len(tokens), []
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENT)

        size = 0
        for batch in _gathered(batches, batch_bytes):
            ids, upto = words.encode(batch.column("text"))
            lengths = np.diff(upto) + 1
            tokens = np.insert(ids, upto[1:], np.uint32(end_id))
            upto = np.concatenate([[0], np.cumsum(lengths)])
            names, at = batch.column("id").to_pylist(), 0
            while at < len(names):
                # As many documents as make the segment full.
                last = int(np.searchsorted(upto, upto[at] + segment_tokens - size))
                last = min(max(last, at + 1), len(names))
                held.append((names[at:last], lengths[at:last], tokens[upto[at] : upto[last]]))
                size += int(upto[last] - upto[at])
                at = last
                if size >= segment_tokens:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    text = text_or_empty(F.col(text_col))
    order = [F.col("id"), F.xxhash64("text")]
    (
        docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(segments, SEGMENT)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the written files: doc_id, start (ids before it in all files), n_tokens, and
    ids (little-endian unsigned 32-bit integers)."""
    coded = spark.read.schema(SEGMENT).parquet(path)
    # One row per part, MOST_PARTS at most.
    totals = coded.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_levels(row["levels"]).astype("<u4")
                ends = np.cumsum(row["lengths"], dtype=np.int64)
                starts = ends - np.asarray(row["lengths"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(ends), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts + row["before"]),
                        pa.array(ends - starts),
                        pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    ],
                    names=["part", "doc_id", "first", "n_tokens", "ids"],
                )

    return (
        coded.select("part", "before", "doc_ids", "lengths", "levels")
        .mapInArrow(documents, "part int, doc_id long, first long, n_tokens long, ids binary")
        .join(F.broadcast(offsets), "part")
        .select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids")
    )


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """Single ids of the written files: (position, id) for each distinct ``position`` among all ids.

    Positions beyond the last id, negative and null ones give no row. A position meets its segment by an equi-join on
    stretches of 2**20 positions; of a segment only the chunks, bitmap and rank bytes on the way to
    its id are looked at, and segments without a position are not decoded.
    """
    stretch = 20
    coded = spark.read.schema(SEGMENT).parquet(path)
    sizes = coded.select("part", "segment", "before", "n_tokens")
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per part, MOST_PARTS at most
    offsets = totals.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset"))
    placed = sizes.join(F.broadcast(offsets), "part").withColumn("first", F.col("offset") + F.col("before"))
    last = F.col("first") + F.col("n_tokens") - 1
    covered = F.sequence(F.shiftright("first", stretch), F.shiftright(last, stretch))
    placed = placed.where("n_tokens > 0").select("part", "segment", "first", "n_tokens", F.explode(covered).alias("at"))
    wanted = positions.select(F.col("position").cast("long").alias("position")).distinct()
    inside = (F.col("position") >= F.col("first")) & (F.col("position") < F.col("first") + F.col("n_tokens"))
    found = wanted.withColumn("at", F.shiftright("position", stretch)).join(placed, "at").where(inside)
    # A segment has so many positions at most.
    asked = found.groupBy("part", "segment", "first").agg(F.collect_list("position").alias("positions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = [token_at(row["levels"], p - row["first"]) for p in row["positions"]]
                columns = [pa.array(row["positions"], pa.int64()), pa.array(ids, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["position", "id"])

    segments = coded.select("part", "segment", "levels").join(asked, ["part", "segment"])
    return segments.select("first", "positions", "levels").mapInArrow(read, "position long, id long")


def token_codes(docs: DataFrame, tokenizer_path: str, *, end_id: int, **options) -> DataFrame:
    """Write ``docs`` as codes below the shared folder and read the files back."""
    path = scratch_path(docs.sparkSession, "codes")
    write_codes(docs, tokenizer_path, path, end_id=end_id, **options)
    return read_codes(docs.sparkSession, path)
