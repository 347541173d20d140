"""Periodic runs: stretches of words that repeat with one period.

Method: a dictionary of basic factors names every factor of a power-of-two length that occurs
more than once in its text, so that equal names mean equal words. Occurrences of a factor of L words that
follow each other at L / 2 words or less form an arithmetic progression. From a progression and the next
ones within 2 L words, the distances of an occurrence to a progression's head, and of a tail to a
tail, propose the periods from L up to 2 L. Every proposal is extended to both sides by the names of
ever shorter factors, and equal stretches count once, with their least period.

No period is missed. Take a run from s of period q, L <= q < 2 L, at least 2 q long: the factors of L words at s and at
s + q are equal. If s + q is a head, it is proposed from s. Otherwise the words before s + q have the
progression's period p, and s, before which the run breaks off, is a head itself. The words from s on must break
period p before the run's last q words do, else the run had both periods, and so a period
below q. Both progressions then end at the same place in their copy, and their tails are q apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sheetmill.llm.common import small_batches, text_or_empty
from sheetmill.llm.words import SPACES, Words, by_size, split_words

RUNS = "array<struct<start: long, length: long, period: long>>"

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the keys that occur more than once (-1 for the others), and the places of these
    keys in order of (name, place)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    repeated = (np.bincount(group) > 1)[group] if len(keys) else np.zeros(0, bool)
    names = np.full(len(keys), -1, np.int32)
    names[order] = np.where(repeated, group, -1)
    return names, order[repeated]


def basic_factors(codes: np.ndarray, texts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level k: names of the factors of 2**k words that repeat within their text, by their first
    word (-1: occurs once), and their places by (name, place). Ends with the last level that has any."""
    levels = []
    if not len(codes):
        return levels
    names, places = _names(texts * (codes.max() + 1) + codes)
    size = 1
    while len(places):
        levels.append((names, places))
        # Only where both halves repeat can the whole do so.
        left = np.sort(places)
        left = left[left + size < len(codes)]
        right = left + size
        both = (names[right] >= 0) & (texts[left] == texts[right])
        left, right = left[both], right[both]
        own, order = _names(names[left].astype(np.int64) * (len(codes) + 1) + names[right])
        names = np.full(len(codes), -1, np.int32)
        names[left] = own
        places = left[order]
        size *= 2
    return levels


def _proposals(names: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods from ``size`` up to twice that, from the occurrences of each factor."""
    own = names[places]
    same = own[1:] == own[:-1]
    near = same & (2 * np.diff(places) <= size)
    head = np.concatenate([[True], ~near])
    tail = np.concatenate([~near, [True]])
    found_at, found = [], []
    for marks, from_all in ((head, True), (tail, False)):
        ends = np.flatnonzero(marks)
        sources = np.arange(len(places)) if from_all else ends
        # Marked occurrences after each source; more than size / 2 lies between two of them.
        after = np.cumsum(marks)[sources]
        for step in range(5):
            which = after + step
            sources, after, which = (x[which < len(ends)] for x in (sources, after, which))
            target = ends[which]
            distance = places[target] - places[sources]
            within = (own[target] == own[sources]) & (distance < 2 * size)
            sources, after, distance = sources[within], after[within], distance[within]
            if not len(sources):
                break
            enough = distance >= size
            found_at.append(places[sources[enough]])
            found.append(distance[enough])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, period = np.concatenate(found_at), np.concatenate(found)
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    # Neighbours that propose the same period lie in the same stretch.
    fresh = np.ones(len(at), bool)
    fresh[1:] = (period[1:] != period[:-1]) | (at[1:] > at[:-1] + 1)
    return at[fresh], period[fresh]


def _reach(levels: list, at: np.ndarray, to: np.ndarray, backwards: bool) -> np.ndarray:
    """How many words from ``at`` on (or before it) equal those from ``to`` on (or before it)."""
    length = np.zeros(len(at), np.int64)
    for k in reversed(range(len(levels))):
        names, step = levels[k][0], 1 << k
        a, b = (at - length - step, to - length - step) if backwards else (at + length, to + length)
        fits = (a >= 0) & (b < len(names))
        left, right = names[np.where(fits, a, 0)], names[np.where(fits, b, 0)]
        length += np.where(fits & (left >= 0) & (left == right), step, 0)
    return length


def find_runs(words: Words, least: int) -> np.ndarray:
    """Rows (first word, word after the last, period) by first word and period; words are counted
    over the whole batch."""
    levels = basic_factors(words.codes, words.texts_of_words())
    found = [np.zeros((0, 3), np.int64)]
    for k, (names, places) in enumerate(levels):
        at, period = _proposals(names, places, 1 << k)
        start = at - _reach(levels, at, at + period, backwards=True)
        end = at + period + _reach(levels, at, at + period, backwards=False)
        long = end - start >= np.maximum(least, 2 * period)
        found.append(np.stack([start[long], end[long], period[long]], axis=1))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(words: Words, runs: np.ndarray) -> pa.Array:
    """The texts without the words that a run repeats, the others joined by one space."""
    n = len(words.codes)
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(covered)[:n] == 0)
    texts = words.texts_of_words()[kept]
    opens = np.ones(len(kept), bool)
    opens[1:] = texts[1:] != texts[:-1]
    # A word takes the byte before it along, as its space, unless it opens its text.
    begin = words.starts[kept] - ~opens
    edges = np.zeros(len(words.data) + 1, np.int8)
    edges[begin] += 1
    edges[words.ends[kept]] -= 1
    taken = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    data = words.data.copy()
    data[begin[~opens]] = 0x20
    before = np.concatenate([[0], np.cumsum(taken)])[words.bounds].astype(np.int32)
    out = pa.py_buffer(np.ascontiguousarray(data[taken]))
    return pa.StringArray.from_buffers(len(before) - 1, pa.py_buffer(before), out)


def periodic_runs(
    docs: DataFrame,
    *,
    text: Column | None = None,
    id_col: str = "doc_id",
    least: int = 12,
    batch_bytes: int = 4 << 20,
) -> DataFrame:
    """Every run of words in every text, and the texts without the repetitions.

    Words are stretches without white space. A run is a stretch of words with least period q (words q apart are
    the same), at least ``least`` and 2 q words long, that no neighbouring word extends. Returns one row
    per input row: doc_id, n_words, runs (start, length and period in words, by start and period), collapsed
    (the text without the words that any run holds after its first q, joined by single spaces).

    Null and empty texts have no words, no runs and an empty ``collapsed``; null ids and repeated rows are
    kept, each row by itself; an empty table gives no rows; further columns are not read.
    Nothing is shuffled: a task holds about ``batch_bytes`` of texts, or a single longer one, and one name
    a word and level for it.
    """
    small_batches(docs.sparkSession)
    given = F.col("text") if text is None else text

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, batch_bytes):
            words = split_words(batch.column("text"), SPACES)
            runs = find_runs(words, least)
            own = np.searchsorted(words.firsts, runs[:, 0], side="right") - 1
            start = runs[:, 0] - words.firsts[own]
            parts = [start, runs[:, 1] - runs[:, 0], runs[:, 2]]
            spans = pa.StructArray.from_arrays([pa.array(p) for p in parts], fields=list(_RUN))
            offsets = np.searchsorted(own, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(words.firsts)),
                    pa.ListArray.from_arrays(pa.array(offsets), spans),
                    _collapsed(words, runs),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(given).alias("text"))
    return rows.mapInArrow(scan, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
