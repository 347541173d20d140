"""Language identification of mixed-language texts.

Method: the script of a word, by code point ranges, narrows its candidate languages. Each word
gets a score per language from character n-grams and from the word itself. Viterbi over a
text's words with a penalty for switching labels its spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sheetmill.llm.common import small_batches

#: First code point and script of ranges of letters (Unicode blocks).
SCRIPTS = (
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0900, "Devanagari"),
    (0x0980, "Indic"),
    (0x0E00, "Thai"),
    (0x0E80, "Other"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Other"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "Other"),
    (0x3040, "Kana"),
    (0x3100, "Han"),
    (0xA000, "Other"),
    (0xAC00, "Hangul"),
    (0xD7B0, "Other"),
    (0xF900, "Han"),
    (0xFB00, "Other"),
    (0xFF66, "Kana"),
    (0xFFA0, "Other"),
    (0x20000, "Han"),
)
UNKNOWN = "und"

_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([start for start, _ in SCRIPTS])
_CODES = np.array([_NAMES.index(name) for _, name in SCRIPTS])
_WORD = re.compile(r"[^\W\d_]+")
#: N-grams and words are hashed to so many features, which bounds the model.
FEATURES = 1 << 17
_OPEN, _CLOSE = 2, 3


def _grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of ``words``, and the index of the word each belongs to."""
    text = "".join([f"\x02{w}\x03" for w in words])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.cumsum(points == _OPEN) - 1
    nxt = np.append(points[1:], [np.uint64(0)])
    third = np.append(nxt[1:], [np.uint64(0)])
    inner = points != _CLOSE
    one, two = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    pairs = (points * one + nxt) * two
    triples = (pairs + third) * one
    wide = inner & (nxt != _CLOSE)
    # The whole word: a polynomial over its code points.
    starts = np.flatnonzero(points == _OPEN)
    place = np.arange(len(points)) - starts[owner]
    power = np.cumprod(np.full(int(place.max()) + 1, one, np.uint64)) if len(place) else place
    whole = np.add.reduceat(points * power[place], starts) if len(starts) else points[:0]
    hashes = np.concatenate([pairs[inner], triples[wide], whole * two + np.uint64(1)])
    hashes ^= hashes >> np.uint64(29)
    hashes *= one
    features = (hashes >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)
    return features, np.concatenate([owner[inner], owner[wide], np.arange(len(starts))])


def _scripts(words: np.ndarray) -> np.ndarray:
    first = np.array([ord(w[0]) for w in words], np.int64)
    return _CODES[np.searchsorted(_STARTS, first, "right") - 1]


def _split(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


@dataclass(frozen=True)
class LanguageModel:
    """``weights``: log probability by feature and language. ``allowed``: by script and language."""

    languages: tuple[str, ...]
    weights: np.ndarray
    allowed: np.ndarray

    def scores(self, words: np.ndarray) -> np.ndarray:
        """One row per distinct word, one column per language."""
        if not len(words):
            return np.zeros((0, len(self.languages)))
        features, owner = _grams(words)
        # An n-gram's evidence is shared by the n-grams that overlap it.
        found = np.stack(
            [np.bincount(owner, self.weights[features, k], len(words)) for k in range(len(self.languages))], 1
        )
        return found / 3 + self.allowed[_scripts(words)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        frame = pd.DataFrame({"lang": batch.column("lang").to_pylist(), "text": batch.column("text").to_pylist()})
        for lang, texts in frame.groupby("lang")["text"]:
            words = np.array([w for t in texts for w in _split(t)], object)
            if not len(words):
                continue
            names, times = np.unique(words, return_counts=True)
            features, owner = _grams(names)
            sums = np.bincount(features, times[owner], FEATURES)
            used = np.flatnonzero(sums)
            scripts = np.bincount(_scripts(names), times, len(_NAMES))
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [lang] * (len(used) + len(_NAMES)),
                    "feature": np.concatenate([used, -1 - np.arange(len(_NAMES))]),
                    "n": np.concatenate([sums[used], scripts]).astype(np.int64),
                }
            )


def train(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    order: Column | None = None,
    most_per_language: int = 2000,
    least_share: float = 0.001,
) -> LanguageModel:
    """Learn from labelled texts; rows without text or language are left out.

    Up to about ``most_per_language`` texts of a language are read, whole, chosen by a hash of
    ``order`` (by default the text). Counts are summed by Spark; the driver gets at most
    ``FEATURES`` numbers per language. A script is closed to a language whose words use it
    less often than ``least_share``.
    """
    small_batches(docs.sparkSession)
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    labelled = docs.where(text.isNotNull() & lang.isNotNull()).select(
        lang.alias("lang"),
        text.alias("text"),
        F.shiftrightunsigned(F.xxhash64(order if order is not None else text), 11).alias("place"),
    )
    totals = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(totals))
    if not languages:
        return LanguageModel((), np.zeros((FEATURES, 0)), np.zeros((len(_NAMES), 0)))
    # Hash thresholds choose the rows without a sort; the square root leaves room for chance.
    n = F.element_at(F.create_map(*[F.lit(x) for kv in totals.items() for x in kv]), F.col("lang"))
    bound = most_per_language
    room = max(0.0, bound - 3 * bound**0.5)
    sample = labelled.where((n <= bound) | (F.col("place") < room / n * float(1 << 53)))
    counted = (
        sample.select("lang", "text")
        .mapInArrow(_counts, "lang string, feature long, n long")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    column = {lang: k for k, lang in enumerate(languages)}
    counts = np.zeros((FEATURES, len(languages)))
    scripts = np.zeros((len(_NAMES), len(languages)))
    for lang, part in counted.groupby("lang"):
        at, times = part["feature"].to_numpy(), part["n"].to_numpy()
        counts[at[at >= 0], column[lang]] = times[at >= 0]
        scripts[-1 - at[at < 0], column[lang]] = times[at < 0]
    smooth = 0.2
    weights = np.log((counts + smooth) / (counts.sum(0) + smooth * FEATURES))
    used = scripts >= np.maximum(least_share * scripts.sum(0), 1)
    closed = ~used & used.any(1, keepdims=True)  # a script of no language is open to all
    return LanguageModel(languages, weights.astype(np.float32), np.where(closed, -30.0, 0.0))


def best_paths(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """Viterbi labels of sequences of (words, languages) scores, all sequences in step."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    if not len(order) or not lengths[0]:
        return [np.zeros(0, np.int64) for _ in scores]
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")
    offsets = np.concatenate([[0], np.cumsum(active)])
    n_langs = scores[order[0]].shape[1]
    # Word t of all sequences that have one lies together.
    laid = np.empty((offsets[-1], n_langs))
    places = []
    for rank, i in enumerate(order):
        at = offsets[: lengths[rank]] + rank
        laid[at] = scores[i]
        places.append(at)
    best = np.zeros(offsets[-1], np.int16)
    stay = np.ones((offsets[-1], n_langs), bool)
    value = laid[: active[0]].copy()
    last = np.empty(len(order), np.int64)
    for t in range(1, lengths[0]):
        n = active[t]
        if n < len(value):
            last[n : len(value)] = value[n:].argmax(1)
            value = value[:n]
        at = slice(offsets[t], offsets[t + 1])
        top = value.argmax(1)
        switched = value[np.arange(n), top] - penalty
        keep = value >= switched[:, None]
        best[at], stay[at] = top, keep
        value = np.where(keep, value, switched[:, None]) + laid[at]
    last[: len(value)] = value.argmax(1)
    labels: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
    current = last
    path = np.empty(offsets[-1], np.int64)
    for t in range(lengths[0] - 1, -1, -1):
        n, at = active[t], slice(offsets[t], offsets[t + 1])
        path[at] = current[:n]
        if t:
            kept = stay[at][np.arange(n), current[:n]]
            current[:n] = np.where(kept, current[:n], best[at])
    for rank, i in enumerate(order):
        labels[i] = path[places[rank]]
    return labels


def label_texts(
    model: LanguageModel, texts: list[str | None], penalty: float, spans: bool
) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, share of letters, spans) of each text."""
    split = [_split(t) for t in texts]
    lengths = [len(words) for words in split]
    codes, names = pd.factorize(np.array([w for words in split for w in words], object))
    names = np.asarray(names, object)
    scores = model.scores(names) if model.languages else np.zeros((len(names), 0))
    letters = np.array([sum(map(str.isalpha, w)) for w in names], np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    own = [codes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    if model.languages:
        paths = best_paths([scores[c] for c in own], penalty)
    else:
        paths = [np.zeros(0, np.int64) for _ in own]
    found = []
    for text, words, path in zip(texts, own, paths):
        sums = np.bincount(path, letters[words], len(model.languages)) if len(path) else np.zeros(0)
        if not sums.sum():
            found.append((UNKNOWN, 0.0, []))
            continue
        top = int(sums.argmax())
        marked: list[tuple[int, int, str]] = []
        if spans:
            turns = np.flatnonzero(np.diff(path)) + 1
            places = [m.span() for m in _WORD.finditer(text.lower())]
            for a, b in zip([0, *turns], [*turns, len(path)]):
                marked.append((places[a][0], places[b - 1][1], model.languages[path[a]]))
        found.append((model.languages[top], float(sums[top] / sums.sum()), marked))
    return found


def _in_parts(texts: list[str | None], most: int = 1 << 21) -> Iterator[list[int]]:
    """Numbers of the texts, in parts of about ``most`` characters; texts of like length together,
    since a part takes as many steps as its longest text has words."""
    part, size = [], 0
    for k in sorted(range(len(texts)), key=lambda k: len(texts[k] or "")):
        part.append(k)
        size += len(texts[k] or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def language_column(text: Column, model: LanguageModel, *, penalty: float = 8.0, spans: bool = True) -> Column:
    """Struct (lang, score, spans: array of (start, end, lang)) of a text column.

    ``lang`` is the language with most letters, the smaller name on ties; ``score`` its share of
    the letters. ``lang`` is ``und``, with a score of 0 and no spans, if the text is null or has
    no letter, or if nothing was learned. Spans are code points of the lower-cased text, cover
    whole words, and do not overlap. A task holds one batch of texts, and works on two million
    characters or one text at a time.
    """
    schema = "lang string, score double, spans array<struct<start: int, end: int, lang: string>>"

    @F.pandas_udf(schema)
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            texts = list(series)
            rows: list = [None] * len(texts)
            for part in _in_parts(texts):
                for k, row in zip(part, label_texts(model, [texts[k] for k in part], penalty, spans)):
                    rows[k] = row
            yield pd.DataFrame(
                {
                    "lang": [r[0] for r in rows],
                    "score": [r[1] for r in rows],
                    "spans": [[{"start": a, "end": b, "lang": x} for a, b, x in r[2]] for r in rows],
                }
            )

    return label(text.cast("string"))


def identify(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 5,
    **options,
) -> DataFrame:
    """Predict the language of every text, learning outside the held-out fold only.

    A row is held out if the checksum of its id as text is divisible by ``folds``; a null id
    is held out, too. The language column serves learning only. Returns one row per input row:
    doc_id, held_out, lang_pred, score. Repeated rows are predicted alike; an empty table gives no
    rows; further columns are not read. Texts are read where they lie, without a shuffle.
    """
    remainder = F.crc32(F.col(id_col).cast("string")) % folds
    held_out = F.coalesce(remainder == 0, F.lit(True))
    model = train(
        docs.where(~held_out), text_col=text_col, lang_col=lang_col, order=F.col(id_col).cast("string")
    )
    small_batches(docs.sparkSession, 2000)
    labelled = language_column(F.col(text_col), model, spans=False, **options)
    return docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), labelled.alias("r")).select(
        "doc_id", "held_out", F.col("r.lang").alias("lang_pred"), F.col("r.score").alias("score")
    )
