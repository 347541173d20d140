"""BPE encoding over a trie of distinct words.

Method: the encoding of a word ends with one token, and what comes before that token is the encoding of
the shorter prefix. So one token per prefix describes the encodings of all prefixes of a word, and a
trie of distinct words needs one token per node, its state: of the tokens that end there, the one that may
follow the state of the node where it begins. The trie is walked depth first, which is the
sorted order of the words: going on to the next word keeps the states of the prefix it shares.
A word's ids are read from its end, from state to state.

Two tokens may stand side by side if merging their bytes gives just these two; that is settled by the
tokens along the seam alone, and remembered per pair.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from sheetmill.llm.common import small_batches, text_or_empty
from sheetmill.llm.words import by_size

#: Fixed value: the byte-level pre-tokenizer's pattern.
SPLIT = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

#: Below this character the classes in ``SPLIT`` do not depend on the version of Unicode.
SETTLED = "\u0530"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1 characters stand
    for themselves, the other bytes, in order, for the characters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model, split = stored["model"], stored["pre_tokenizer"]
        plain = {"dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None}
        if model["type"] != "BPE" or any(model.get(k) for k in (*plain, "ignore_merges", "byte_fallback")):
            raise ValueError(f"{path} is no plain byte-level BPE")
        if split["type"] != "ByteLevel" or split["add_prefix_space"] or stored["normalizer"]:
            raise ValueError(f"{path} changes texts before it splits them")
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        char = byte_of_char()
        ids = model["vocab"]

        def raw(token: str) -> bytes:
            known = all(c in char for c in token)
            return bytes(char[c] for c in token) if known else token.encode()

        #: Bytes by id, for decoding.
        self.bytes: list[bytes] = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, number in [*ids.items(), *self.special.items()]:
            self.bytes[number] = raw(token)
        #: Rank of a merge by the pair of ids, and what a merged id was made of.
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        single = {ids[c] for c in char if c in ids}
        if len(single) < 256:
            raise ValueError(f"{path} has no token for some bytes")
        made = set(single)
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, new = (ids[left], ids[right]), ids[left + right]
            if new in made or not made.issuperset(pair):
                raise ValueError(f"{path} makes a token twice or from later ones")
            made.add(new)
            self.rank[pair], self.parts[new] = rank, pair
        self.made_at = {new: self.rank[pair] for new, pair in self.parts.items()}
        self._follows: dict[int, bool] = {}
        #: Ids by bytes, of the tokens that are their own encoding.
        self.ids = {self.bytes[t]: t for t in made if t in single or self._whole(t)}
        #: Lengths of the tokens that end in two bytes, longest first.
        lengths: dict[bytes, set[int]] = {}
        for token in self.ids:
            lengths.setdefault(token[-2:], set()).add(len(token))
        self.lengths = {end: tuple(sorted({*some, 1}, reverse=True)) for end, some in lengths.items()}

    @lru_cache(maxsize=None)
    def _seam(self, token: int, right: bool) -> tuple[tuple[int, float], ...]:
        """The tokens at an end of ``token`` from a byte up to itself, each with the rank at which it
        goes on into the next."""
        chain = [token]
        while chain[-1] in self.parts:
            chain.append(self.parts[chain[-1]][right])
        chain.reverse()
        return tuple((t, self.made_at[up]) for t, up in zip(chain, chain[1:])) + ((token, float("inf")),)

    def follows(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens together are encoded as these two."""
        key = left << 32 | right
        known = self._follows.get(key)
        if known is None:
            known = self._follows[key] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        ours, theirs = self._seam(left, True), self._seam(right, False)
        i = k = 0
        while True:
            (a, a_next), (b, b_next) = ours[i], theirs[k]
            across = self.rank.get((a, b))
            # Of merges of one rank the first in the text comes first.
            if across is not None and across < a_next and across <= b_next:
                return False
            if a_next <= b_next:
                if a_next == float("inf"):
                    return True
                i += 1
            else:
                k += 1

    @lru_cache(maxsize=None)
    def _whole(self, token: int) -> bool:
        """Whether a merged token is the encoding of its own bytes."""
        left, right = self.parts[token]
        if any(p in self.parts and not self._whole(p) for p in (left, right)):
            return False
        ours, theirs = self._seam(left, True), self._seam(right, False)
        i = k = 0
        while (i, k) != (len(ours) - 1, len(theirs) - 1):
            (a, a_next), (b, b_next) = ours[i], theirs[k]
            across = self.rank.get((a, b))
            if across is not None and across < a_next and across <= b_next:
                return False
            if a_next <= b_next:
                i += 1
            else:
                k += 1
        return True


def encode_trie(vocabulary: Vocabulary, words: Iterable[bytes]) -> dict[bytes, list[int]]:
    """Ids of distinct words; shared prefixes are encoded once."""
    ids, lengths, follows = vocabulary.ids, vocabulary.lengths, vocabulary.follows
    only, size = (1,), [len(b) for b in vocabulary.bytes]
    found: dict[bytes, list[int]] = {}
    before = b""
    state: list[int] = [-1]  # by node of the path: the last token of the prefix
    for word in sorted(words):
        shared = 0
        for a, b in zip(before, word):
            if a != b:
                break
            shared += 1
        del state[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            for length in lengths.get(word[max(0, end - 2) : end], only) if end > 1 else only:
                if length > end:
                    continue
                token = ids.get(word[end - length : end])
                if token is not None and (length == end or follows(state[end - length], token)):
                    state.append(token)
                    break
        own, end = [], len(word)
        while end:
            own.append(state[end])
            end -= size[state[end]]
        own.reverse()
        found[word] = own
        before = word
    return found


class Encoder:
    """Encodes batches of texts; what it found for words and stretches serves later batches, too.

    A space after a visible character always begins a new word, so texts are cut there
    and each distinct stretch is split by the pattern once. What two batches in a row of
    ``most`` new entries did not use is forgotten.
    """

    def __init__(self, path: str, most: int = 250_000):
        self.vocabulary = Vocabulary(path)
        self._library = Tokenizer.from_file(path).pre_tokenizer
        self._special = sorted(self.vocabulary.special, key=len, reverse=True)
        self._most = most
        self._stretches: tuple[dict, dict] = ({}, {})
        self._words: tuple[dict, dict] = ({}, {})
        sizes = np.fromiter(map(len, self.vocabulary.bytes), np.int64)
        self._sizes, self._at = sizes, np.cumsum(sizes) - sizes
        self._pool = np.frombuffer(b"".join(self.vocabulary.bytes), np.uint8)

    def split(self, stretch: str) -> list[str]:
        """The words of a stretch, as the library's pre-tokenizer has them."""
        if stretch.isascii() or max(stretch) < SETTLED:
            return SPLIT.findall(stretch)
        return [stretch[a:b] for _, (a, b) in self._library.pre_tokenize_str(stretch)]

    def _aged(self, kept: tuple[dict, dict]) -> tuple[dict, dict]:
        return ({}, kept[0]) if len(kept[0]) > self._most else kept

    def _encoded(self, stretches: list[str]) -> list[bytes]:
        """Ids of each stretch as little-endian unsigned 32-bit integers."""
        self._stretches, self._words = self._aged(self._stretches), self._aged(self._words)
        (new, old), (new_words, old_words) = self._stretches, self._words
        missing = []
        for s in set(stretches):
            if s not in new:
                if s in old:
                    new[s] = old[s]
                else:
                    missing.append(s)
        parts = list(map(self.split, missing))
        unknown = {}
        for word in {w for p in parts for w in p}:
            if word not in new_words:
                if word in old_words:
                    new_words[word] = old_words[word]
                else:
                    unknown[word.encode()] = word
        for raw, ids in encode_trie(self.vocabulary, unknown).items():
            new_words[unknown[raw]] = np.asarray(ids, "<u4").tobytes()
        for s, p in zip(missing, parts):
            new[s] = b"".join([new_words[w] for w in p])
        return [new[s] for s in stretches]

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Per stretch its number in the list of stretches; per text its first stretch."""
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = parts.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ends_word = np.fromiter((bool(n) and not n[-1].isspace() for n in names), bool, len(names))
        opens = np.ones(len(place), bool)
        opens[1:] = ends_word[place[:-1]]
        at_text = np.zeros(len(place), bool)
        at_text[offsets[:-1]] = True  # every text has a part, if an empty one
        opens |= at_text
        first = np.flatnonzero(opens)
        length = np.diff(np.append(first, len(place)))
        number = place[first]
        strings = [" " + n for n in names]
        seen: dict[str, int] = {}
        for k in np.flatnonzero((length > 1) | at_text[first]):
            a = first[k]
            own = " ".join([names[p] for p in place[a : a + length[k]]])
            own = own if at_text[a] else " " + own
            number[k] = seen.setdefault(own, len(strings) + len(seen))
        return number, np.searchsorted(first, offsets), strings + list(seen)

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        number, firsts, strings = self._cut(texts)
        used, number = np.unique(number, return_inverse=True)
        coded = self._encoded([strings[k] for k in used])
        pool = np.frombuffer(b"".join(coded), "<u4")
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts = np.cumsum(sizes) - sizes
        before = np.concatenate([[0], np.cumsum(sizes[number])])
        shift = np.repeat(starts[number] - before[:-1], sizes[number])
        return pool[np.arange(len(shift)) + shift], before[firsts]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and for every text, and at last for all, the number of ids before it."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        pattern = "|".join(map(re.escape, self._special))
        if not pattern or not pc.any(pc.match_substring_regex(texts, pattern)).as_py():
            return self._plain(texts)
        # Added tokens cut a text wherever they stand; what is between them is split by itself.
        cuts = [re.split(f"({pattern})", t) for t in texts.to_pylist()]
        ids, before = self._plain(pa.array([p for cut in cuts for p in cut[::2]], pa.string()))
        found, at, k = [], [0], 0
        for cut in cuts:
            total = 0
            for part in cut:
                if part in self.vocabulary.special:
                    own = np.asarray([self.vocabulary.special[part]], np.uint32)
                else:
                    own, k = ids[before[k] : before[k + 1]], k + 1
                found.append(own)
                total += len(own)
            at.append(at[-1] + total)
        return np.concatenate(found), np.asarray(at)

    def decode(self, ids: np.ndarray, before: np.ndarray) -> pa.Array:
        """Texts from ids; bytes that are no UTF-8 become replacement characters."""
        sizes = self._sizes[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        shift = np.repeat(self._at[ids] - upto[:-1], sizes)
        data = self._pool[np.arange(len(shift)) + shift]
        bounds = upto[before].astype(np.int32)
        texts = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data))
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            raw = data.tobytes()
            parts = [raw[a:b].decode(errors="replace") for a, b in zip(bounds, bounds[1:])]
            texts = pa.array(parts, pa.string())
        return texts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per process."""
    return Encoder(path)


def trie_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = 8 << 20,
) -> DataFrame:
    """Encode every text by a byte-level BPE file of the tokenizers library, and decode the ids.

    Returns one row per input row: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded (text).
    Ids are those of the library without special tokens around a text; strings of added tokens
    in a text give their id. Null texts count as empty: no ids, an empty text. Null ids and
    repeated rows are kept; an empty table gives no rows; further columns are not read. Nothing is
    shuffled; the file must exist on every executor. A task holds about ``batch_bytes`` of texts, or a single
    longer one, and the words of its last batches.
    """
    small_batches(docs.sparkSession, 2000)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path)
        for batch in by_size(batches, batch_bytes):
            ids, before = own.encode(batch.column("text"))
            bounds = pa.py_buffer((4 * before).astype(np.int32))
            packed = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(before)),
                    pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, bounds, packed]),
                    own.decode(ids, before),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(coded, "doc_id long, n_tokens long, ids binary, decoded string")
