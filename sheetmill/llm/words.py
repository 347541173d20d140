"""Words of whole batches of texts as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that end a word but not a piece, and bytes that end both.
BLANKS = b"\x20\x09"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"

#: Bytes of A-Z in lower case, all others as they are.
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


@dataclass(frozen=True)
class Words:
    """The words of a batch, in order.

    ``codes`` are places in ``names``, the distinct words; ``starts`` and ``ends`` are byte offsets in
    ``data``, which holds the texts with one line feed after each; ``firsts`` has for every text, and
    at last for all, the number of words before it; ``bounds`` the same in bytes.
    """

    data: np.ndarray
    codes: np.ndarray
    names: pa.BinaryArray
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray
    bounds: np.ndarray

    def texts_of_words(self) -> np.ndarray:
        """For every word the number of its text."""
        return np.repeat(np.arange(len(self.firsts) - 1), np.diff(self.firsts))


def split_words(texts: pa.Array, spaces: bytes, *, lower: bool = False) -> Words:
    """Split ``texts`` (strings without nulls) at the bytes ``spaces``, which include a line feed."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined = "\n".join([*texts.to_pylist(), ""]).encode()
    data = np.frombuffer(joined, np.uint8)
    if lower:
        data = LOWER[data]
    is_space = np.zeros(256, bool)
    is_space[list(spaces)] = True
    inside = ~is_space[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edges[::2], edges[1::2]  # the last byte is a line feed
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    packed = pa.py_buffer(np.ascontiguousarray(data[inside]))
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), packed])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    firsts = np.searchsorted(starts, bounds)
    return Words(data, codes, coded.dictionary, starts, ends, firsts, bounds)


def by_size(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes; a longer text is a batch of its own at most."""
    held: list[pa.RecordBatch] = []
    held_bytes = 0
    for batch in batches:
        rows = max(1, int(size * batch.num_rows / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            held.append(part)
            held_bytes += part.nbytes
            if held_bytes >= size:
                yield pa.concat_batches(held)
                held, held_bytes = [], 0
    if held:
        yield pa.concat_batches(held)
