"""Byte-level BPE with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, functions as F

from sheetmill.llm.common import small_batches

#: Between a visible ASCII character and a space, where a match of the split pattern always ends:
#: no match holds white space after anything else.
_SAFE = re.compile(r"(?<=[!-~])(?= )")

@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int) -> Iterator[str]:
    """``text`` in pieces of at least ``size`` characters, cut at safe boundaries only.

    A stretch without a safe boundary stays in one piece, however long it is.
    """
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(enc: tiktoken.Encoding, text: str, piece: int = 1 << 16) -> list[int]:
    ids: list[int] = []
    for part in pieces(text, piece):
        ids.extend(enc.encode_ordinary(part))
    return ids


def bpe_column(text: Column, rank_file: str, pattern: str, *, piece: int = 1 << 16) -> Column:
    """Struct (n_tokens, ids, decoded) of a text column: its ids as little-endian unsigned 32-bit
    integers, and the bytes that these decode to.

    Null counts as empty: no ids and no bytes. Ids are those of the library for the whole text;
    texts above ``piece`` characters are encoded in parts. The rank file must exist on every
    executor. A task holds one batch of texts and their ids.
    """

    @F.pandas_udf("n_tokens long, ids binary, decoded binary")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoding(rank_file, pattern)
        for texts in batches:
            rows = []
            for t in texts:
                ids = encode(enc, t, piece)
                rows.append((len(ids), np.asarray(ids, "<u4").tobytes(), enc.decode_bytes(ids)))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids", "decoded"])

    return coded(F.coalesce(text.cast("string"), F.lit("")))


def bpe_tokens(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    piece: int = 1 << 16,
) -> DataFrame:
    """Encode every text, and decode the ids.

    Returns one row per input row: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers),
    decoded (bytes). Null texts count as empty; null ids and repeated rows are kept; an empty
    table gives no rows; further columns are not read. Nothing is shuffled.
    """
    small_batches(docs.sparkSession)
    coded = bpe_column(F.col(text_col), rank_file, pattern, piece=piece)
    return docs.select(F.col(id_col).alias("doc_id"), coded.alias("r")).select("doc_id", "r.*")
