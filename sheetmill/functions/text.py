"""Cleaning and rendering of text cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# The characters stripped from both ends of a cell (Unicode white space and
# the four ASCII separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def quoted(name: str) -> Column:
    """Refer to a column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def clean_cell(c: Column) -> Column:
    """Line feeds become spaces, then both ends are stripped. NULL stays NULL."""
    return strip(F.replace(c, F.lit("\n"), F.lit(" ")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def sanitize_header(c: Column) -> Column:
    """Lower-case name of ASCII letters, digits and single underscores; ``col`` if empty.

    A missing header reads as the text ``None``.
    """
    words = F.regexp_replace(F.coalesce(c, F.lit("None")), "[^a-zA-Z0-9]+", "_")
    name = F.lower(F.btrim(words, F.lit("_")))
    return F.when(name == "", "col").otherwise(name)


def pad_cells(cells: Column, width: int) -> Column:
    """Exactly ``width`` cells: short rows gain ``""``, surplus cells are left out."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.coalesce(F.get(cells, i), F.lit("")),
    )


def row_text(columns: Sequence[str], delimiter: str) -> Column:
    """Untrimmed cells joined by the delimiter, NULL as ``""``."""
    return F.concat_ws(
        delimiter, *[F.coalesce(quoted(c).cast("string"), F.lit("")) for c in columns]
    )


def value_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a typed value; whole doubles are written without ``.0``."""
    if isinstance(dtype, T.DoubleType):
        return F.call_function("format_number", c, F.lit("0.#################"))
    return c.cast("string")


def parse_key_list(c: Column) -> Column:
    """``"a, b"`` to ``["a", "b"]``; NULL and ``""`` to an empty list."""
    keys = F.transform(F.split(c, ","), strip)
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(keys)
