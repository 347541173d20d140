"""Tests of a text cell against the format rules, and its typed value."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheetmill.functions.text import blank_to_null, strip
from sheetmill.rules import RuleSet

LABELS = ("DATE", "INT64", "FLOAT", "STRING")


def label_cell(c: Column, rules: RuleSet, stripped: Column | None = None) -> Column:
    """Kind of a cell: DATE, INT64, FLOAT or STRING; NULL and ``""`` have none.

    Dates and numbers start with a digit, so other cells meet no regular expression.
    ``stripped`` may name a column that holds the stripped cell.
    """
    value = strip(c) if stripped is None else stripped
    starts_with_digit = (value >= "0") & (value < ":")
    fraction = value.contains(".") | value.contains("%")
    return (
        F.when(c.isNull() | (c == ""), F.lit(None).cast("string"))
        .when(~starts_with_digit, "STRING")
        .when(value.rlike(rules.label_numeric), F.when(fraction, "FLOAT").otherwise("INT64"))
        .when(value.rlike(rules.label_date), "DATE")
        .otherwise("STRING")
    )


def matches(c: Column, pattern: str) -> Column:
    """Format test that a missing value passes."""
    return F.coalesce(c.rlike(pattern), F.lit(True))


def to_date(c: Column, rules: RuleSet) -> Column:
    """Read a date by its shape; anything unreadable, impossible or blank is NULL.

    Two-digit years 69-99 belong to the 1900s, 00-68 to the 2000s.
    """
    century = F.when(F.right(c, F.lit(2)) >= "69", "19").otherwise("20")
    long_year = F.concat(F.substring_index(c, "/", 2), F.lit("/"), century, F.right(c, F.lit(2)))
    texts: dict[str, Column] = {}
    for reader in rules.date_readers:
        test, text = c.rlike(reader.shape), long_year if reader.short_year else c
        earlier = texts.get(reader.pattern)
        texts[reader.pattern] = F.when(test, text) if earlier is None else earlier.when(test, text)
    return F.coalesce(*[F.try_to_date(text, pattern) for pattern, text in texts.items()])


def to_number(c: Column) -> Column:
    """Double without commas; a trailing ``%`` divides by 100; blank or unreadable is NULL.

    Only decimal digits are read: a cast alone would take ``1d``, ``0x1p3`` or ``NaN``, too.
    """
    percent = c.endswith("%")
    digits = F.when(percent, F.replace(c, F.lit("%"), F.lit(""))).otherwise(c)
    plain = c.rlike(r"^\s*[+-]?[0-9,]*(\.[0-9]*)?([eE][+-]?[0-9]+)?\s*%?\z")
    number = F.when(plain, F.replace(digits, F.lit(","), F.lit("")).try_cast("double"))
    return number / F.when(percent, F.lit(100.0)).otherwise(F.lit(1.0))


def to_text(c: Column) -> Column:
    return blank_to_null(c)
