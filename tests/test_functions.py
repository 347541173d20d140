"""Expressions against literal tables of inputs and expected values."""

from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from sheetmill.functions.formats import label_cell, matches, to_date, to_number, to_text
from sheetmill.functions.text import (
    blank_to_null,
    clean_cell,
    pad_cells,
    parse_key_list,
    sanitize_header,
    value_text,
)
from sheetmill.rules import RuleSet

REFERENCE = RuleSet.reference()
ALIGNED = RuleSet.aligned()


def evaluate(spark, values, build, dtype="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {dtype}")
    found = rows.select("i", build(F.col("c")).alias("v")).collect()
    return [r.v for r in sorted(found, key=lambda r: r.i)]


def check(spark, cases, build, dtype="string"):
    got = evaluate(spark, list(cases), build, dtype)
    assert dict(zip(cases, got, strict=True)) == cases


def test_sanitize_header(spark):
    cases = {
        "PO Number": "po_number",
        " po-number ": "po_number",
        "po_number_1": "po_number_1",
        "Total (IDR)": "total_idr",
        "__a__b__": "a_b",
        "naïve": "na_ve",
        "金額": "col",
        "": "col",
        None: "none",
    }
    check(spark, cases, sanitize_header)


def test_clean_cell(spark):
    cases = {
        "  a b ": "a b",
        "\ta\nb\n": "a b",
        "\xa0　x \x1f": "x",
        "a\rb\r": "a\rb",
        "​x": "​x",
        " \n ": "",
        None: None,
    }
    check(spark, cases, clean_cell)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.text(alphabet=st.sampled_from("ab é\t\n\r\x0b\x1c\x85\xa0 　​"), max_size=8),
        min_size=40,
        max_size=60,
    )
)
def test_clean_cell_strips_like_unicode(spark, values):
    assert evaluate(spark, values, clean_cell) == [v.replace("\n", " ").strip() for v in values]


def test_blank_to_null(spark):
    check(spark, {"": None, "a": "a", " ": " ", None: None}, blank_to_null)


@pytest.mark.parametrize(
    ("cells", "expected"),
    [
        (["a"], ["a", "", ""]),
        ([], ["", "", ""]),
        (["a", None, "c"], ["a", "", "c"]),
        (["a", "b", "c", "d"], ["a", "b", "c"]),
    ],
)
def test_pad_cells(spark, cells, expected):
    assert evaluate(spark, [cells], lambda c: pad_cells(c, 3), "array<string>") == [expected]


def test_label_cell(spark):
    cases = {
        "2024-01-05": "DATE",
        " 2024-01-05 ": "DATE",
        "2024-1-5": "STRING",
        "7%": "FLOAT",
        "7.5%": "FLOAT",
        "12": "INT64",
        "12.5": "FLOAT",
        "5.": "STRING",
        ".5": "STRING",
        "-12": "STRING",
        "1,234": "STRING",
        "1e3": "STRING",
        "1/2/2024": "STRING",
        "": None,
        "  ": "STRING",
        None: None,
        "٣": "STRING",
        "12\n": "INT64",
        "1\n2": "STRING",
    }
    check(spark, cases, lambda c: label_cell(c, REFERENCE))


def test_label_cell_aligned(spark):
    cases = {
        "2024-01-05": "DATE",
        "1/2/24": "DATE",
        "5-Jan-2024": "DATE",
        "1,234": "INT64",
        "12,34": "STRING",
        "1,234.5%": "FLOAT",
        "-12": "STRING",
    }
    check(spark, cases, lambda c: label_cell(c, ALIGNED))


def test_date_format(spark):
    cases = {
        "1/2/2024": True,
        "01/02/2024": True,
        "1/2/24": True,
        "1/2/204": False,
        "2/30/2024": True,
        "13/2/2024": True,
        "5-Jan-2024": True,
        "5-JAN-2024": True,
        "5-Jan-24": False,
        "2024-01-05": False,
        "1/2/2024\n": False,
        "٣/1/2024": False,
        "": False,
        None: True,
    }
    check(spark, cases, lambda c: matches(c, REFERENCE.accept_date))


def test_to_date(spark):
    cases = {
        "1/2/2024": date(2024, 1, 2),
        "01/02/2024": date(2024, 1, 2),
        "1/2/24": date(2024, 1, 2),
        "1/2/70": date(1970, 1, 2),
        "1/2/69": date(1969, 1, 2),
        "1/2/68": date(2068, 1, 2),
        "2/29/00": date(2000, 2, 29),
        "2/29/70": None,
        "2/30/2024": None,
        "13/2/2024": None,
        "5-Jan-2024": None,
        "2024-01-05": None,
        "": None,
        "n/a": None,
        None: None,
    }
    check(spark, cases, lambda c: to_date(c, REFERENCE))


def test_to_date_aligned(spark):
    cases = {
        "1/2/2024": date(2024, 1, 2),
        "5-Jan-2024": date(2024, 1, 5),
        "5-JAN-2024": date(2024, 1, 5),
        "31-Feb-2024": None,
        "5-Abc-2024": None,
        "2024-01-05": date(2024, 1, 5),
        "2024-02-30": None,
    }
    check(spark, cases, lambda c: to_date(c, ALIGNED))


@pytest.mark.parametrize(
    ("value", "accepted", "kept", "number"),
    [
        ("0", True, True, 0.0),
        ("12.50", True, True, 12.5),
        ("7%", True, True, 0.07),
        ("7.5%", True, True, 0.075),
        ("1,234", False, True, 1234.0),
        (",", False, True, None),
        ("1,234.5%", False, True, 12.345),
        ("-1", False, False, -1.0),
        (".5", False, False, 0.5),
        ("5.", False, False, 5.0),
        ("", False, False, None),
        (None, True, True, None),
    ],
)
def test_numbers(spark, value, accepted, kept, number):
    assert evaluate(spark, [value], lambda c: matches(c, REFERENCE.accept_numeric)) == [accepted]
    assert evaluate(spark, [value], lambda c: matches(c, REFERENCE.reject_numeric)) == [kept]
    assert evaluate(spark, [value], to_number) == [number]


def test_to_text(spark):
    check(spark, {"": None, " ": " ", "x": "x", None: None}, to_text)


def test_value_text(spark):
    cases = {101.0: "101", 12345678.5: "12345678.5", 1e7: "10000000", 0.075: "0.075", None: None}
    check(spark, cases, lambda c: value_text(c, T.DoubleType()), "double")
    assert evaluate(spark, [date(2024, 1, 5)], lambda c: value_text(c, T.DateType()), "date") == [
        "2024-01-05"
    ]


@pytest.mark.parametrize(
    ("text", "keys"),
    [("a, b", ["a", "b"]), ("a", ["a"]), ("a,,b ", ["a", "", "b"]), ("", []), (None, [])],
)
def test_parse_key_list(spark, text, keys):
    assert evaluate(spark, [text], parse_key_list) == [keys]
