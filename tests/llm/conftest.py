from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long = "all work and no play makes jack " * 3000
    rows = [
        (1, "Hello  World\n foo   bar\t baz ", "en", "a", 5),
        (2, "HelloWorldfoobarbaz", "en", "a", None),
        (3, None, "de", None, None),
        (4, "", None, "b", 0),
        (5, " \n\t ", "fr", "b", 4),
        (6, long, "en", "c", len(long)),
        (7, long, "en", None, len(long)),
        (7, long, "en", None, len(long)),
        (8, "x" * 5000, None, "c", 5000),
        (None, "Der Hund läuft über die Straße, nicht wahr?", "de", "d", None),
        (None, None, None, None, None),
        (9, "naïve café – 東京 \U0001f600 <|endoftext|>\x00\x0b\x1c end", "fr", "d", 1),
        (10, "it's  we'll\n\n  I'd   123 4567 !!! ??", "en", "a", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """Further columns with the names that operators use."""
    from pyspark.sql import functions as F

    names = "size h n a b id part bucket shard start old norm copies target best rows key words set_id"
    return odd.withColumns({name: F.lit("clash") for name in names.split()})
