from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} tail{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls in any column, empty, blank and very long texts, ties and repeated rows."""
    return [
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \t\n\x0b\x0c\r", "en", "a", 6),
        (4, "you idiot go away now", "en", "b", 21),
        (4, "you idiot go away now", "en", "b", 21),
        (5, "you idiot  go away now", "en", None, 22),
        (None, "a text without an id, once", None, "b", 26),
        (None, "a text without an id, once", None, "b", 26),
        (6, LONG, "en", "a", len(LONG)),
        (7, "Привет мир, это короткий текст", None, "b", 30),
        (8, "12 34 ## 56", "en", "c", 11),
    ]


@pytest.fixture(scope="session")
def hard(spark, hard_rows):
    return spark.createDataFrame(hard_rows, DOCS)


@pytest.fixture(scope="session")
def clashing(spark, hard):
    """The same with further columns, named like those that operators make."""
    names = ("doc", "id", "row", "sha", "n", "fp", "size", "pick", "score", "copy", "rank", "component", "__salt", "set", "a.b", "a`b")
    from pyspark.sql import functions as F

    return hard.select("*", *[F.lit(i).alias(name) for i, name in enumerate(names)])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 0, 1), (6, 1, 0), (7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
