"""Every registered query against its SQL twin on the smallest supplied tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from tenura.catalog.oracles import ORACLES
from tenura.catalog.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(cells, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, data_dir, duck, name):
    df = QUERIES[name](spark, data_dir)
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert {n: TYPES[t] for n, t in df.dtypes} == types
    assert _sorted(df.columns, [tuple(r) for r in df.collect()]) == _sorted(names, expected)
    assert expected


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
