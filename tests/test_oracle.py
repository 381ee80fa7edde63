"""Every query against DuckDB on the smallest data folder."""

from __future__ import annotations

import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry_points
from clickloom.catalog.oracle import ORACLE
from clickloom.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SPARK_TO_SQL = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    relation = duck.execute(ORACLE[name])
    described = {d[0]: str(d[1]) for d in relation.description}
    rows = [dict(zip(described, map(plain, r))) for r in relation.fetchall()]
    assert {c: SPARK_TO_SQL[t] for c, t in df.dtypes} == described
    assert in_order(found) == in_order([tuple(r[c] for c in columns) for r in rows])


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
