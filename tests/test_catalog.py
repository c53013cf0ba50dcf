"""Every registered query against its SQL counterpart on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from glossweave.catalog.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _value(x):
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, float):
        return "null" if math.isnan(x) else repr(x)
    return "null" if x is None else repr(x)


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(map(_value, row)) for row in frame.itertuples(index=False, name=None))


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    got = _rows(driver.queries()[name](spark, SF_DIR).toPandas())
    expected = _rows(duck.execute(driver.oracle_sql()[name]).df())
    assert got[0] == expected[0]
    assert got[1] == expected[1]


def test_entry(spark):
    assert driver.entry(spark).count() > 0
