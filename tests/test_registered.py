"""Every registered query against its independent SQL on the smallest test tables."""

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from checks.oracle import statements  # noqa: E402
from checks.compare import TABLES, difference  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SQL = statements()
QUERIES = {name: query for name, query in entry.queries().items() if name in entry.PLANS}


@pytest.fixture(scope="module")
def connection():
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, connection, name):
    assert difference(spark, connection, name, QUERIES[name], SQL[name], FOLDER) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 70


def test_items_are_dealt_out_for_products_and_sellers_alone(spark):
    """fact_order_items: translating keys back used to deal out every item by its order and by its customer too."""
    wide = [
        line
        for line in QUERIES["fact_order_items"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        if "Join Inner" in line and "order_sk" in line
    ]
    assert wide and all("order_id" in line and " - " in line for line in wide)
