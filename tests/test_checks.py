"""Every registered query against its SQL in a second engine, over the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from tradewind.plans.checks import CHECKS
from tradewind.sources.star_views import BASE_SCHEMAS


@pytest.fixture(scope="module")
def second_engine(small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in BASE_SCHEMAS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "None" if math.isnan(value) else repr(value + 0.0 if value else 0.0)
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_rows(spark, small, second_engine, name):
    df = contract.queries()[name](spark, small)
    cursor = second_engine.execute(contract.oracle_sql()[name])
    expected = table([d[0] for d in cursor.description], cursor.fetchall())
    assert table(df.columns, df.collect()) == expected


def test_entry_runs(spark, small):
    rows = contract.entry(spark).collect()
    assert 0 < len(rows) and rows[0]["revenue_rank"] == 1
