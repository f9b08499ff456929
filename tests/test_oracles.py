"""Every registered query against DuckDB on the same tables."""

import __spark_entry__ as entries
import duckdb_oracles
import pytest
from compare import connect, duckdb_rows, spark_rows

SCALES = ["sf0.001", "sf0.01", "sf0.1"]
QUERIES = entries.event_queries()
ORACLES = duckdb_oracles.oracle_sql()


@pytest.fixture(scope="module", params=SCALES)
def folder(request):
    return f"/root/testdata/{request.param}"


@pytest.fixture(scope="module")
def duck(folder):
    con = connect(folder)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, folder, name):
    assert spark_rows(QUERIES[name](spark, folder)) == duckdb_rows(duck, ORACLES[name])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_returns_ten_brands(spark):
    brands = entries.entry(spark)
    assert brands.columns == ["brand", "estimated_revenue", "num_purchases"]
    assert brands.count() == 10
