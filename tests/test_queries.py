"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from lakeward.plans.catalog import REGISTRY
from lakeward.plans.tables import TABLES
from tools.oracle_check import rows

SF = "/root/testdata/sf0.001"
NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql()) and set(REGISTRY) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["sale_date", "order_count", "total_amount"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    got = sdf.toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    gc, gr = rows(got)
    wc, wr = rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
