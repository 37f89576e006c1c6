"""Every registered query against its DuckDB oracle at sf0.001 (the driver runs sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from actimetry.plans.catalog import QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import canon as _canon

TABLES = ["events", "orders"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert _canon(rows, cols) == _canon(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["lh", "ct"]
    assert df.count() >= 0
