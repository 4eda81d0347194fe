"""Every registered query against its DuckDB oracle on sf0.001 (the driver's gate, small)."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracles import TABLES, digest
from tidemark.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
E.queries()  # loads the catalog
SQL = ORACLES
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(NAMES)
    assert set(NAMES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
