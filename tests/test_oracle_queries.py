"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from harmonia.plans.fixtures import TABLES
from oracle_check import rows_of

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_every_query_registered_with_unique_names():
    assert len(QUERIES) >= 140
    assert set(SQL) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "Taxon" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, sf_small, name):
    sdf = QUERIES[name](spark, sf_small)
    cols = sorted(sdf.columns)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(dcols) == cols
    assert rows_of(srows, cols) == rows_of(drows, cols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_oracle_runs(spark, sf_small, name):
    assert QUERIES[name](spark, sf_small).count() > 0
