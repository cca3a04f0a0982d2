"""Every registered query against its DuckDB oracle on the smallest driver tables (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(KEYS) == 80


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[key])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, cur.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "product_name", "purchase_count"]
    assert df.count() > 0
