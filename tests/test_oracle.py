"""Every registered query against its DuckDB oracle (sf0.001); queries
without an oracle must at least run.  The driver repeats this at sf0.01."""

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, table_rows

import __spark_entry__ as E

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_is_registered_with_a_callable():
    assert len(QUERIES) >= 140
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "total_revenue", "total_orders", "revenue_rank"]
    assert df.count() >= 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    if name not in ORACLES:
        assert rows is not None
        return
    cur = duck.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert table_rows(df.columns, rows, 6) == table_rows(dcols, drows, 6)
