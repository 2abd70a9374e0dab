"""Every registered query against its DuckDB oracle on the smallest tables
(row count, column names and order-insensitive value hash)."""
import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(SQLS[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
