"""Every query of the log engine against its DuckDB SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from natspark.plans.batch import BATCH_QUERIES
from natspark.plans.oracle import oracle_sql
from natspark.streaming.plans import STREAM_QUERIES
from tools.oracle_check import TABLES, _digest

SF = "/root/testdata/sf0.001"
QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert _digest(df.columns, got) == _digest(ocols, want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["count_5min", "count_sec", "update_time"]
    assert df.count() > 0
