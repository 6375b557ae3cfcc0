"""Corpus queries against their DuckDB SQL; the others have a brute-force test."""

import duckdb
import pytest

import __spark_entry__ as entry
from natspark.llm import queries
from tools.oracle_check import TABLES, _digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(queries.ORACLE_SQL[key])
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want)
    assert _digest(df.columns, got) == _digest(columns, want)


def test_every_corpus_query_is_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {k for k in queries.QUERIES if int(k[2:].split("_")[0]) in range(1, 14)} == set(queries.QUERIES)
    assert len(queries.QUERIES) == 13 and set(queries.ORACLE_SQL) <= set(entry.oracle_sql())
