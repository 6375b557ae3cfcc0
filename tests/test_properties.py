"""Property tests: Spark expressions against small Python models."""

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from natspark.functions import jsplit
from natspark.functions import sqlexpr
from natspark.operators.partitioning import ensure_parallelism

SEPARATORS = [",", ":", " ", r"\s+", "[->()]", r"\.", r"\|", " snat to "]


def java_split(s: str, pattern: str) -> list[str]:
    """The JVM String.split(regex) contract for non-empty separators."""
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


texts = st.lists(st.text(alphabet="ab,: \t.|->()snato", max_size=14), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(texts)
def test_jsplit_matches_java_contract(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    cols = [jsplit(F.col("v"), p).alias(f"c{i}") for i, p in enumerate(SEPARATORS)]
    cols += [F.expr(sqlexpr.jsplit("v", p)).alias(f"s{i}") for i, p in enumerate(SEPARATORS)]
    for row in df.select("v", *cols).collect():
        for i, p in enumerate(SEPARATORS):
            assert row[f"c{i}"] == java_split(row.v, p), (row.v, p)
            assert row[f"s{i}"] == java_split(row.v, p), (row.v, p)


def test_ensure_parallelism(spark):
    one = spark.range(0, 1000, numPartitions=1)
    spread = ensure_parallelism(one, 8, key="id")
    assert spread.rdd.getNumPartitions() == 8
    assert sorted(r.id for r in spread.collect()) == list(range(1000))
    many = spark.range(0, 1000, numPartitions=16)
    assert ensure_parallelism(many, 8) is many


comma_free = st.lists(st.text(alphabet="ab: \t.|->()snato", max_size=16), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(comma_free)
def test_comma_rewrite_split_matches_java_contract(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = df.select("v", F.expr(sqlexpr.jsplit_on_comma("v", literal=" snat to ")).alias("a"),
                    F.expr(sqlexpr.jsplit_on_comma("v", chars="->()")).alias("b")).collect()
    for row in out:
        assert row.a == java_split(row.v, " snat to "), row.v
        assert row.b == java_split(row.v, "[->()]"), row.v


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 59), st.integers(0, 59), st.sampled_from([1, 5, 15])),
                min_size=1, max_size=40))
def test_staged_floor_matches_one_expression(spark, cases):
    from natspark.functions import floor_minutes_ms
    rows = [("2024-03-09T07:%02d:%02d+08:00" % (m, s), g) for m, s, g in cases]
    df = spark.createDataFrame(rows, "t string, g int")
    for g in (1, 5, 15):
        sub = df.where(F.col("g") == g)
        staged = (sub.selectExpr("t", f"{sqlexpr.time_text('t')} AS _t")
                  .selectExpr("t", "_t", f"{sqlexpr.minute_of('_t')} AS _m")
                  .selectExpr("t", f"{sqlexpr.floored_ms('_t', '_m', g)} AS a"))
        for r in staged.select("a", floor_minutes_ms(F.col("t"), g).alias("b")).collect():
            assert r.a == r.b
