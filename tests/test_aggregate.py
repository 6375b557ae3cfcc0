import datetime as dt
import random

from pyspark.sql import functions as F

from natspark.operators import aggregate as agg
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def timed(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_log_count_window(spark):
    data = [(T0 + dt.timedelta(minutes=m),) for m in (0, 1, 4, 5, 9, 10)]
    out = agg.log_count_5min(timed(spark, data, "ts timestamp"))
    assert rows(out) == [(1, 0, "2024-01-01 00:10:00"), (2, 0, "2024-01-01 00:05:00"),
                         (3, 0, "2024-01-01 00:00:00")]


def test_dim_counts_one_pass(spark):
    data = [(T0, "P1", "O1", "C1"), (T0, "P1", "O2", "C1"), (T0 + dt.timedelta(minutes=5), "P1", "O1", "C2")]
    df = timed(spark, data, "ts timestamp, province string, operator string, city string")
    out = agg.dim_count_5min(df)
    s0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    assert rows(out) == sorted([("province", "P1", 2, s0), ("operator", "O1", 1, s0), ("operator", "O2", 1, s0),
                                ("city", "C1", 2, s0), ("province", "P1", 1, s0 + 300),
                                ("operator", "O1", 1, s0 + 300), ("city", "C2", 1, s0 + 300)])
    docs = agg.dim_count_docs(out)
    assert all(t == "string" for _, t in docs.dtypes)


def test_hot_targets_strictly_more_than(spark):
    data = [(T0, "a")] * 11 + [(T0, "b")] * 10
    out = agg.hot_targets(timed(spark, data, "ts timestamp, targetIp string"), 10)
    assert [(r.targetIp, r["count"]) for r in out.collect()] == [("a", 11)]


def test_word_count_java_split(spark):
    df = spark.createDataFrame([("a b  a",), ("",), ("   ",), ("b ",)], "value string")
    assert rows(agg.word_count(df)) == [("", 2), ("a", 2), ("b", 2)]


def test_word_count_windowed_sliding(spark):
    data = [(T0 + dt.timedelta(seconds=s), "x") for s in (0, 3, 6)]
    df = timed(spark, data, "ts timestamp, value string")
    tumbling = agg.word_count_windowed(df, "ts")
    assert sorted(r["count"] for r in tumbling.collect()) == [1, 2]
    sliding = agg.word_count_windowed(df, "ts", size="5 seconds", slide="1 second")
    assert sum(r["count"] for r in sliding.collect()) == 15


def test_hourly_profile(spark):
    df = spark.createDataFrame([(1, "00", "5", 1), (1, "00", "7", 2), (1, "23", "9", 0), (1, "24", "1", 3),
                                (2, "05", "3", 0)], "k long, hour string, byte string, ord long")
    out = dict((r.k, r.profile) for r in agg.hourly_profile(df, "k").collect())
    slots = ["%02d=0" % h for h in range(24)]
    p1 = list(slots); p1[0] = "00=7"; p1[23] = "23=9"
    p2 = list(slots); p2[5] = "05=3"
    assert out == {1: ",".join(p1), 2: ",".join(p2)}


def test_province_running_max_matches_changelog_simulation(spark):
    rnd = random.Random(3)
    events = [(T0 + dt.timedelta(seconds=rnd.randrange(60)), rnd.choice("ABC")) for _ in range(40)]
    df = timed(spark, events, "ts timestamp, province string")
    got = {(r.province, r.window_start): r.resolver for r in agg.province_running_max(df).collect()}
    # Event-by-event: the changelog emits the running count after each event;
    # a 5 s window keeps the max per province among its updates.
    counts, want = {}, {}
    for ts, p in sorted(events):
        counts[p] = counts.get(p, 0) + 1
        w = int(ts.replace(tzinfo=dt.timezone.utc).timestamp()) // 5 * 5000
        want[(p, w)] = max(want.get((p, w), 0), counts[p])
    assert got == want


def test_count_by_province_sql(spark):
    df = spark.createDataFrame([("P1",), ("P1",), ("P2",)], "province string")
    df.createOrReplaceTempView("nat_flow_test")
    assert rows(agg.count_by_province(spark, "nat_flow_test")) == [("P1", 2), ("P2", 1)]


def test_province_running_max_across_blocks(spark):
    rnd = random.Random(9)
    events = [(T0 + dt.timedelta(seconds=rnd.randrange(4 * 86400)), rnd.choice("AB")) for _ in range(300)]
    df = timed(spark, events, "ts timestamp, province string")
    got = {(r.province, r.window_start): r.resolver
           for r in agg.province_running_max(df, block="1 day").collect()}
    counts, want = {}, {}
    for ts, p in sorted(events):
        counts[p] = counts.get(p, 0) + 1
        w = int(ts.replace(tzinfo=dt.timezone.utc).timestamp()) // 5 * 5000
        want[(p, w)] = max(want.get((p, w), 0), counts[p])
    assert got == want
