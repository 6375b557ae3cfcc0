"""Frequent keys of a join, and segments in shards."""

import random

import pytest
from pyspark.sql import functions as F

from natspark.operators.enrich import enrich_user
from natspark.operators.geo import app_name, resolve_geo
from natspark.operators.joins import frequent_keys, skew_join
from natspark.operators.rangejoin import bits_for, disjoint_segments
from natspark.sources.streams import read_text_stream
from natspark.streaming.pipelines import dim_count_stream
from tests.test_skew import skewed_logs
from tests.test_streaming import line, write_files


@pytest.fixture
def shuffles(spark):
    """Joins as on large tables: no broadcast by size, no merged partitions."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df, *cols):
    """Sorted rows, nulls among them."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------- hot keys

def test_sketch_names_the_hot_keys(spark):
    logs = skewed_logs(spark)
    assert frequent_keys(logs, "sourceIp", 0.1) == ["10.0.0.1"]
    assert frequent_keys(logs, "sourceIp", 0.9) == [] and frequent_keys(logs.limit(0), "sourceIp", 0.1) == []
    nulls = logs.select(F.when(F.col("sourceIp") != "10.0.0.1", F.col("sourceIp")).alias("k"))
    assert frequent_keys(nulls, "k", 0.3) == []          # a null is no key


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_the_plain_join(spark, shuffles, how):
    rnd = random.Random(1)
    keys = ["hot"] * 600 + [None] * 500 + [f"k{rnd.randrange(90)}" for _ in range(700)] + ["none"] * 300
    big = spark.createDataFrame([(k, i % 7, "x") for i, k in enumerate(keys)], "key string, v int, w string").repartition(5)
    small = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(60)], (None, 5)], "sk string, n int")
    got = skew_join(big, small, "key", "sk", how)
    assert rows(got) == rows(big.join(small, F.col("key") == F.col("sk"), how)) and got.columns == ["key", "v", "w", "sk", "n"]
    assert rows(skew_join(big.limit(0), small, "key", "sk", how)) == []
    assert rows(skew_join(big, small.limit(0), "key", "sk", how).select("key", "n")) == (
        [] if how == "inner" else rows(big.select("key", F.lit(None).cast("int").alias("n"))))


def test_hot_address_is_not_shuffled_and_nothing_is_written(spark, shuffles):
    users = spark.createDataFrame([("10.0.0.1", "hot", 1)] + [(f"10.1.{i}.1", f"u{i}", 1) for i in range(200)],
                                  "framedip string, loginname string, seen_at long")
    before = spark.sparkContext.getCheckpointDir()
    import glob
    written = set(glob.glob(before.removeprefix("file:") + "/*"))
    out = enrich_user(skewed_logs(spark), users, max_broadcast_rows=0)
    assert set(glob.glob(before.removeprefix("file:") + "/*")) == written
    logical, physical = plan_of(out)
    assert "monotonically" not in logical and "rand" not in logical and "BroadcastHashJoin" in physical
    got = {r.username: r["count"] for r in out.groupBy("username").count().collect()}
    assert got["hot"] == 10000 and sum(got.values()) == 30000
    # the shuffled part has no task with a third of the rows
    cold = out.where(F.col("username") != "hot").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in cold) < 10000


# ------------------------------------------------------------------- segments

def overlapping(rnd, n):
    out = []
    for i in range(n):
        lo = rnd.randrange(0, 1 << 32)
        hi = min((1 << 32) - 1, lo + rnd.choice([0, 1, 255, 65536, rnd.randrange(1 << 27)]))
        out.append((lo, hi, f"AS|CC|P{i}|C{i % 5}|D|ISP{i % 3}|1|E|X|1|2"))
    return out


def text_ip(p):
    return "%d.%d.%d.%d" % (p >> 24, (p >> 16) & 255, (p >> 8) & 255, p & 255)


@pytest.mark.parametrize("n,single", [(40, 500_000), (40, 0), (0, 0), (1, 0)])
def test_segments_cover_what_the_ranges_cover(spark, n, single):
    data = overlapping(random.Random(n), n)
    segs = disjoint_segments(spark.createDataFrame(data, "lo long, hi long, x string"), "lo", "hi", n, single)
    got = sorted((r._seg_lo, r._seg_hi) for r in segs.collect())
    points = sorted({p for lo, hi, _ in data for p in (lo, hi + 1)})
    assert got == [(a, b - 1) for a, b in zip(points, points[1:])]


def test_every_bound_gives_the_same_rows_without_an_exchange_on_the_logs(spark):
    rnd = random.Random(8)
    data = overlapping(rnd, 30)
    ranges = spark.createDataFrame(data, "startip long, endip long, local string")
    ips = [rnd.randrange(1 << 32) for _ in range(200)] + [d[0] for d in data] + [d[1] for d in data]
    logs = spark.createDataFrame([(i, text_ip(p)) for i, p in enumerate(ips)] + [(-1, "bad"), (-2, None)],
                                 "id long, targetIp string")
    want = None
    for bound in (1000, 10, 40, 0):
        out = resolve_geo(logs, ranges, max_broadcast_rows=bound)
        got = rows(out)
        want = want or got
        assert got == want, bound
        if bound:
            logical = out._jdf.queryExecution().executedPlan().toString()
            top = logical[:logical.index("BroadcastExchange")]
            assert "Exchange hashpartitioning" not in top and "Exchange rangepartitioning" not in top
            assert logical.count("BroadcastHashJoin") >= (bound < 1000)
    by = {r.id: r.province for r in out.collect()}
    for i, p in enumerate(ips):
        hits = [(hi, -lo, loc) for lo, hi, loc in data if lo <= p <= hi]
        assert by[i] == (min(hits)[2].split("|")[2] if hits else "UnKnown")


def test_app_ranges_in_shards(spark):
    rnd = random.Random(3)
    apps = [(lo, hi + 1, f"A{i}", i) for i, (lo, hi, _) in enumerate(overlapping(rnd, 25))]
    adf = spark.createDataFrame(apps, "start long, end long, app string, ord long")
    logs = spark.createDataFrame([(text_ip(p),) for a in apps for p in (a[0], a[1] - 1)], "targetIp string")
    assert rows(app_name(logs, adf, max_broadcast_rows=8)) == rows(app_name(logs, adf)) == rows(
        app_name(logs, adf, max_broadcast_rows=0))


def test_stream_with_a_hot_target_in_shards(spark, tmp_path, monkeypatch):
    src = str(tmp_path / "in")
    hot = [line(1, i) for i in range(40)] + [line(2, i).replace("2.2.2.2", f"{3 + i}.0.0.1") for i in range(20)]
    write_files(src, [hot, [line(6, 3)], [line(12, 4)]])
    data = [(i << 24, ((i + 1) << 24) - 1, f"AS|CC|P{i}|C|D|I|1|E|X|1|2") for i in range(1, 20)]
    ranges = spark.createDataFrame(data, "startip long, endip long, local string")
    from natspark.streaming import pipelines
    got = []
    for bound in (1000, 10):
        monkeypatch.setattr(pipelines, "resolve_geo", lambda lg, rg, b=bound: resolve_geo(lg, rg, max_broadcast_rows=b))
        counts = dim_count_stream(read_text_stream(spark, src, max_files_per_trigger=1), ranges)
        q = pipelines.start_counts(counts, str(tmp_path / f"o{bound}"), str(tmp_path / f"c{bound}"), {"availableNow": True})
        q.awaitTermination()
        got.append(rows(spark.read.parquet(str(tmp_path / f"o{bound}"))))
    assert got[0] == got[1] and ("province", "P2", 40, 1704067200) in got[0]


def test_bits_follow_the_number_of_segments():
    assert bits_for(0) == 24 and bits_for(50) == 24 and bits_for(1 << 16) == 16 and bits_for(1 << 30) == 8
