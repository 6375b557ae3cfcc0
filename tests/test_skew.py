"""One key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from natspark.operators import aggregate as agg
from natspark.operators.enrich import enrich_user
from natspark.operators.geo import resolve_geo

LOG_SCHEMA = ("accesstime long, hostIP string, sourceIp string, sourcePort string, "
              "targetIp string, targetPort string, protocol string, convertedIp string, "
              "convertedPort string")


def skewed_logs(spark, n=30000):
    # every third row comes from 10.0.0.1 / goes to 5.0.0.1
    hot = F.col("id") % 3 == 0
    src = F.when(hot, F.lit("10.0.0.1")).otherwise(F.concat(F.lit("10.1."), (F.col("id") % 200).cast("string"), F.lit(".1")))
    dst = F.when(hot, F.lit("5.0.0.1")).otherwise(F.concat(F.lit("6.0."), (F.col("id") % 50).cast("string"), F.lit(".9")))
    return spark.range(n).select(
        (F.lit(1704067200000) + (F.col("id") % 12) * 300000).alias("accesstime"), F.lit("h").alias("hostIP"),
        src.alias("sourceIp"), F.col("id").cast("string").alias("sourcePort"), dst.alias("targetIp"),
        F.lit("80").alias("targetPort"), F.lit("TCP").alias("protocol"), F.lit("9.9.9.9").alias("convertedIp"),
        F.lit("1").alias("convertedPort"))


def test_hot_source_shuffle_join_is_spread_and_exact(spark):
    users = spark.createDataFrame(
        [("10.0.0.1", "hot", 1)] + [(f"10.1.{i}.1", f"u{i}", 1) for i in range(200)],
        "framedip string, loginname string, seen_at long")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = enrich_user(skewed_logs(spark), users, max_broadcast_rows=0)
        tagged = out.select("username", F.spark_partition_id().alias("part")).collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    got, hot_parts = {}, set()
    for r in tagged:
        got[r.username] = got.get(r.username, 0) + 1
        if r.username == "hot":
            hot_parts.add(r.part)
    assert got["hot"] == 10000 and sum(got.values()) == 30000
    assert len(hot_parts) > 1          # the hot address is not confined to one task


def test_hot_window_and_target_counts_exact(spark):
    logs = agg.with_event_time(skewed_logs(spark), delay=None)
    counts = {r.update_time: r.count_5min for r in agg.log_count_5min(logs).collect()}
    assert sum(counts.values()) == 30000 and len(counts) == 12
    hot = agg.hot_targets(logs, 1000, "1 day")
    assert [(r.targetIp, r["count"]) for r in hot.collect()] == [("5.0.0.1", 10000)]


def test_hot_target_geo_sweep_exact(spark):
    ranges = spark.createDataFrame([(5 << 24, (5 << 24) + 255, "AS|CC|P5|C5|D|ISP5|1|E|X|1|2")],
                                   "startip long, endip long, local string")
    out = resolve_geo(skewed_logs(spark), ranges, max_broadcast_rows=0)
    got = {r.province: r["count"] for r in out.groupBy("province").count().collect()}
    assert got == {"P5": 10000, "UnKnown": 20000}
