"""Behaviour outside the fixtures: overlaps, nulls, replays, pruning."""

import pytest
from pyspark.sql import functions as F

from natspark.app import with_arrival
from natspark.functions import ip_to_long_strict, task_time
from natspark.operators import aggregate as agg
from natspark.operators.enrich import index_lookup, latest_users
from natspark.operators.geo import resolve_geo
from natspark.operators.parse import parse_nat_log, parse_rejects
from natspark.sinks import append_dim_docs, console, day_of, read_keyed_store, upsert_index, upsert_records
from tests.conftest import rows


def loc(tag):
    return f"AS|CN|{tag}|{tag}|d|{tag}|1|e|s|1|2"


RANGES = [(10 << 24, (10 << 24) + 65535, loc("OUT")),            # 10.0.0.0/16
          ((10 << 24) + 256, (10 << 24) + 511, loc("IN")),        # 10.0.1.0/24 inside it
          ((10 << 24) + 500, (10 << 24) + 900, loc("LATE"))]      # overlaps both


@pytest.mark.parametrize("bound", [0, 1000, 2_000_000])
def test_overlapping_ranges_give_one_answer_at_every_bound(spark, bound):
    ranges = spark.createDataFrame(RANGES, "startip long, endip long, local string")
    logs = spark.createDataFrame([("10.0.1.5",), ("10.0.2.200",), ("10.0.9.9",), ("10.0.1.250",), ("11.0.0.1",)],
                                 "targetIp string")
    got = dict(rows(resolve_geo(logs, ranges, max_broadcast_rows=bound), "targetIp", "province"))
    assert got == {"10.0.1.5": "IN", "10.0.1.250": "IN", "10.0.2.200": "LATE", "10.0.9.9": "OUT",
                   "11.0.0.1": "UnKnown"}


def test_hourly_profile_keeps_keys_without_a_valid_hour(spark):
    df = spark.createDataFrame([(1, "03", "5", 0), (2, None, "7", 0), (3, "99", "7", 0)],
                               "k int, hour string, byte string, ord int")
    got = dict(rows(agg.hourly_profile(df, "k"), "k", "profile"))
    assert set(got) == {1, 2, 3} and "03=5" in got[1]
    assert got[2] == got[3] == ",".join(f"{h:02d}=0" for h in range(24))


def test_latest_users_with_null_or_absent_order(spark):
    df = spark.createDataFrame([("a", "x", None), ("a", "y", None), ("b", "x", None), ("b", "w", 1)],
                               "framedip string, loginname string, seen_at int")
    assert rows(latest_users(df)) == [("a", "y"), ("b", "w")]
    assert rows(latest_users(df.drop("seen_at"))) == [("a", "y"), ("b", "x")]


def test_keep_columns_still_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([("x,y", "d1"), ("x,y", "d2")], "value string, dt string").write.partitionBy("dt").parquet(path)
    lines = spark.read.parquet(path)
    for df in (parse_nat_log(lines, keep=["dt"]), parse_rejects(lines, keep=["dt"])):
        plan = df.where("dt = 'd1'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dt" in plan


def test_index_lookup_gives_one_record_per_key(spark):
    index = spark.createDataFrame([("k1", "80", "5")], "rowkey string, targetPort string, accesstime string")
    records = spark.createDataFrame([("k1", "old", 1), ("k1", "new", 2)], "rowkey string, username string, batch_id int")
    assert rows(index_lookup(index, records, targetPort="80"), "username") == [("new",)]
    assert index_lookup(index, records.drop("batch_id"), targetPort="80").count() == 1


def test_dim_docs_replay_replaces(spark, tmp_path):
    docs, path = spark.createDataFrame([("a",)], "types string"), str(tmp_path / "docs")
    for batch in (1, 1, 2):
        append_dim_docs(docs, path, batch)
    assert spark.read.json(path).count() == 2


def test_console_prints_every_row(spark, capsys):
    console(spark.range(50).toDF("n"))
    assert len(capsys.readouterr().out.splitlines()) == 51


RECORD = ("accesstime long, hostIP string, sourceIp string, sourcePort string, targetIp string, targetPort string, "
          "protocol string, convertedIp string, convertedPort string, username string, rowkey string")
DAY = 86_400_000


def record(day, key, port, host):
    at = day * DAY + 300_000
    return (at, host, "1.1.1.1", "5", "2.2.2.2", port, "TCP", "3.3.3.3", "9", "u", f"{key}_{at}")


def test_store_lookup_prunes_days_on_both_sides(spark, tmp_path):
    path, idx = str(tmp_path / "rec"), str(tmp_path / "idx")
    recs = spark.createDataFrame([record(d, k, p, "h") for d in (1, 2, 3) for k, p in (("a", "80"), ("b", "443"))], RECORD)
    recs.select("*", day_of()).write.partitionBy("day").parquet(path)
    upsert_index(recs, idx, 0)
    found = index_lookup(spark.read.parquet(idx), spark.read.parquet(path), 2 * DAY, 3 * DAY - 1, targetPort="80")
    assert rows(found, "rowkey") == [(f"a_{2 * DAY + 300_000}",)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("PartitionFilters: [isnotnull(day" in line for line in scans)
    assert "GreaterThanOrEqual(access_m" in plan            # the plan text is cut there


def test_record_store_order_and_equal_order(spark, tmp_path):
    path = str(tmp_path / "rec")
    twice = [record(1, "a", "80", h) + (n,) for h, n in (("x", 1), ("z", 1), ("y", 0))]
    for batch in (twice, twice[::-1]):              # a replay in another order
        upsert_records(spark.createDataFrame(batch, RECORD + ", seq int"), path, 0, order="seq")
        assert rows(spark.read.parquet(path), "hostIP", "day") == [("z", 1)]
    arrivals = spark.createDataFrame(twice, RECORD + ", seq long").select(
        "*", F.lit(0).alias("partition"), F.to_timestamp(F.lit("2024-01-01")).alias("kafka_ts"))
    upsert_records(with_arrival(arrivals), path, 1, order="arrival")
    assert read_keyed_store(spark, path, time_from=DAY, time_to=DAY).count() == 1
    assert read_keyed_store(spark, path, time_from=2 * DAY).count() == 0


def test_leading_zero_is_a_number(spark):
    df = spark.createDataFrame([("010.0.1.5",), ("10.0. 1.5",), ("10.+0.1.5",), ("10..1.5",), ("1.2.3",), (None,)], "ip string")
    assert [r.v for r in df.select(ip_to_long_strict("ip").alias("v")).collect()] == [(10 << 24) + 261] + [None] * 5


def test_hot_targets_of_five_minutes(spark):
    at = [(1704067200000, "a")] * 11 + [(1704067200000, "b")] * 10 + [(1704067500000, "a")] * 10
    df = agg.with_event_time(spark.createDataFrame(at, "accesstime long, targetIp string"), delay=None)
    assert rows(agg.hot_targets(df), "targetIp", "count") == [("a", 11)]


def test_task_time_keeps_local_slots_with_a_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")        # half an hour off
    try:
        t = spark.sql("SELECT 1597655698L AS s").select(task_time("s").alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    local = 1597655698 + 19800
    assert [t.hour.current, t.six_hour.current, t.day.current, t.minute5.current] == [
        local // n * n - 19800 for n in (3600, 21600, 86400, 300)]
