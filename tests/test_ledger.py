"""Snapshots, per-source watermarks, the changelog and line accounting."""

import os

from pyspark.sql import functions as F

from natspark.operators.aggregate import log_count_5min, province_running_max, with_event_time
from natspark.operators.enrich import enrich_user
from natspark.operators.parse import parse_nat_log, parse_table
from natspark.sinks import read_keyed_store
from natspark.sources.streams import read_text_stream
from natspark.streaming import ledger
from natspark.streaming.accounting import ParseAccounting, balanced
from natspark.streaming.pipelines import (log_count_stream, matched_count_chained, record_batch_writer, start_counts)
from natspark.streaming.snapshots import Snapshots
from tests.conftest import rows
from tests.test_sinks import logs
from tests.test_streaming import line, write_files

MIN = 60_000


def users(spark, **logins):
    return spark.createDataFrame([(f"1.1.1.{k[1:]}", v, 1) for k, v in logins.items()],
                                 "framedip string, loginname string, seen_at long")


# ------------------------------------------------------------------ snapshots

def test_replay_sees_the_users_of_its_first_run(spark, tmp_path):
    now = {"df": users(spark, u0="alice", u1="bob")}
    shots = Snapshots(spark, str(tmp_path / "users"), lambda: now["df"])
    paths = {k: str(tmp_path / k) for k in ("user_log", "records", "index", "matched")}
    write = record_batch_writer(shots, paths["user_log"], paths["records"], paths["index"], order="seq",
                                matched_path=paths["matched"])

    def stores():
        return [rows(read_keyed_store(spark, paths["records"]).drop("batch_id")), rows(spark.read.text(paths["user_log"])),
                rows(read_keyed_store(spark, paths["index"])), rows(spark.read.parquet(paths["matched"]))]

    write(logs(spark, 6), 0)
    first = stores()
    now["df"] = users(spark, u0="carol")               # bob has gone, alice's address is carol's
    write(logs(spark, 6), 0)                            # the batch is run again
    assert stores() == first
    write(logs(spark, 6, host="h2"), 1)                 # the next one sees the new users
    names = {r.username for r in read_keyed_store(spark, paths["records"]).collect()}
    assert names == {"carol", "bob"}


def test_unchanged_users_are_kept_once_and_old_ones_go(spark, tmp_path):
    now = {"df": users(spark, u0="a")}
    shots = Snapshots(spark, str(tmp_path / "users"), lambda: now["df"], keep=2)
    for b in range(3):
        assert rows(shots.of(b)) == [("1.1.1.0", "a")]
    assert len(os.listdir(tmp_path / "users" / "data")) == 1
    now["df"] = users(spark, u0="b")
    assert rows(shots.of(3)) == [("1.1.1.0", "b")] and rows(shots.of(2)) == [("1.1.1.0", "a")]
    shots.of(4)
    assert len(os.listdir(tmp_path / "users" / "data")) == 1            # of the last two batches
    now["df"] = users(spark).limit(0)
    assert rows(shots.of(5)) == []


def test_replay_that_fills_fewer_days_leaves_none_behind(spark, tmp_path):
    from natspark.sinks import batch_partition_write

    def write(days, batch):
        df = spark.createDataFrame([(d, "x") for d in days], "day long, value string")
        batch_partition_write(df, str(tmp_path / "s"), batch, partition_cols=("day",))

    write([1, 2], 0)
    write([1, 3], 1)
    write([2], 0)
    assert rows(spark.read.parquet(str(tmp_path / "s")), "batch_id", "day") == [(0, 2), (1, 1), (1, 3)]


# ---------------------------------------------------------- source watermarks

def source_batches(spark, tmp_path, batches, sources=None):
    path = str(tmp_path / "out")
    write = ledger.source_window_counts(spark, path, "src", sources)
    for i, batch in batches:
        df = spark.createDataFrame([(s, m * MIN) for s, m in batch], "src string, accesstime long")
        write(df, i)
    counts = {r.update_time[-8:-3]: r.count_5min for r in ledger.read_source_counts(spark, path).collect()}
    late = rows(ledger.read_late(spark, path), "window_start", "source", "n", "batch_id")
    return counts, late


def test_a_lagging_source_loses_nothing(spark, tmp_path):
    counts, late = source_batches(spark, tmp_path, [
        (0, [("a", 0), ("b", 0)]), (1, [("a", 5), ("a", 10), ("a", 15)]),
        (2, [("b", 0), ("b", 5)]),                    # Spark's watermark would drop these
        (3, [("b", 10)])], sources=2)
    assert counts == {"00:00": 3, "00:05": 2} and late == []


def test_late_rows_are_counted_apart_and_replays_change_nothing(spark, tmp_path):
    batches = [(0, [("a", 0), ("b", 0)]), (1, [("a", 10), ("b", 10)]), (2, [("a", 0), ("a", 11), ("b", 5)]),
               (3, [("a", 20), ("b", 16)])]
    want = ({"00:00": 2, "00:10": 3}, [(0, "a", 1, 2), (5 * MIN, "b", 1, 2)])
    assert source_batches(spark, tmp_path / "1", batches) == want
    again = [batches[0], batches[1], batches[1], batches[2], batches[2], batches[3], batches[3]]
    assert source_batches(spark, tmp_path / "2", again) == want


def test_no_watermark_before_every_source_is_seen(spark, tmp_path):
    counts, late = source_batches(spark, tmp_path, [(0, [("a", 0), ("a", 50)]), (1, [("a", 60), (None, 0)])], sources=3)
    assert counts == {} and late == []


# ------------------------------------------------------------------ changelog

def test_changelog_is_the_running_max_on_any_trigger(spark, tmp_path):
    items = [("p%d" % (i % 3 % 2), i * 700) for i in range(90)]
    flow = spark.createDataFrame(items, "province string, ms long").withColumn("ts", F.timestamp_millis("ms"))
    want = rows(province_running_max(flow), "province", "window_start", "resolver")
    for name, size in (("small", 4), ("large", 50)):
        path = str(tmp_path / name)
        write = ledger.changelog(spark, path)
        for b in range(0, 90, size):
            part = flow.where((F.col("ms") >= b * 700) & (F.col("ms") < (b + size) * 700))
            write(part, b // size)
            if b // size == 1:
                write(part, 1)                          # a replay
        assert rows(ledger.read_slice_maxima(spark, path), "province", "window_start", "resolver") == want
        log = spark.read.parquet(f"{path}/changes").collect()
        for p in ("p0", "p1"):
            mine = sorted((r.batch_id, r.window_start, r.added, r.resolver) for r in log if r.province == p)
            value = 0
            for _, _, added, n in mine:                 # every retraction takes back the value before
                assert added or n == value
                value = n if added else 0
            assert value == sum(q == p for q, _ in items)


# ----------------------------------------------------- chained windows, figures

def test_chained_windows_equal_the_plain_count(spark, tmp_path):
    src = str(tmp_path / "in")
    write_files(src, [[line(1, 0), line(2, 1)], [line(3, 2), line(6, 3)], [line(11, 4)], [line(16, 5)]])
    known = users(spark, u1="bob")
    q = start_counts(matched_count_chained(read_text_stream(spark, src, max_files_per_trigger=1), known),
                     str(tmp_path / "out"), str(tmp_path / "ckpt"), {"availableNow": True})
    q.awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "out")), "update_time", "count_5min", "users")
    assert [(t[-8:-3], n, u) for t, n, u in got] == [("00:00", 3, 1), ("00:05", 1, 1), ("00:10", 1, 1)]
    batch = log_count_5min(with_event_time(enrich_user(parse_nat_log(spark.read.text(src)), known), delay=None))
    assert {(t, n) for t, n, _ in got} < set(rows(batch, "update_time", "count_5min"))


def test_every_line_is_accounted_for(spark, tmp_path):
    from pyspark.sql import Observation

    good, cut, bad = line(1, 0), "no comma", line(2, 1).replace(" snat to ", " to ")
    src = str(tmp_path / "in")
    write_files(src, [[good, cut], [bad, line(6, 3)], [line(11, 4), ""], [line(1, 5)]])
    seen = Observation("b")
    parse_table(spark.read.text(src), observe=seen).write.format("noop").mode("overwrite").save()
    got = seen.get
    assert balanced(got) and got == {"lines": 7, "accepted": 4, "rejected": 1, "without_arity": 2}
    listener = ParseAccounting()
    spark.streams.addListener(listener)
    try:
        stream = read_text_stream(spark, src, max_files_per_trigger=1)
        table = parse_table(stream, observe="parse").where("reason IS NULL")
        counts = log_count_5min(with_event_time(table))
        q = start_counts(counts, str(tmp_path / "out"), str(tmp_path / "ckpt"), {"availableNow": True})
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        import time
        for _ in range(50):
            total = listener.totals("parse")
            if total["lines"] >= got["lines"] and total["late"]:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert balanced(total) and {k: total[k] for k in got} == got
    assert total["late"] == 1                           # the last line, of a window that had closed
    assert listener.totals("other")["lines"] == 0


def test_plain_stream_drops_what_the_source_watermark_keeps(spark, tmp_path):
    src = str(tmp_path / "in")
    write_files(src, [[line(1, 0)], [line(11, 1)], [line(16, 2)], [line(2, 3)], [line(21, 4)]])
    q = start_counts(log_count_stream(read_text_stream(spark, src, max_files_per_trigger=1)), str(tmp_path / "out"),
                     str(tmp_path / "ckpt"), {"availableNow": True})
    q.awaitTermination()
    plain = {r.update_time[-8:-3]: r.count_5min for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert plain["00:00"] == 1
    counts, _ = source_batches(spark, tmp_path, [(0, [("a", 0)]), (1, [("a", 10)]), (2, [("a", 15), ("b", 0)]),
                                                 (3, [("b", 20), ("a", 20)])], sources=2)
    assert counts["00:00"] == 2
