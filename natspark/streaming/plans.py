"""Streaming query keys.

Each query writes the syslog lines derived from ``events`` as text files
under the shared checkpoint folder, runs the streaming pipeline over them
with ``availableNow`` into a parquet sink, and returns the sink's rows.
In ``append`` mode the newest window is never emitted (the watermark equals
its start), which the matching oracle SQL accounts for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.operators.enrich import enrich_user
from natspark.operators.geo import resolve_geo
from natspark.operators.parse import parse_nat_log
from natspark.session import scratch_path
from natspark.sources.fixtures import ip_ranges, online_users, read_table, syslog_lines
from natspark.sources.streams import read_text_stream
from natspark.streaming.ledger import (changelog, read_slice_maxima, read_source_counts, source_window_counts,
                                       start_batches)
from natspark.streaming.pipelines import (dim_count_stream, log_count_stream, matched_count_chained,
                                         matched_count_stream, start_counts)


def _stream_input(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "syslog-lines")
    syslog_lines(read_table(spark, sf, "events")).select("value").write.text(path)
    return path


def _run(spark: SparkSession, counts: DataFrame, name: str) -> DataFrame:
    out = scratch_path(spark, f"{name}-out")
    q = start_counts(counts, out, scratch_path(spark, f"{name}-ckpt"),
                     trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(out)


def stream_log_count_5min(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_text_stream(spark, _stream_input(spark, sf))
    return _run(spark, log_count_stream(lines), "log-count")


def stream_dim_count_5min(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_text_stream(spark, _stream_input(spark, sf))
    ranges = ip_ranges(read_table(spark, sf, "nation"))
    return _run(spark, dim_count_stream(lines, ranges), "dim-count")


def stream_matched_count_5min(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_text_stream(spark, _stream_input(spark, sf))
    users = online_users(read_table(spark, sf, "customer"))
    return _run(spark, matched_count_stream(lines, users), "matched-count")


def stream_matched_chained(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_text_stream(spark, _stream_input(spark, sf))
    users = online_users(read_table(spark, sf, "customer"))
    return _run(spark, matched_count_chained(lines, users), "matched-chained")


def _in_steps(spark: SparkSession, sf: str, step, steps: int) -> str:
    """The syslog lines as a folder per step, written one after the other, so
    that a stream of one file per trigger reads them in that order; ``step``
    is a column over ``event_ts`` and ``value``."""
    path = scratch_path(spark, "syslog-steps")
    staged = f"{path}-staged"
    lines = syslog_lines(read_table(spark, sf, "events"))
    lines.select(step.cast("int").alias("step"), "value").write.partitionBy("step").parquet(staged)
    for k in range(steps):
        one = spark.read.schema("value string, step int").parquet(staged).where(F.col("step") == k)
        one.select("value").coalesce(1).write.text(f"{path}/step-{k:03d}")
    return path


def _day_step(steps: int, shift=0):
    """Event days cut into ``steps`` equal spans of a month, moved by ``shift``."""
    span = F.floor((F.dayofmonth("event_ts") - 1) * steps / 31)
    return F.least(span + shift, F.lit(steps - 1))


def province_flow_stream(spark: SparkSession, sf: str, path: str, files: int) -> DataFrame:
    """Records with a resolved province, as a stream of parsed lines."""
    lines = read_text_stream(spark, f"{path}/*", max_files_per_trigger=files)
    users, ranges = online_users(read_table(spark, sf, "customer")), ip_ranges(read_table(spark, sf, "nation"))
    flow = resolve_geo(enrich_user(parse_nat_log(lines), users), ranges)
    return (flow.where((F.col("province") != "") & (F.col("province") != "UnKnown"))
            .select("province", F.timestamp_millis("accesstime").alias("ts")))


def stream_province_changes(spark: SparkSession, sf: str, files: int = 1) -> DataFrame:
    """A7 and A8: the changelog of the province counts over lines that arrive
    in order of time, and the largest value of each slice."""
    path, out = _in_steps(spark, sf, _day_step(3), 3), scratch_path(spark, "changes")
    q = start_batches(province_flow_stream(spark, sf, path, files), changelog(spark, out),
                      scratch_path(spark, "changes-ckpt"), {"availableNow": True})
    q.awaitTermination()
    return read_slice_maxima(spark, out)


def stream_source_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """A2 with a watermark per source: the lines of one host arrive a step
    later than those of the other three, and lose nothing."""
    lags = F.when(F.col("value").contains("+08:00 10.0.0.3 "), 1).otherwise(0)
    path, out = _in_steps(spark, sf, _day_step(4, lags), 4), scratch_path(spark, "source-counts")
    logs = parse_nat_log(read_text_stream(spark, f"{path}/*", max_files_per_trigger=1))
    q = start_batches(logs, source_window_counts(spark, out, "hostIP", sources=4),
                      scratch_path(spark, "source-ckpt"), {"availableNow": True})
    q.awaitTermination()
    return read_source_counts(spark, out)


STREAM_QUERIES = {
    "stream_log_count_5min": stream_log_count_5min,
    "stream_dim_count_5min": stream_dim_count_5min,
    "stream_matched_count_5min": stream_matched_count_5min,
    "stream_matched_chained": stream_matched_chained,
    "stream_province_changes": stream_province_changes,
    "stream_source_watermark": stream_source_watermark,
}
