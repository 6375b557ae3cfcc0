"""Structured Streaming pipelines built from the batch operators.

The same parse / lookup / window operators run here on streaming
DataFrames.  Event time is ``accesstime``; the watermark delay defaults to
the reference's 0 s (Spark keeps one global watermark, the max over all
partitions, so a lagging source loses more rows: pass a larger ``delay``).
Windowed counts use ``append`` mode: a window is emitted once the watermark
passes its end, and rows behind the watermark are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.operators import aggregate as agg
from natspark.operators.enrich import enrich_user
from natspark.operators.geo import geo_filter, resolve_geo
from natspark.operators.parse import accepted, parse_nat_log, parse_table, rejected
from natspark.sinks import (batch_partition_write, upsert_index, upsert_records,
                            user_log_lines)
from natspark.streaming.snapshots import Snapshots

PARITY_DELAY = "0 seconds"


def log_count_stream(lines: DataFrame, delay: str = PARITY_DELAY) -> DataFrame:
    """A2 on a stream of lines: ``COUNT_5MIN`` rows, append mode."""
    return log_counts(parse_nat_log(lines), delay)


def log_counts(logs: DataFrame, delay: str = PARITY_DELAY) -> DataFrame:
    """A2 on a stream of parsed logs."""
    return agg.log_count_5min(agg.with_event_time(logs, delay=delay))


def dim_count_stream(lines: DataFrame, ranges: DataFrame, delay: str = PARITY_DELAY,
                     drop_unresolved: bool = False) -> DataFrame:
    """A4 on a stream: geo-resolve (stream-static join against the range
    table), filter, then one windowed count over the exploded dimensions."""
    return dim_counts(parse_nat_log(lines), ranges, delay, drop_unresolved)


def dim_counts(logs: DataFrame, ranges: DataFrame, delay: str = PARITY_DELAY,
               drop_unresolved: bool = False) -> DataFrame:
    """A4 on a stream of parsed logs."""
    geo = geo_filter(resolve_geo(logs, ranges), drop_unresolved)
    return agg.dim_count_5min(agg.with_event_time(geo, delay=delay))


def matched_count_stream(lines: DataFrame, users: DataFrame,
                         delay: str = PARITY_DELAY) -> DataFrame:
    """A3 on a stream: counts of logs with a known user.  ``users`` is a
    static DataFrame joined per micro-batch."""
    records = enrich_user(parse_nat_log(lines), users)
    return agg.log_count_5min(agg.with_event_time(records, delay=delay))


def matched_count_chained(lines: DataFrame, users: DataFrame, delay: str = PARITY_DELAY) -> DataFrame:
    """A3 as two windows, the second keyed on the first as in the reference:
    matched logs per user and window, then per window over the users.  Both
    keep state in one append query; the second takes the first one's
    ``window_time``, so it closes a window once that has been emitted."""
    records = agg.with_event_time(enrich_user(parse_nat_log(lines), users), delay=delay)
    each = records.groupBy(F.window("ts", agg.WINDOW_5MIN).alias("w"), "username").agg(F.count(F.lit(1)).alias("n"))
    timed = each.select(F.window_time("w").alias("ts"), "n")
    both = timed.groupBy(F.window("ts", agg.WINDOW_5MIN).alias("w")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("users"))
    return both.select(F.col("n").alias("count_5min"), F.floor(F.col("n") / 300).cast("bigint").alias("count_sec"),
                       F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("update_time"), "users")


def matched_partials(records: DataFrame) -> DataFrame:
    """Per-batch partial counts of records per 5-minute window."""
    w = F.window(F.timestamp_millis("accesstime"), agg.WINDOW_5MIN)
    return records.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.unix_millis(F.col("w.start")).alias("window_start"), "n")


def read_matched_counts(spark, path: str) -> DataFrame:
    """``COUNT_5MIN`` of matched records: the per-batch partials summed per
    window (a replayed batch replaced its own partial, so nothing doubles)."""
    total = spark.read.parquet(path).groupBy("window_start").agg(F.sum("n").alias("n"))
    return total.select(F.col("n").alias("count_5min"),
                        F.floor(F.col("n") / 300).cast("bigint").alias("count_sec"),
                        F.date_format(F.timestamp_millis("window_start"),
                                      "yyyy-MM-dd HH:mm:ss").alias("update_time"))


def record_batch_writer(users_loader: Callable[[], DataFrame] | Snapshots, user_log_path: str,
                        records_path: str, index_path: str, order: str | None = None,
                        matched_path: str | None = None, rejects_path: str | None = None):
    """``foreachBatch`` function for the record branch (O7, O6, K2-K4).

    Each micro-batch: the users are loaded afresh (the reference re-reads
    them at every window firing; with ``Snapshots`` a replayed batch sees those
    of its first run), the batch is enriched once and persisted,
    then written to the user log, the record store and the index.  Every
    write replaces the batch's own partition, so a replayed batch after a
    failure leaves no duplicate.  With ``matched_path`` the batch's matched
    counts per window are written too (A3 with users as fresh as the records;
    read them with ``read_matched_counts``).  A batch that still holds the
    rejected lines (``parse_table``) has them written to ``rejects_path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        logs, parsed = batch, None
        if "reason" in batch.columns:
            parsed = batch.persist()
            batch_partition_write(rejected(parsed, [order] if order else []), rejects_path, batch_id)
            logs = accepted(parsed)
        users = users_loader.of(batch_id) if isinstance(users_loader, Snapshots) else users_loader()
        records = enrich_user(logs, users).persist()
        try:
            lines = user_log_lines(records).select(F.col("line").alias("value"), "dt")
            batch_partition_write(lines, user_log_path, batch_id, fmt="text",
                                  partition_cols=("dt",))
            upsert_records(records, records_path, batch_id, order)
            upsert_index(records, index_path, batch_id)
            if matched_path:
                batch_partition_write(matched_partials(records), matched_path, batch_id)
        finally:
            records.unpersist()
            if parsed is not None:
                parsed.unpersist()

    return write


def start_record_branch(lines: DataFrame, users_loader: Callable[[], DataFrame],
                        paths: dict, checkpoint: str, trigger: dict | None = None,
                        order: str | None = None):
    """Start the record branch: parse the stream once, then ``foreachBatch``;
    with a ``rejects`` path the rejected lines are kept too."""
    parse = parse_table if paths.get("rejects") else parse_nat_log
    return start_records(parse(lines, keep=[order] if order else []), users_loader, paths,
                         checkpoint, trigger, order)


def start_records(logs: DataFrame, users_loader: Callable[[], DataFrame] | Snapshots, paths: dict,
                  checkpoint: str, trigger: dict | None = None, order: str | None = None):
    """The record branch on a stream of parsed logs, or of a ``parse_table``
    (with a ``rejects`` path).  With a ``users`` path every batch's users are
    kept there for its replay."""
    if paths.get("users"):
        users_loader = Snapshots(logs.sparkSession, paths["users"], users_loader)
    writer = record_batch_writer(users_loader, paths["user_log"], paths["records"],
                                 paths["index"], order, paths.get("matched"), paths.get("rejects"))
    q = logs.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    return q.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def start_parse(lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                order: str | None = None, observe: str | None = None):
    """Parse a stream of lines once into a table that the branches read as
    a stream each.  With ``observe`` its figures reach ``ParseAccounting``.  Spark's file sink lists every batch's files once, so a
    restart neither loses nor repeats rows for the readers.  Returns the query
    and a function that opens such a stream."""
    table = parse_table(lines, keep=[order] if order else [], observe=observe)
    spark = lines.sparkSession
    # The readers may start before the first batch is written.
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    query = (table.writeStream.outputMode("append").format("parquet")
             .option("path", path).option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
    return query, lambda: spark.readStream.schema(table.schema).parquet(path)


def start_counts(counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Start an append-mode windowed count into parquet files (exactly-once
    file sink with its own metadata log)."""
    return (counts.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def start_province_updates(flow: DataFrame, path: str, checkpoint: str,
                           slice_seconds: int = 5, trigger: dict | None = None):
    """A7 + A8 on a stream: the province counts in ``update`` mode, with
    each trigger's changed rows written under its batch id.  With a
    ``slice_seconds`` processing-time trigger the per-batch rows are the
    running maxima of each slice (``ledger.changelog`` has slices that don't
    follow the trigger, and retractions)."""
    counts = flow.groupBy("province").agg(F.count(F.lit(1)).alias("resolver"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch_partition_write(batch, path, batch_id)

    return (counts.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{slice_seconds} seconds"})).start())
