"""Command-line entry point (``spark-submit natspark/app.py <command> ...``).

``stream``     the full streaming job: log counts, the record branch (user log,
               record store, index, matched-count partials; read the matched
               counts with ``read_matched_counts``) and dimension documents,
               from Kafka or from a folder of text files.
``batch``      the record and dimension branches over a batch of lines.
``compact``    merges the closed days of the stores below an output root and
               deletes what the merge replaced.
``wordcount``  word count of a text file or folder.

Endpoints, paths and credentials are arguments; nothing is embedded.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from natspark.operators.aggregate import dim_count_docs  # noqa: E402
from natspark.operators.parse import accepted  # noqa: E402
from natspark.plans.jobs import (parsed_slice, run_dimension_job, run_record_job,  # noqa: E402
                                 run_word_count_job)
from natspark.session import cluster_session  # noqa: E402
from natspark.sinks import INDEX, RECORDS, USER_LOG, Store  # noqa: E402
from natspark.sources.streams import (read_ip_ranges, read_online_users,  # noqa: E402
                                      read_syslog_kafka, read_text_lines, read_text_stream)
from natspark.streaming.pipelines import (dim_counts, log_counts, start_counts,  # noqa: E402
                                          start_parse, start_records)


def _users_loader(spark: SparkSession, args) -> callable:
    def load() -> DataFrame:
        if args.users_jdbc:
            props = {"user": os.environ.get("NATSPARK_JDBC_USER", ""),
                     "password": os.environ.get("NATSPARK_JDBC_PASSWORD", "")}
            return read_online_users(spark, jdbc_url=args.users_jdbc, table=args.users_table,
                                     properties=props)
        return read_online_users(spark, args.users, fmt=args.users_format)
    return load


def with_arrival(lines: DataFrame) -> DataFrame:
    """Kafka lines with ``arrival``, which orders lines across partitions:
    the broker's time, then partition and offset."""
    return lines.withColumn("arrival", F.struct("kafka_ts", "partition", "seq"))


def _lines(spark: SparkSession, args) -> DataFrame:
    if args.kafka_servers:
        lines = read_syslog_kafka(spark, args.kafka_servers, args.topic, args.starting_offsets,
                                  min_partitions=args.kafka_min_partitions,
                                  max_offsets_per_trigger=args.max_offsets_per_trigger)
        return with_arrival(lines)
    return read_text_stream(spark, args.text_dir, args.max_files_per_trigger)


def start_streams(spark: SparkSession, args) -> list:
    """Start every streaming branch; returns the StreamingQuery handles.  One
    query parses the lines into a table; the branches read that table."""
    trigger = ({"availableNow": True} if args.available_now
               else {"processingTime": f"{args.trigger_seconds} seconds"})
    out, ckpt = args.out.rstrip("/"), args.checkpoint.rstrip("/")
    load_users = _users_loader(spark, args)
    ranges = read_ip_ranges(spark, args.ranges, args.ranges_format)
    order = "arrival" if args.kafka_servers else None
    parse, parsed = start_parse(_lines(spark, args), f"{out}/parsed", f"{ckpt}/parsed", trigger, order,
                                observe="parse")
    if args.available_now:      # the branches take what is there when they start
        parse.awaitTermination()
    return [
        parse,
        start_counts(log_counts(accepted(parsed()), args.delay), f"{out}/log_count",
                     f"{ckpt}/log_count", trigger),
        start_counts(dim_count_docs(dim_counts(accepted(parsed()), ranges, args.delay)),
                     f"{out}/dim_docs", f"{ckpt}/dim_docs", trigger),
        start_records(parsed(), load_users,
                      {"user_log": f"{out}/username", "records": f"{out}/records",
                       "index": f"{out}/index", "matched": f"{out}/matched_partials",
                       "rejects": f"{out}/rejects", "users": f"{out}/users_by_batch"},
                      f"{ckpt}/records", trigger, order=order),
    ]


def compact_stores(spark: SparkSession, out: str, before: date, vacuum: bool = False) -> None:
    """Merge the days before ``before`` of the records, the index and the user log."""
    epoch_day, dt = (before - date(1970, 1, 1)).days, int(before.strftime("%Y%m%d"))
    for name, layout, day in (("records", RECORDS, epoch_day), ("index", INDEX, epoch_day), ("username", USER_LOG, dt)):
        store = Store(spark, f"{out}/{name}", layout)
        store.compact(before_day=day)
        if vacuum:
            store.vacuum()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run one command; ``spark`` defaults to ``cluster_session()``."""
    p = argparse.ArgumentParser(prog="natspark")
    sub = p.add_subparsers(dest="command", required=True)

    def common(sp):
        sp.add_argument("--users", help="online users (files)")
        sp.add_argument("--users-format", default="parquet")
        sp.add_argument("--users-jdbc", help="JDBC URL of the online users table")
        sp.add_argument("--users-table", default="online_users")
        sp.add_argument("--ranges", required=True, help="geo-IP range table")
        sp.add_argument("--ranges-format", default="parquet")
        sp.add_argument("--out", required=True, help="output root (shared storage)")

    s = sub.add_parser("stream")
    common(s)
    s.add_argument("--kafka-servers")
    s.add_argument("--topic", default="syslog")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--kafka-min-partitions", type=int, default=None,
                   help="split topic partitions over at least this many tasks")
    s.add_argument("--max-offsets-per-trigger", type=int, default=None)
    s.add_argument("--text-dir", help="folder of text files (instead of Kafka)")
    s.add_argument("--max-files-per-trigger", type=int, default=None)
    s.add_argument("--checkpoint", required=True, help="checkpoint root (shared storage)")
    s.add_argument("--delay", default="0 seconds", help="watermark delay")
    s.add_argument("--trigger-seconds", type=int, default=5)
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")

    b = sub.add_parser("batch")
    common(b)
    b.add_argument("--lines", required=True, help="text file or folder of syslog lines")
    b.add_argument("--batch-id", type=int, default=0)

    c = sub.add_parser("compact")
    c.add_argument("--out", required=True, help="output root of a stream or batch job")
    c.add_argument("--before", required=True, help="merge the days before this one (yyyy-MM-dd)")
    c.add_argument("--vacuum", action="store_true", help="delete replaced files (no reader may still use them)")

    w = sub.add_parser("wordcount")
    w.add_argument("--input", required=True)
    w.add_argument("--output", required=True)

    args = p.parse_args(argv)
    spark = spark or cluster_session()
    if args.command == "wordcount":
        run_word_count_job(spark, args.input, args.output)
        return 0
    if args.command == "compact":
        compact_stores(spark, args.out.rstrip("/"), date.fromisoformat(args.before), args.vacuum)
        return 0
    if args.command == "batch":
        lines = read_text_lines(spark, args.lines)
        users = _users_loader(spark, args)()
        ranges = read_ip_ranges(spark, args.ranges, args.ranges_format)
        parsed = parsed_slice(lines, args.out, args.batch_id)
        run_record_job(lines, users, args.out, args.batch_id, parsed=parsed)
        run_dimension_job(lines, ranges, args.out, batch_id=args.batch_id, parsed=parsed)
        return 0
    queries = start_streams(spark, args)
    for q in queries:
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
