"""End-to-end batch jobs: the reference's branches over a batch of lines.

The streaming forms are in ``natspark.streaming.pipelines``; these run the
same operators once over a static input (a day of archived logs, a replay)
and write the same sinks.  The lines are parsed once per slice, into a table
that every branch reads.  ``batch_id`` names the write so that re-running a
job replaces its output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from natspark.operators import aggregate as agg
from natspark.operators.enrich import enrich_user
from natspark.operators.geo import geo_filter, resolve_geo
from natspark.operators.parse import accepted, parse_table, rejected
from natspark.sinks import (append_dim_docs, batch_partition_write, upsert_index,
                            upsert_records, user_log_lines, write_counts,
                            write_text_overwrite)
from natspark.sources.streams import read_text_lines


def parsed_slice(lines: DataFrame, out: str, batch_id: int = 0,
                 order: str | None = None) -> DataFrame:
    """The slice's ``parse_table``, written to ``<out>/parsed`` and read back."""
    table = parse_table(lines, keep=[order] if order else [])
    batch_partition_write(table, f"{out}/parsed", batch_id)
    schema = StructType([*table.schema.fields, StructField("batch_id", LongType())])
    stored = lines.sparkSession.read.schema(schema).parquet(f"{out}/parsed")
    return stored.where(F.col("batch_id") == batch_id).drop("batch_id")


def run_record_job(lines: DataFrame, users: DataFrame, out: str, batch_id: int = 0,
                   order: str | None = None, parsed: DataFrame | None = None) -> None:
    """Record branch: parse (or take the ``parsed_slice``), count all logs (K1
    ``log_count``), keep rejects, enrich and key the records, then the user
    log (K2), record store (K3), index (K4) and matched counts (K1
    ``matched_count``)."""
    parsed = parsed if parsed is not None else parsed_slice(lines, out, batch_id, order)
    logs = accepted(parsed)
    write_counts(agg.log_count_5min(agg.with_event_time(logs, delay=None)),
                 f"{out}/log_count", batch_id)
    batch_partition_write(rejected(parsed, [order] if order else []), f"{out}/rejects", batch_id)
    records = enrich_user(logs, users).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        user_log = user_log_lines(records).select(F.col("line").alias("value"), "dt")
        batch_partition_write(user_log, f"{out}/username", batch_id, fmt="text",
                              partition_cols=("dt",))
        upsert_records(records, f"{out}/records", batch_id, order)
        upsert_index(records, f"{out}/index", batch_id)
        write_counts(agg.log_count_5min(agg.with_event_time(records, delay=None)),
                     f"{out}/matched_count", batch_id)
    finally:
        records.unpersist()


def run_dimension_job(lines: DataFrame, ranges: DataFrame, out: str,
                      drop_unresolved: bool = False, batch_id: int = 0,
                      parsed: DataFrame | None = None) -> None:
    """Dimension branch: geo-resolve, filter, count by province, operator
    and city per 5 minutes in one aggregation, append the documents (K5)."""
    parsed = parsed if parsed is not None else parsed_slice(lines, out, batch_id)
    geo = geo_filter(resolve_geo(accepted(parsed), ranges), drop_unresolved)
    counts = agg.dim_count_5min(agg.with_event_time(geo, delay=None))
    append_dim_docs(agg.dim_count_docs(counts), f"{out}/dim_docs", batch_id)


def run_word_count_job(spark: SparkSession, in_path: str, out_path: str,
                       single_file: bool = False) -> None:
    """Word count of a text file or folder, written as ``word,count`` text
    (overwrite).  ``single_file`` merges the (small) result into one file."""
    write_text_overwrite(agg.word_count(read_text_lines(spark, in_path)), out_path, single_file)
