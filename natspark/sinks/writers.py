"""Sink implementations (see the package note)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.functions.docs import to_json_doc
from natspark.schemas import INDEX_DOC_COLUMNS, NAT_LOG_COLUMNS
from natspark.sinks.folders import Folder

TIME_TEXT = "yyyy-MM-dd HH:mm:ss"
DAY_MS = 86_400_000


def day_of(ms="accesstime"):
    """Partition column of the keyed stores: days since the epoch of an
    epoch-millisecond time.  A row key ends in its accesstime, so all puts
    of one key fall on one day."""
    return F.expr(f"{ms} div {DAY_MS}").alias("day")


def in_days(df: DataFrame, time_from: int | None, time_to: int | None) -> DataFrame:
    """Rows whose ``day`` can hold a time of the inclusive range (a partition
    filter on a store; a table without ``day`` stays whole)."""
    if "day" not in df.columns:
        return df
    if time_from is not None:
        df = df.where(F.col("day") >= F.lit(time_from // DAY_MS))
    if time_to is not None:
        df = df.where(F.col("day") <= F.lit(time_to // DAY_MS))
    return df


def batch_partition_write(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet",
                          partition_cols: tuple = ()) -> None:
    """Write ``df`` as partition ``batch_id=<batch_id>`` of ``path``,
    replacing that partition only (safe to replay).  Sub-partitions that an
    earlier run of the batch filled and this one doesn't are removed."""
    spark = df.sparkSession
    batch = Folder(spark, f"{path}/batch_id={int(batch_id)}")
    before = {d: set(batch.names(d)) for d in batch.names() if "=" in d} if partition_cols else {}
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", *partition_cols).format(fmt).save(path))
    for d, names in before.items():
        if names & set(batch.names(d)):     # new files have new names
            batch.delete(d)


def write_counts(df: DataFrame, path: str, batch_id: int) -> None:
    """K1 on files: ``COUNT_5MIN`` rows of one fired batch."""
    batch_partition_write(df, path, batch_id)


def write_counts_jdbc(df: DataFrame, url: str, table: str, properties: dict) -> None:
    """K1 on a database: append the rows (the caller supplies URL, table and
    credentials; nothing is embedded here)."""
    df.write.jdbc(url=url, table=table, mode="append", properties=properties)


def user_log_lines(records: DataFrame) -> DataFrame:
    """K2 rows: ``(username,accesstime)`` text lines with their day folder
    ``dt`` (yyyyMMdd of accesstime in the session zone)."""
    return records.select(
        "username", "accesstime",
        F.date_format(F.timestamp_millis("accesstime"), "yyyyMMdd").alias("dt"),
        F.concat(F.lit("("), F.col("username"), F.lit(","),
                 F.col("accesstime").cast("string"), F.lit(")")).alias("line"))


def write_user_log(records: DataFrame, path: str, batch_id: int = 0) -> None:
    """K2: the batch's lines as text under ``<path>/batch_id=<n>/dt=<yyyyMMdd>/``;
    a replay replaces them, another batch adds to them."""
    lines = user_log_lines(records).select(F.col("line").alias("value"), "dt")
    batch_partition_write(lines, path, batch_id, fmt="text", partition_cols=("dt",))


def record_rows(records: DataFrame, extra: tuple = ()) -> DataFrame:
    """K3 cells: row key plus the ten text columns of a record, accesstime
    formatted as local ``yyyy-MM-dd HH:mm:ss`` (plus ``extra`` columns)."""
    cols = [c for c in NAT_LOG_COLUMNS if c != "accesstime"]
    return records.select(
        "rowkey",
        F.date_format(F.timestamp_millis("accesstime"), TIME_TEXT).alias("accesstime"),
        *cols, "username", *extra)


def _dedupe_in_batch(df: DataFrame, key: str, order: str | None) -> DataFrame:
    cols = [c for c in df.columns if c != key]
    last = F.struct(*([order] if order else []), *[c for c in cols if c != order])
    best = F.max_by(F.struct(*cols), last)
    return df.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


def upsert_records(records: DataFrame, path: str, batch_id: int,
                   order: str | None = None) -> None:
    """K3: one row per row key in the batch (the last by ``order`` when
    given, the largest among equals, so that a replay writes the same),
    written to the batch's partition, by day."""
    rows = record_rows(records, (*((order,) if order else ()), day_of()))
    rows = _dedupe_in_batch(rows, "rowkey", order)
    if order is not None:
        rows = rows.drop(order)
    batch_partition_write(rows, path, batch_id, partition_cols=("day",))


def index_rows(records: DataFrame) -> DataFrame:
    """``INDEX_DOC`` rows with their day, and the time also as a number
    (``access_ms``) for pushed range filters."""
    return records.select(*[F.col(c).cast("string").alias(c) for c in INDEX_DOC_COLUMNS],
                          F.col("accesstime").cast("bigint").alias("access_ms"), day_of())


def upsert_index(records: DataFrame, path: str, batch_id: int) -> None:
    """K4: ``INDEX_DOC`` rows keyed by row key, by day.  All index fields
    follow from the key, so any of its rows is the same document."""
    docs = index_rows(records)
    batch_partition_write(docs.dropDuplicates(["rowkey"]), path, batch_id, partition_cols=("day",))


def latest_by_key(df: DataFrame, key: str = "rowkey", order: str = "batch_id") -> DataFrame:
    """Read view of a keyed store: per key the row of the highest ``order``.
    The aggregation is partial per task, so a hot key is reduced before it
    is shuffled."""
    cols = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_r"))
            .select(key, "_r.*"))


def read_keyed_store(spark: SparkSession, path: str, key: str = "rowkey",
                     time_from: int | None = None, time_to: int | None = None) -> DataFrame:
    """Last row of every key; a time range prunes to its days first."""
    return latest_by_key(in_days(spark.read.parquet(path), time_from, time_to), key)


def append_dim_docs(docs: DataFrame, path: str, batch_id: int = 0) -> None:
    """K5: ``DIM_COUNT`` documents as JSON lines, as the batch's partition: a
    replay replaces it, another batch adds to it."""
    batch_partition_write(docs.select(to_json_doc(docs.columns).alias("value")), path, batch_id, fmt="text")


def write_text_overwrite(df: DataFrame, path: str, single_file: bool = False) -> None:
    """K6: text output, replacing what was there.  ``single_file`` merges to
    one file (one task) and is meant for small results only."""
    out = df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
                    .alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").text(path)


def console(df: DataFrame, n: int | None = None):
    """K7: print a batch, or start a console sink for a stream: every row, or
    the first ``n`` (of each micro-batch)."""
    most = n or 2**31 - 1
    if df.isStreaming:
        return (df.writeStream.format("console").option("numRows", most).option("truncate", False)
                .outputMode("append").start())
    for row in [df.columns, *(df if n is None else df.limit(n)).toLocalIterator(prefetchPartitions=False)]:
        print("\t".join("null" if v is None else str(v) for v in row))
    return None
