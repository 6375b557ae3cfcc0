"""Small tables that follow a stream from batch to batch.

Each function here is a ``foreachBatch`` writer whose state is a small table
per batch id: batch n reads the table of the batch before and writes its own.
A batch that is run again reads the same table and writes the same rows, and no
row of the stream itself is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from natspark.sinks import batch_partition_write
from natspark.sinks.folders import Folder

WINDOW_MS = 300_000


class BatchTable:
    """A table per batch id; the last ``keep`` of them stay."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keep: int = 10):
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep
        self.folder = Folder(spark, self.path)

    def _ids(self) -> list[int]:
        done = [n for n in self.folder.names() if n.startswith("batch_id=") and "_SUCCESS" in self.folder.names(n)]
        return sorted(int(n[9:]) for n in done)

    def before(self, batch_id: int) -> DataFrame:
        ids = [i for i in self._ids() if i < batch_id]
        return self.at(ids[-1]) if ids else self.spark.createDataFrame([], self.schema)

    def at(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id}")

    def put(self, batch_id: int, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        for old in [i for i in self._ids() if i <= batch_id][:-self.keep]:
            self.folder.delete(f"batch_id={old}")
        return self.at(batch_id)


def source_window_counts(spark: SparkSession, path: str, source: str, sources: int | None = None,
                         delay_ms: int = 0) -> Callable[[DataFrame, int], None]:
    """A2-A4's window firing with a watermark per source partition.

    Spark's watermark follows the fastest source, so a lagging one loses its
    rows.  Here each source (a column, for instance the Kafka partition) has
    its own progress, the largest event time seen of it, and the watermark is
    the smallest of them less ``delay_ms``, as the reference's is over its
    parallel inputs.  A window is written to ``<path>/counts`` once the
    watermark passes its end; rows of a window that has been passed before
    their batch are counted in ``<path>/late`` and change no count.  While
    fewer than ``sources`` have been seen there is no watermark, and without
    that number the sources seen so far decide.

    What is kept between batches is a row per source and per open window.
    """
    parts = BatchTable(spark, f"{path}/partials", "source string, window_start long, n long, last long")
    progress = BatchTable(spark, f"{path}/progress", "source string, last long")
    opened = BatchTable(spark, f"{path}/open", "window_start long, n long")

    def watermark(table: DataFrame) -> int | None:
        seen, least = table.agg(F.count("*"), F.min("last")).first()
        return least - delay_ms if seen and seen >= (sources or 1) else None

    for name in ("counts", "late"):
        Folder(spark, f"{path}/{name}").make()

    def write(batch: DataFrame, batch_id: int) -> None:
        start = F.expr(f"accesstime - pmod(accesstime, {WINDOW_MS})")
        # the stream's rows are read once, into a row per source and window
        new = parts.put(batch_id, batch.groupBy(
            F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), start.alias("window_start"))
            .agg(F.count("*").alias("n"), F.max("accesstime").alias("last")))
        earlier = progress.before(batch_id)
        passed = watermark(earlier)
        seen = progress.put(batch_id, earlier.unionByName(new.select("source", "last"))
                            .groupBy("source").agg(F.max("last").alias("last")))
        now = watermark(seen)
        behind = F.lit(False) if passed is None else F.col("window_start") + WINDOW_MS <= F.lit(passed)
        late = new.where(behind).groupBy("window_start", "source").agg(F.sum("n").alias("n"))
        batch_partition_write(late, f"{path}/late", batch_id)
        all_open = (opened.before(batch_id).unionByName(new.where(~behind).select("window_start", "n"))
                    .groupBy("window_start").agg(F.sum("n").alias("n")))
        fires = F.lit(False) if now is None else F.col("window_start") + WINDOW_MS <= F.lit(now)
        counts = all_open.where(fires).select(
            F.col("n").alias("count_5min"), F.floor(F.col("n") / 300).cast("bigint").alias("count_sec"),
            F.date_format(F.timestamp_millis("window_start"), "yyyy-MM-dd HH:mm:ss").alias("update_time"))
        batch_partition_write(counts, f"{path}/counts", batch_id)
        opened.put(batch_id, all_open.where(~fires))

    return write


def read_source_counts(spark: SparkSession, path: str) -> DataFrame:
    """The windows that have fired, as ``COUNT_5MIN`` rows."""
    return spark.read.schema("count_5min long, count_sec long, update_time string, batch_id long").parquet(
        f"{path}/counts").drop("batch_id")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """(window_start, source, n, batch_id) of the rows that came too late."""
    return spark.read.schema("window_start long, source string, n long, batch_id long").parquet(f"{path}/late")


def changelog(spark: SparkSession, path: str, key: str = "province", ts_col: str = "ts",
              slice_size: str = "5 seconds") -> Callable[[DataFrame, int], None]:
    """A7's changelog: the count of each key after every slice of arrival time,
    as pairs of a retraction (``added`` false, the value so far) and an
    insertion (true, the new one); a key's first value has no retraction.

    Slices are cut by ``ts_col``, not by the micro-batch, so any trigger gives
    the same values at a slice's end.  A slice that two batches share is
    inserted by both, the second time with the larger value.  Rows go to
    ``<path>/changes``; a row per key is kept between batches.
    """
    totals = BatchTable(spark, f"{path}/totals", f"`{key}` string, total long")
    Folder(spark, f"{path}/changes").make()
    slices = BatchTable(spark, f"{path}/slices", f"`{key}` string, window_start long, cnt long")

    def write(batch: DataFrame, batch_id: int) -> None:
        # the stream's rows are read once, into a row per key and slice
        per = slices.put(batch_id, batch.groupBy(
            key, F.unix_millis(F.window(ts_col, slice_size).start).alias("window_start")).agg(F.count("*").alias("cnt")))
        added = per.groupBy(key).agg(F.sum("cnt").alias("total"))
        before = totals.before(batch_id)
        # as in the batch form: sums within a day, after the days before
        block = F.expr("window_start div 86400000").alias("block")
        per = per.select("*", block).join(before, key, "left").fillna(0, ["total"])
        inner = Window.partitionBy(key, "block").orderBy("window_start")
        outer = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        days = per.groupBy(key, "block").agg(F.sum("cnt").alias("day")).select(
            key, "block", F.coalesce(F.sum("day").over(outer), F.lit(0)).alias("past"))
        run = (per.withColumn("run", F.sum("cnt").over(inner)).join(days, [key, "block"])
               .withColumn("value", F.col("total") + F.col("past") + F.col("run")))
        old = F.col("value") - F.col("cnt")
        pair = F.array(F.struct(F.lit(False).alias("added"), old.alias("resolver")),
                       F.struct(F.lit(True).alias("added"), F.col("value").alias("resolver")))
        pairs = F.filter(pair, lambda p: p["added"] | (p["resolver"] > 0))
        changes = run.select(key, "window_start", F.explode(pairs).alias("p")).select(
            key, "window_start", "p.added", "p.resolver")
        batch_partition_write(changes, f"{path}/changes", batch_id)
        totals.put(batch_id, before.unionByName(added).groupBy(key).agg(F.sum("total").alias("total")))

    return write


def read_slice_maxima(spark: SparkSession, path: str, key: str = "province") -> DataFrame:
    """A8: the largest value that was inserted in each slice."""
    schema = f"`{key}` string, window_start long, added boolean, resolver long, batch_id long"
    added = spark.read.schema(schema).parquet(f"{path}/changes").where("added")
    return added.groupBy(key, "window_start").agg(F.max("resolver").alias("resolver"))


def start_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: dict | None = None):
    """Start a ``foreachBatch`` query with one of the writers above."""
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
