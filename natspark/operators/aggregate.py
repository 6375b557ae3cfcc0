"""Event-time windows and counts (batch and streaming alike).

All counts group by ``window(ts, ...)`` rather than by the floored time
column: in a stream with a 0 s watermark a plain ``groupBy(ts)`` would treat
rows of the current bucket that arrive in a later micro-batch as late.
Aggregations are partial (map-side) then final, so one hot bucket or one hot
dimension value is pre-aggregated on every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natspark.functions.split import jsplit
from natspark.functions.timefns import event_time

WINDOW_5MIN = "5 minutes"
DIMENSIONS = ("province", "operator", "city")


def with_event_time(df: DataFrame, ms_col: str = "accesstime", ts_col: str = "ts",
                    delay: str | None = "0 seconds") -> DataFrame:
    """Add a TIMESTAMP ``ts`` from epoch ms and (optionally) a watermark.

    The reference bounds out-of-orderness by 0 s; pass a larger ``delay``
    when sources lag each other (Spark keeps one global watermark)."""
    out = df.withColumn(ts_col, event_time(ms_col))
    if delay is not None:
        out = out.withWatermark(ts_col, delay)
    return out


def log_count_5min(df: DataFrame, ts_col: str = "ts", size: str = WINDOW_5MIN) -> DataFrame:
    """``COUNT_5MIN`` per window: count, count div 300, window start text."""
    agg = df.groupBy(F.window(ts_col, size).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return agg.select(
        F.col("n").alias("count_5min"),
        F.floor(F.col("n") / 300).cast("bigint").alias("count_sec"),
        F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("update_time"))


def dim_count_5min(df: DataFrame, dims=DIMENSIONS, ts_col: str = "ts",
                   size: str = WINDOW_5MIN) -> DataFrame:
    """Rows per dimension value and window: ``types`` (dimension name),
    ``data`` (value), ``count`` and ``accesstime`` (window start, epoch s).

    All dimensions are counted by one aggregation over an exploded
    ``(types, data)`` pair, so the input is scanned and shuffled once."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("types"), F.col(d).alias("data"))
                                for d in dims]))
    exploded = df.select(F.col(ts_col), pairs.alias("p"))
    agg = (exploded.groupBy(F.window(ts_col, size).alias("w"), F.col("p.types").alias("types"),
                            F.col("p.data").alias("data"))
           .agg(F.count(F.lit(1)).alias("count")))
    return agg.select("types", "data", "count",
                      F.unix_seconds(F.col("w.start")).alias("accesstime"))


def dim_count_docs(counts: DataFrame) -> DataFrame:
    """``DIM_COUNT`` documents: every field as a string."""
    return counts.select(*[F.col(c).cast("string").alias(c)
                           for c in ("types", "data", "count", "accesstime")])


def hot_targets(df: DataFrame, min_count: int = 10, size: str = WINDOW_5MIN,
                ts_col: str = "ts", key: str = "targetIp") -> DataFrame:
    """Targets seen more than ``min_count`` times in a window."""
    agg = df.groupBy(F.window(ts_col, size).alias("w"), F.col(key)).agg(
        F.count(F.lit(1)).alias("count"))
    return agg.where(F.col("count") > min_count).select(
        F.unix_millis(F.col("w.start")).alias("accesstime"), key, "count")


def count_by_province(spark, view: str = "nat_flow") -> DataFrame:
    """The SQL experiment's query, through Catalyst on a registered view."""
    return spark.sql(f"SELECT province, count(1) AS resolver FROM {view} GROUP BY province")


def province_running_max(df: DataFrame, slice_size: str = "5 seconds",
                         ts_col: str = "ts", key: str = "province",
                         block: str = "1 day") -> DataFrame:
    """For each window with activity, the running count per province at its
    last update: counts only grow, so the max over the changelog equals the
    cumulative count up to the window's end.

    The running sum is two-level so that no window partition holds a
    province's whole history: sums within ``(province, block)`` partitions,
    plus the total of all earlier blocks (a window over one row per block)."""
    per = df.groupBy(key, F.window(ts_col, slice_size).alias("w")).agg(
        F.count(F.lit(1)).alias("cnt"))
    per = per.select(key, F.col("w.start").alias("_start"),
                     F.window(F.col("w.start"), block).start.alias("_block"), "cnt")
    inner = Window.partitionBy(key, "_block").orderBy("_start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    within = per.withColumn("_run", F.sum("cnt").over(inner))
    totals = per.groupBy(key, "_block").agg(F.sum("cnt").alias("_tot"))
    outer = Window.partitionBy(key).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    offsets = totals.select(key, "_block", (F.sum("_tot").over(outer) - F.col("_tot"))
                            .alias("_before"))
    return within.join(offsets, [key, "_block"]).select(
        key, F.unix_millis("_start").alias("window_start"),
        (F.col("_run") + F.col("_before")).alias("resolver"))


def words(lines: DataFrame, text_col: str = "value", keep=()) -> DataFrame:
    """One row per word of each line (split on one space)."""
    return lines.select(*keep, F.explode(jsplit(F.col(text_col), " ")).alias("word"))


def word_count(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """``word, count`` over all lines (partial aggregation handles hot words)."""
    return words(lines, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def word_count_windowed(lines: DataFrame, ts_col: str, text_col: str = "value",
                        size: str = "5 seconds", slide: str | None = None) -> DataFrame:
    """Word counts per (sliding) window: size 5 s and slide = size by
    default, the reference's tumbling form.  ``ts_col`` is an event time, or
    ``current_timestamp()`` for arrival time."""
    slide = slide or size
    w = words(lines, text_col, keep=[ts_col])
    agg = w.groupBy(F.window(ts_col, size, slide).alias("w"), "word").agg(
        F.count(F.lit(1)).alias("count"))
    return agg.select(F.unix_millis(F.col("w.start")).alias("window_start"), "word", "count")


def hourly_profile(df: DataFrame, key: str, hour: str = "hour", value: str = "byte",
                   order: str = "ord") -> DataFrame:
    """``key, profile``: 24 slots ``00=v,...,23=v``; a missing hour is 0, the
    last row (by ``order``) of a duplicated hour wins, other hour labels are
    ignored; a key without any valid hour has 24 zeros.  At most 25 entries
    per key reach the second aggregation."""
    valid = F.when(F.col(hour).rlike("^([01][0-9]|2[0-3])$"), F.col(hour))
    per_hour = df.groupBy(key, valid.alias("_h")).agg(F.max_by(value, order).alias("_v"))
    entry = F.when(F.col("_h").isNotNull(), F.struct("_h", "_v"))      # nulls aren't collected
    per_key = per_hour.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("_m"))
    slots = [F.concat(F.lit(f"{h:02d}="), F.coalesce(F.try_element_at(F.col("_m"), F.lit(f"{h:02d}")),
                                                      F.lit("0")))
             for h in range(24)]
    return per_key.select(key, F.concat_ws(",", *slots).alias("profile"))
