"""Batch plans over the driver's tables: one function per query key.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables
(no sampling, no row caps).  Building one counts the lookup tables and, for
the sink and store keys, writes the sink before it is read back.  Inputs the reference gets from Kafka,
MySQL and a geo-IP file are derived from ``events``, ``customer`` and
``nation`` by ``natspark.sources.fixtures``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from natspark.functions.docs import to_json_doc
from natspark.functions.hashing import md5_hex
from natspark.functions.ipaddr import ip_to_long
from natspark.functions.split import text_lines
from natspark.functions.timefns import msg_time, task_time
from natspark.operators import aggregate as agg
from natspark.operators.enrich import enrich_user, index_docs, store_lookup
from natspark.operators.geo import app_name as resolve_app, geo_filter as gfilter, resolve_geo as rgeo
from natspark.operators.parse import parse_nat_log as parse, parse_rejects as rejects, parse_table
from natspark.operators.partitioning import ensure_parallelism
from natspark.operators.rangejoin import containing_ranges
from natspark.schemas import (ADDRESS_FIELDS, COUNT_5MIN, DIM_COUNT, INDEX_DOC_COLUMNS, NAT_LOG_COLUMNS,
                              NAT_RECORD_COLUMNS)
from natspark.session import scratch_path
from natspark.sinks import (DAY_MS, INDEX, RECORDS, USER_LOG, Store, append_dim_docs, bucket_digits, day_of, index_rows, latest_by_key, read_keyed_store, record_rows, upsert_index,
                            upsert_records, user_log_lines, write_counts, write_text_overwrite, write_user_log)
from natspark.sources.fixtures import (app_ranges, edge_addresses, ip_ranges, online_users, overlapping_ranges,
                                       read_table, syslog_lines)
from natspark.streaming.accounting import FIGURES
from natspark.sources.streams import read_ip_ranges, read_online_users, read_text_lines, register_view

# Fixed parameters of the registered queries.
INDEX_QUERY = {"targetPort": "443", "time_from": 1704153600000,   # 2024-01-02 00:00 UTC
               "time_to": 1704758400000}                          # 2024-01-09 00:00 UTC
REPLAY_EVERY = 50          # record_store: rows with seq % 50 = 0 are written again
LATE_EVERY = 7             # compact_store: rows with seq % 7 = 0 come once more in batch 2
HOT_GRAIN, HOT_MIN = "1 day", 1


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Syslog lines, spread over the cores when the source is a few large
    files (the parse is the CPU-heavy step)."""
    return ensure_parallelism(syslog_lines(read_table(spark, sf, "events")), key="seq")


def logs(spark: SparkSession, sf: str, keep=("seq",)) -> DataFrame:
    return parse(lines(spark, sf), keep=list(keep))


def records(spark: SparkSession, sf: str, keep=("seq",)) -> DataFrame:
    users = online_users(read_table(spark, sf, "customer"))
    return enrich_user(logs(spark, sf, keep), users)


def geo(spark: SparkSession, sf: str, keep=("seq",)) -> DataFrame:
    return rgeo(logs(spark, sf, keep), ip_ranges(read_table(spark, sf, "nation")))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once into a table below the shared checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _timed(df: DataFrame) -> DataFrame:
    return agg.with_event_time(df, delay=None)


# --- queries -------------------------------------------------------------

def parse_nat_log(spark, sf):
    return logs(spark, sf, keep=()).select(*NAT_LOG_COLUMNS)


def parse_rejects(spark, sf):
    return rejects(lines(spark, sf), keep=["seq"])


def parse_accounting(spark, sf):
    """What became of the lines, observed while the parsed table is written."""
    seen = Observation("parse")
    parse_table(lines(spark, sf), keep=["seq"], observe=seen).write.parquet(scratch_path(spark, "parsed"))
    return spark.createDataFrame([(f, seen.get[f]) for f in FIGURES], "figure string, rows long")


def log_count_5min(spark, sf):
    return agg.log_count_5min(_timed(logs(spark, sf, keep=())))


def nat_records(spark, sf):
    return records(spark, sf, keep=()).select(*NAT_RECORD_COLUMNS)


def user_activity(spark, sf):
    return user_log_lines(records(spark, sf, keep=()))


def matched_count_5min(spark, sf):
    return agg.log_count_5min(_timed(records(spark, sf, keep=())))


def secondary_index(spark, sf):
    return index_docs(records(spark, sf, keep=()))


def record_store(spark, sf):
    """Two batches of keyed puts: every record in batch 0, and the records
    with ``seq % 50 = 0`` again in batch 1 (a replayed delivery).  Both come
    from one pass over the records; the read view keeps the last per row key."""
    rec = records(spark, sf)
    first, replay = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    batches = F.explode(F.when(F.col("seq") % REPLAY_EVERY == 0, F.array(first, replay))
                        .otherwise(F.array(first)))
    puts = record_rows(rec, ("seq",)).withColumn("batch_id", batches).drop("seq")
    return latest_by_key(puts, "rowkey", "batch_id")


def index_lookup(spark, sf):
    """Search as the reference's readers would: the records are written once
    below the shared checkpoint folder (which also cuts the lineage) and loaded
    into two stores, the records by key bucket, the index by address and port.
    The search prunes days and row groups of the index, its hits prune days and
    buckets of the records."""
    raw = scratch_path(spark, "records")
    records(spark, sf, keep=()).select("*", day_of()).write.parquet(raw)
    rec = spark.read.parquet(raw)
    size, first, last = rec.agg(F.count("*"), F.min("day"), F.max("day")).first()
    days = last - first + 1 if size else 1
    tasks = spark.sparkContext.defaultParallelism if size < 1 << 24 else None
    stored = Store(spark, scratch_path(spark, "record-store"), replace(RECORDS, digits=bucket_digits(size, days)))
    index = Store(spark, scratch_path(spark, "index-store"), INDEX)
    with ThreadPoolExecutor(2) as side_by_side:
        for done in [side_by_side.submit(stored.load, rec, tasks),
                     side_by_side.submit(index.load, index_rows(rec), tasks)]:
            done.result()
    return store_lookup(index, stored, **INDEX_QUERY).select(*NAT_RECORD_COLUMNS)


def resolve_geo(spark, sf):
    return geo(spark, sf, keep=())


def geo_filter(spark, sf):
    return gfilter(geo(spark, sf, keep=()))


def _dim(spark, sf, dims):
    return agg.dim_count_5min(_timed(gfilter(geo(spark, sf, keep=()))), dims=dims)


def province_count_5min(spark, sf):
    return _dim(spark, sf, ("province",))


def operator_count_5min(spark, sf):
    return _dim(spark, sf, ("operator",))


def city_count_5min(spark, sf):
    return _dim(spark, sf, ("city",))


def dim_count_docs(spark, sf):
    return agg.dim_count_docs(_dim(spark, sf, agg.DIMENSIONS))


def hot_targets(spark, sf):
    return agg.hot_targets(_timed(gfilter(geo(spark, sf, keep=()))), HOT_MIN, HOT_GRAIN)


def _province_flow(spark, sf) -> DataFrame:
    """Records with a resolved province, as the SQL experiment filters them."""
    rec = records(spark, sf, keep=())
    ranges = ip_ranges(read_table(spark, sf, "nation"))
    g = rgeo(rec, ranges)
    return g.where((F.col("province") != "") & (F.col("province") != "UnKnown"))


def count_by_province(spark, sf):
    register_view(_province_flow(spark, sf), "nat_flow")
    return agg.count_by_province(spark, "nat_flow")


def province_running_max(spark, sf):
    return agg.province_running_max(_timed(_province_flow(spark, sf)))


def word_count(spark, sf):
    docs = ensure_parallelism(read_table(spark, sf, "documents").select("doc_id", "text"),
                              key="doc_id")
    text = docs.select(F.explode(text_lines(F.col("text"))).alias("value"))
    return agg.word_count(text)


def word_count_windowed(spark, sf):
    return agg.word_count_windowed(lines(spark, sf), "event_ts")


def ip_to_long_q(spark, sf):
    lg = logs(spark, sf, keep=())
    ips = lg.select(F.explode(F.array("sourceIp", "targetIp")).alias("ip")).distinct()
    return ips.select("ip", ip_to_long(F.col("ip")).alias("ip_long"))


def app_name(spark, sf):
    apps = app_ranges(read_table(spark, sf, "nation"))
    return resolve_app(logs(spark, sf), apps).select("seq", "targetIp", "app")


def hourly_profile(spark, sf):
    ev = read_table(spark, sf, "events").select(
        "user_id", F.date_format("ts", "HH").alias("hour"),
        F.floor(F.col("value") * 1000).cast("bigint").cast("string").alias("byte"),
        F.col("event_id").alias("ord"))
    return agg.hourly_profile(ev, "user_id")


def task_time_q(spark, sf):
    ev = read_table(spark, sf, "events")
    t = task_time(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("t")
    return ev.select("event_id", t).select(
        "event_id",
        *[F.col(f"t.{slot}.{side}").alias(f"{slot}_{side}")
          for slot in ("hour", "six_hour", "day", "minute5") for side in ("current", "previous")])


def msg_time_q(spark, sf):
    ev = read_table(spark, sf, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00"))
    return ev.select("event_id", msg_time(text).alias("msg_time"))


def md5_hex_q(spark, sf):
    lg = logs(spark, sf)
    return lg.select("seq", md5_hex(F.concat(*ADDRESS_FIELDS)).alias("md5"))


# --- sinks and readers: written (a batch replayed), then read back ----------

def upsert_records_q(spark, sf):
    """``record_store`` through the sink: batch 0 has every record, batch 1
    the replayed ones and is itself delivered twice."""
    path, rec = scratch_path(spark, "record_store"), _stored(records(spark, sf), "puts")
    again = rec.where(F.col("seq") % REPLAY_EVERY == 0)
    for batch_id, batch in ((0, rec), (1, again), (1, again)):
        upsert_records(batch, path, batch_id, order="seq")
    return read_keyed_store(spark, path).drop("day")


def upsert_index_q(spark, sf):
    path, rec = scratch_path(spark, "index_store"), _stored(records(spark, sf, keep=()), "puts")
    for batch_id in (0, 1, 1):
        upsert_index(rec, path, batch_id)
    return read_keyed_store(spark, path).select(*INDEX_DOC_COLUMNS)


def write_counts_q(spark, sf):
    path, counts = scratch_path(spark, "counts"), _stored(log_count_5min(spark, sf), "fired")
    for _ in range(2):
        write_counts(counts, path, 0)
    return spark.read.parquet(path).select(*COUNT_5MIN.fieldNames())


def write_user_log_q(spark, sf):
    """The user log, its batch delivered twice."""
    path, rec = scratch_path(spark, "user_log"), _stored(records(spark, sf, keep=()), "log-records")
    for _ in range(2):
        write_user_log(rec, path, 0)
    return spark.read.text(path).select(F.col("value").alias("line"), F.col("dt").cast("string").alias("dt"))


def _three_batches(spark, path, write, rec):
    """Every record in batch 0, some again in batches 1 and 2; 1 comes twice."""
    again = rec.where(F.col("seq") % REPLAY_EVERY == 0)
    late = rec.where(F.col("seq") % LATE_EVERY == 0)
    for batch_id, batch in ((0, rec), (1, again), (2, late), (1, again)):
        write(batch, path, batch_id)
    return again


def compact_store(spark, sf):
    """Three batches of record puts with a replay; the closed days are merged,
    a batch is replayed late, and the store is read back: batches, merged files
    and the late replay together."""
    path, rec = scratch_path(spark, "compacted"), _stored(records(spark, sf), "store-records")
    again = _three_batches(spark, path, lambda b, p, i: upsert_records(b, p, i, order="seq"), rec)
    store = Store(spark, path, replace(RECORDS, digits=0))
    newest = rec.agg(F.max("accesstime")).first()[0] // DAY_MS
    store.compact(before_day=newest)
    store.vacuum()
    upsert_records(again, path, 1, order="seq")
    return store.read().drop("day", "bucket")


def compact_user_log(spark, sf):
    """The user log in three batches, merged, one of them replayed late."""
    path, rec = scratch_path(spark, "compacted-log"), _stored(records(spark, sf), "log-records")
    again = _three_batches(spark, path, write_user_log, rec)
    store = Store(spark, path, USER_LOG)
    store.compact()
    store.vacuum()
    write_user_log(again, path, 1)
    return store.read().select(F.col("value").alias("line"), F.col("dt").cast("string").alias("dt"), "batch_id")


def dim_docs_sink(spark, sf):
    path, docs = scratch_path(spark, "dim_docs"), _stored(dim_count_docs(spark, sf), "docs")
    for _ in range(2):
        append_dim_docs(docs, path, 0)
    return spark.read.schema(DIM_COUNT).json(path).select(*DIM_COUNT.fieldNames())


def json_docs(spark, sf):
    return dim_count_docs(spark, sf).select(to_json_doc(DIM_COUNT.fieldNames()).alias("doc"))


def text_overwrite(spark, sf):
    path, counts = scratch_path(spark, "word_count"), word_count_windowed(spark, sf)
    for _ in range(2):
        write_text_overwrite(counts, path)
    return read_text_lines(spark, path).withColumnRenamed("value", "line")


def online_users_q(spark, sf):
    path = scratch_path(spark, "users")
    online_users(read_table(spark, sf, "customer")).write.parquet(path)
    return read_online_users(spark, path)


def ip_ranges_q(spark, sf):
    """The range table, written and read back, with the logs to each range."""
    path = scratch_path(spark, "ranges")
    ip_ranges(read_table(spark, sf, "nation")).write.csv(path)
    ranges = read_ip_ranges(spark, path, fmt="csv")
    targets = (logs(spark, sf, keep=()).groupBy("targetIp").agg(F.count("*").alias("n"))
               .withColumn("_ip", ip_to_long(F.col("targetIp"))))
    hits = containing_ranges(targets, "_ip", ranges, "startip", "endip").groupBy("startip", "endip", "local").agg(
        F.sum("n").alias("n_logs"))
    return ranges.join(hits, ["startip", "endip", "local"], "left").fillna(0, ["n_logs"])


# --- lookups at overlaps and range ends --------------------------------------

def resolve_geo_overlap(spark, sf):
    return rgeo(logs(spark, sf, keep=()), overlapping_ranges(read_table(spark, sf, "nation")))


def geo_edges(spark, sf):
    nation = read_table(spark, sf, "nation")
    found = rgeo(edge_addresses(read_table(spark, sf, "events")), overlapping_ranges(nation))
    return found.withColumn("ip_long", ip_to_long(F.col("targetIp")))


BATCH_QUERIES = {
    "parse_nat_log": parse_nat_log,
    "parse_rejects": parse_rejects,
    "parse_accounting": parse_accounting,
    "log_count_5min": log_count_5min,
    "nat_records": nat_records,
    "user_activity": user_activity,
    "matched_count_5min": matched_count_5min,
    "secondary_index": secondary_index,
    "record_store": record_store,
    "index_lookup": index_lookup,
    "resolve_geo": resolve_geo,
    "geo_filter": geo_filter,
    "province_count_5min": province_count_5min,
    "operator_count_5min": operator_count_5min,
    "city_count_5min": city_count_5min,
    "dim_count_docs": dim_count_docs,
    "hot_targets": hot_targets,
    "count_by_province": count_by_province,
    "province_running_max": province_running_max,
    "word_count": word_count,
    "word_count_windowed": word_count_windowed,
    "ip_to_long": ip_to_long_q,
    "app_name": app_name,
    "hourly_profile": hourly_profile,
    "task_time": task_time_q,
    "msg_time": msg_time_q,
    "md5_hex": md5_hex_q,
    "upsert_records": upsert_records_q,
    "upsert_index": upsert_index_q,
    "compact_store": compact_store,
    "compact_user_log": compact_user_log,
    "write_counts": write_counts_q,
    "write_user_log": write_user_log_q,
    "dim_docs_sink": dim_docs_sink,
    "json_docs": json_docs,
    "text_overwrite": text_overwrite,
    "online_users": online_users_q,
    "ip_ranges": ip_ranges_q,
    "resolve_geo_overlap": resolve_geo_overlap,
    "geo_edges": geo_edges,
}
