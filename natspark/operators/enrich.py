"""User lookup, row keys and index search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.functions.hashing import rowkey
from natspark.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS, row_count_at_most
from natspark.operators.joins import DEFAULT_SALTS, large_join
from natspark.schemas import INDEX_DOC_COLUMNS
from natspark.sinks import DAY_MS, Store, in_days

# Fixed value: the reference's sentinel for a source address with no login.
UNKNOWN_USER = "UnKnown"


def latest_users(users: DataFrame, key: str = "framedip", value: str = "loginname",
                 order: str = "seen_at") -> DataFrame:
    """One login per address: the last one by ``order`` (the reference keeps
    the last row it read); a null or absent ``order`` comes before all others,
    and among equals the largest login wins.  Partial aggregation collapses a
    hot address on each task before the shuffle."""
    last = F.struct(*([order] if order in users.columns else []), value)
    return users.groupBy(key).agg(F.max_by(value, last).alias(value))


def with_rowkey(df: DataFrame) -> DataFrame:
    return df.withColumn("rowkey", rowkey())


def enrich_user(logs: DataFrame, users: DataFrame, keep_unknown: bool = False,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                salts: int = DEFAULT_SALTS) -> DataFrame:
    """``NAT_RECORD``: logs plus ``username`` and ``rowkey``.

    ``sourceIp`` is looked up in the deduplicated users; a miss (or a null
    login) is ``UnKnown`` and, unless ``keep_unknown``, dropped together
    with any login literally named ``UnKnown``.  Without ``keep_unknown`` the
    lookup is an inner join, so the sentinel filter lands on the user side
    before the join.  The user side is broadcast when it has at most
    ``max_broadcast_rows`` rows (no shuffle of the logs); otherwise hot source
    addresses, found by a frequent-items sketch, are joined by a broadcast of
    their users and the others by a shuffle (``skew_join``; a stream salts)."""
    dim = latest_users(users).select(F.col("framedip").alias("_ip"),
                                     F.col("loginname").alias("_login"))
    how = "left" if keep_unknown else "inner"
    # Deduplication only shrinks the table, so a raw user table within the
    # bound proves the bound without running the dedup shuffle.
    small = max_broadcast_rows > 0 and (row_count_at_most(users, max_broadcast_rows)
                                        or row_count_at_most(dim, max_broadcast_rows))
    if small:
        joined = logs.join(F.broadcast(dim), logs["sourceIp"] == dim["_ip"], how)
    else:
        joined = large_join(logs, dim, "sourceIp", "_ip", how, salts)
    username = F.coalesce(F.col("_login"), F.lit(UNKNOWN_USER))
    out = joined.select(*[F.col(c) for c in logs.columns], username.alias("username"))
    if not keep_unknown:
        out = out.where(F.col("username") != F.lit(UNKNOWN_USER))
    return with_rowkey(out)


def index_docs(records: DataFrame) -> DataFrame:
    """``INDEX_DOC``: the searchable address fields, accesstime and row key,
    all strings, one per row key."""
    docs = records.select(*[F.col(c).cast("string").alias(c) for c in INDEX_DOC_COLUMNS])
    return docs.dropDuplicates(["rowkey"])


def store_lookup(index: Store, records: Store, time_from: int | None = None, time_to: int | None = None,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, **fields: str) -> DataFrame:
    """``index_lookup`` over two stores: the search reads the days of the range
    and, by sort order and Bloom filters, the row groups that can hold the
    fields; the hits' days and key buckets prune the scan of the records.  The
    hits are broadcast within the row bound (their count is known by then)."""
    days = [None if t is None else t // DAY_MS for t in (time_from, time_to)]
    cond = F.lit(True)
    for name, value in fields.items():
        cond = cond & (F.col(name) == F.lit(str(value)))
    if time_from is not None:
        cond = cond & (F.col("access_ms") >= F.lit(time_from))
    if time_to is not None:
        cond = cond & (F.col("access_ms") <= F.lit(time_to))
    hits = index.read(*days).where(cond).select("rowkey", "day")
    return records.fetch(hits, *days, small=row_count_at_most(hits, max_broadcast_rows))


def index_lookup(index: DataFrame, records: DataFrame, time_from: int | None = None,
                 time_to: int | None = None, **fields: str) -> DataFrame:
    """Records found through the index: filter the index by address/port
    equalities and an inclusive accesstime range (epoch ms; tables with a
    ``day`` read only its days, on both sides), then fetch the
    records whose row key was hit: one per hit, that of the last ``batch_id``
    where the records carry one."""
    cond = F.lit(True)
    for name, value in fields.items():
        cond = cond & (F.col(name) == F.lit(str(value)))
    at = F.col("access_ms" if "access_ms" in index.columns else "accesstime").cast("bigint")
    if time_from is not None:
        cond = cond & (at >= F.lit(time_from))
    if time_to is not None:
        cond = cond & (at <= F.lit(time_to))
    hits = in_days(index, time_from, time_to).where(cond).select("rowkey")
    found = in_days(records, time_from, time_to).join(hits, "rowkey", "left_semi")
    if "batch_id" not in records.columns:
        return found.dropDuplicates(["rowkey"])
    rest = [c for c in records.columns if c != "rowkey"]
    last = F.max_by(F.struct(*rest), F.struct("batch_id", *[c for c in rest if c != "batch_id"]))
    return found.groupBy("rowkey").agg(last.alias("_r")).select("rowkey", "_r.*").select(*records.columns)
