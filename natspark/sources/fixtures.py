"""Inputs derived from the driver's tables (FIXTURES.md recipe).

The reference ships no data; its inputs (syslog lines, online users, geo-IP
ranges, application ranges) are derived here from ``events``, ``customer``
and ``nation`` with Spark columns only, so every query's work grows with the
tables it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.session import table_path

TWO24 = 1 << 24


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _s(c) -> F.Column:
    return c.cast("string")


def source_ip(key) -> F.Column:
    """``100.64.<key div 250>.<key % 250 + 1>`` for an integer key column."""
    return F.concat(F.lit("100.64."), _s(F.floor(key / 250)), F.lit("."),
                    _s(key % 250 + 1))


def syslog_lines(events: DataFrame) -> DataFrame:
    """One syslog line per event: ``value`` (the line), ``seq`` (event id,
    the stand-in for a source offset) and ``event_ts`` (TIMESTAMP).

    Rules by event_id, first match wins: ``% 97 = 0`` head only (dropped by
    the arity filter); ``% 101 = 0`` head plus a trailing comma (dropped);
    ``% 103 = 0`` no translation (a reject); otherwise a full line.  Written
    as one SQL projection (cheap to plan)."""
    src = ("concat('100.64.', CAST(user_id DIV 250 AS STRING), '.', "
           "CAST(user_id % 250 + 1 AS STRING), ':', CAST(1024 + event_id % 60000 AS STRING))")
    port = "CASE event_type WHEN 'click' THEN '443' WHEN 'view' THEN '80' ELSE '53' END"
    dst = f"concat(CAST(20 + (event_id * 7) % 200 AS STRING), '.0.0.8:', {port})"
    proto = "CASE WHEN event_type = 'error' THEN 'UDP' ELSE 'TCP' END"
    close = "CASE WHEN user_id % 2 = 0 THEN '):' ELSE ':)' END"
    head = (f"concat(date_format(ts, 'yyyy-MM-dd''T''HH:mm:ss'), '+08:00 10.0.0.', "
            f"CAST(user_id % 4 + 1 AS STRING), ' nat-gw NAT: session log ', "
            f"{src}, '->', {dst}, '(', {proto}, {close})")
    converted = ("concat('203.0.113.', CAST(user_id % 254 + 1 AS STRING), ':', "
                 "CAST(20000 + event_id % 40000 AS STRING))")
    line = (f"CASE WHEN event_id % 97 = 0 THEN {head} "
            f"WHEN event_id % 101 = 0 THEN concat({head}, ',') "
            f"WHEN event_id % 103 = 0 THEN concat({head}, ', no translation') "
            f"ELSE concat({head}, ', ', {src}, ' snat to ', {converted}) END")
    return events.selectExpr(f"{line} AS value", "event_id AS seq",
                             "CAST(ts AS TIMESTAMP) AS event_ts")


def online_users(customer: DataFrame) -> DataFrame:
    """``ONLINE_USER`` rows: current logins for keys not divisible by 5 and
    an older login (seen_at 0) for keys divisible by 7."""
    k = F.col("c_custkey")
    current = customer.where(k % 5 != 0).select(
        source_ip(k).alias("framedip"), F.col("c_name").alias("loginname"),
        F.lit(1).cast("bigint").alias("seen_at"))
    old = customer.where(k % 7 == 0).select(
        source_ip(k).alias("framedip"), F.concat("c_name", F.lit("-old")).alias("loginname"),
        F.lit(0).cast("bigint").alias("seen_at"))
    return current.unionByName(old)


def ip_ranges(nation: DataFrame) -> DataFrame:
    """``IP_RANGE`` rows: six /8 blocks per nation starting at (20 + 8n)/8,
    with a two-block gap after each; nations 21-24 carry malformed or empty
    location texts."""
    n = F.col("n_nationkey")
    start = ((F.lit(20) + n * 8).cast("bigint") * TWO24)
    normal = F.concat(F.lit("AS|CC|PROV_"), _s(F.col("n_regionkey")), F.lit("|CITY_"), _s(n),
                      F.lit("|D|ISP_"), _s(n % 4), F.lit("|1|E|X|1|2"))
    local = (F.when(n == 24, F.lit("AS|CC||||||E|X|1|2"))
             .when(n == 23, F.lit("AS|CC|PROV_23|CITY_23|D||1|E|X|1|2"))
             .when(n == 22, F.lit("AS|CC|P|C|D|ISP|1|E|X|1"))
             .when(n == 21, F.lit("AS|CC|P|C|D|ISP|1|E|X|1|"))
             .otherwise(normal))
    return nation.select(start.alias("startip"), (start + 6 * TWO24 - 1).alias("endip"),
                         local.alias("local"))


def overlapping_ranges(nation: DataFrame) -> DataFrame:
    """``ip_ranges`` and, per nation, a range nested in its third block and
    one that starts in its last block and ends a block behind it."""
    base = ip_ranges(nation)
    n = _s(F.expr(f"(startip div {TWO24} - 20) div 8"))

    def extra(tag: str, first: int, blocks: int) -> DataFrame:
        local = F.concat(F.lit(f"AS|CC|{tag}_"), n, F.lit(f"|{tag}|D|ISP_{tag}|1|E|X|1|2"))
        start = F.col("startip") + first * TWO24
        return base.select(start.alias("startip"), (start + blocks * TWO24 - 1).alias("endip"), local.alias("local"))

    return base.unionByName(extra("IN", 2, 1)).unionByName(extra("LATE", 5, 2))


def edge_addresses(events: DataFrame) -> DataFrame:
    """(event_id, ``targetIp``): for every event an address at or just outside
    an end of the range of nation ``event_id % 25`` in ``ip_ranges``, by
    ``event_id % 4`` its start, its end, the one after or the one before; by
    ``event_id % 3`` as it is, with a leading zero, or without its last part."""
    start = f"(20 + 8 * (event_id % 25)) * {TWO24}"
    v = events.selectExpr("event_id", f"{start} + CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 6 * {TWO24} - 1 "
                                      f"WHEN 2 THEN 6 * {TWO24} ELSE -1 END AS v")
    ip = v.selectExpr("event_id", f"concat_ws('.', v div {TWO24}, v div 65536 % 256, v div 256 % 256, v % 256) AS ip")
    return ip.selectExpr("event_id", "CASE event_id % 3 WHEN 0 THEN ip WHEN 1 THEN concat('0', ip) "
                                     "ELSE substring_index(ip, '.', 3) END AS targetIp")


def app_ranges(nation: DataFrame) -> DataFrame:
    """``APP_RANGE`` rows: half-open ``[start, end)`` over the same blocks as
    ``ip_ranges``, ``APP_<n % 6>``, ord = n; nation 0 also adds an overlapping
    range ``OVERLAY`` (ord 100) over the second half of its block."""
    n = F.col("n_nationkey")
    start = ((F.lit(20) + n * 8).cast("bigint") * TWO24)
    base = nation.select(start.alias("start"), (start + 6 * TWO24).alias("end"),
                         F.concat(F.lit("APP_"), _s(n % 6)).alias("app"),
                         n.cast("bigint").alias("ord"))
    overlay = nation.where(n == 0).select(
        (start + 3 * TWO24).alias("start"), (start + 6 * TWO24).alias("end"),
        F.lit("OVERLAY").alias("app"), F.lit(100).cast("bigint").alias("ord"))
    return base.unionByName(overlay)
