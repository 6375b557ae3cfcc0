"""DuckDB reference SQL for each query key.

Written independently of the Spark code: the parsed fields are computed
straight from the ``events`` columns (no text parsing), the users from
``customer`` and the ranges from ``nation``, following FIXTURES.md.
"""

from __future__ import annotations

_SRC_IP = ("'100.64.' || CAST(user_id // 250 AS VARCHAR) || '.' || "
           "CAST(user_id % 250 + 1 AS VARCHAR)")
_SRC_PORT = "CAST(1024 + event_id % 60000 AS VARCHAR)"
_DST_IP = "CAST(20 + (event_id * 7) % 200 AS VARCHAR) || '.0.0.8'"
_DST_PORT = "CASE event_type WHEN 'click' THEN '443' WHEN 'view' THEN '80' ELSE '53' END"
_PROTO = "CASE WHEN event_type = 'error' THEN 'UDP' ELSE 'TCP' END"
_HEAD = (f"strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+08:00 10.0.0.' || "
         f"CAST(user_id % 4 + 1 AS VARCHAR) || ' nat-gw NAT: session log ' || "
         f"{_SRC_IP} || ':' || {_SRC_PORT} || '->' || {_DST_IP} || ':' || {_DST_PORT} || "
         f"'(' || {_PROTO} || CASE WHEN user_id % 2 = 0 THEN '):' ELSE ':)' END")
_CUST_IP = ("'100.64.' || CAST(c_custkey // 250 AS VARCHAR) || '.' || "
            "CAST(c_custkey % 250 + 1 AS VARCHAR)")
_T24 = "16777216"

BASE = f"""
WITH lines AS (
  SELECT event_id AS seq, ts, event_type, user_id,
    CASE WHEN event_id % 97 = 0 THEN {_HEAD}
         WHEN event_id % 101 = 0 THEN {_HEAD} || ','
         WHEN event_id % 103 = 0 THEN {_HEAD} || ', no translation'
         ELSE {_HEAD} || ', ' || {_SRC_IP} || ':' || {_SRC_PORT} || ' snat to 203.0.113.'
              || CAST(user_id % 254 + 1 AS VARCHAR) || ':' || CAST(20000 + event_id % 40000 AS VARCHAR)
    END AS line
  FROM events),
parsed AS (
  SELECT event_id AS seq,
    (epoch_us(ts) // 300000000) * 300000 AS accesstime,
    '10.0.0.' || CAST(user_id % 4 + 1 AS VARCHAR) AS hostIP,
    {_SRC_IP} AS sourceIp, {_SRC_PORT} AS sourcePort,
    {_DST_IP} AS targetIp, {_DST_PORT} AS targetPort, {_PROTO} AS protocol,
    '203.0.113.' || CAST(user_id % 254 + 1 AS VARCHAR) AS convertedIp,
    CAST(20000 + event_id % 40000 AS VARCHAR) AS convertedPort
  FROM events
  WHERE event_id % 97 <> 0 AND event_id % 101 <> 0 AND event_id % 103 <> 0),
users AS (
  SELECT {_CUST_IP} AS framedip, c_name AS loginname, 1 AS seen_at FROM customer WHERE c_custkey % 5 <> 0
  UNION ALL
  SELECT {_CUST_IP}, c_name || '-old', 0 FROM customer WHERE c_custkey % 7 = 0),
latest AS (SELECT framedip, arg_max(loginname, seen_at) AS loginname FROM users GROUP BY framedip),
records AS (
  SELECT p.*, l.loginname AS username,
    substr(md5(p.sourceIp || p.sourcePort || p.targetIp || p.targetPort || p.convertedIp
               || p.convertedPort), 9, 16) || '_' || CAST(p.accesstime AS VARCHAR) AS rowkey
  FROM parsed p JOIN latest l ON p.sourceIp = l.framedip
  WHERE l.loginname IS NOT NULL AND l.loginname <> 'UnKnown'),
ranges AS (
  SELECT CAST(20 + 8 * n_nationkey AS BIGINT) * {_T24} AS startip,
         CAST(20 + 8 * n_nationkey AS BIGINT) * {_T24} + 6 * {_T24} - 1 AS endip,
         CASE WHEN n_nationkey = 24 THEN 'AS|CC||||||E|X|1|2'
              WHEN n_nationkey = 23 THEN 'AS|CC|PROV_23|CITY_23|D||1|E|X|1|2'
              WHEN n_nationkey = 22 THEN 'AS|CC|P|C|D|ISP|1|E|X|1'
              WHEN n_nationkey = 21 THEN 'AS|CC|P|C|D|ISP|1|E|X|1|'
              ELSE 'AS|CC|PROV_' || CAST(n_regionkey AS VARCHAR) || '|CITY_'
                   || CAST(n_nationkey AS VARCHAR) || '|D|ISP_' || CAST(n_nationkey % 4 AS VARCHAR)
                   || '|1|E|X|1|2' END AS local
  FROM nation),
located AS (
  SELECT startip, endip,
    len(string_split(regexp_replace(local, '\\|+$', ''), '|')) >= 11 AND trim(local) <> '' AS ok,
    string_split(local, '|') AS f
  FROM ranges),
geo AS (
  SELECT p.*,
    coalesce(CASE WHEN l.ok THEN l.f[6] END, 'UnKnown') AS operator,
    coalesce(CASE WHEN l.ok THEN l.f[3] END, 'UnKnown') AS province,
    coalesce(CASE WHEN l.ok THEN l.f[4] END, 'UnKnown') AS city
  FROM parsed p LEFT JOIN located l
    ON CAST(split_part(p.targetIp, '.', 1) AS BIGINT) * 16777216
       + CAST(split_part(p.targetIp, '.', 2) AS BIGINT) * 65536
       + CAST(split_part(p.targetIp, '.', 3) AS BIGINT) * 256
       + CAST(split_part(p.targetIp, '.', 4) AS BIGINT) BETWEEN l.startip AND l.endip),
gf AS (
  SELECT * FROM geo
  WHERE (operator <> 'Unknown' OR province <> 'Unknown' OR city <> 'Unknown')
    AND (operator <> '' OR province <> '' OR city <> '')),
flow AS (
  SELECT r.*, g.province FROM records r JOIN geo g ON r.seq = g.seq
  WHERE g.province <> '' AND g.province <> 'UnKnown')
"""

_LOG_COLS = ("accesstime, hostIP, sourceIp, sourcePort, targetIp, targetPort, protocol, "
             "convertedIp, convertedPort")
_REC_COLS = _LOG_COLS + ", username, rowkey"
_GEO_COLS = _LOG_COLS + ", operator, province, city"


def _count5(src: str) -> str:
    return (f"SELECT count(*) AS count_5min, count(*) // 300 AS count_sec, "
            f"strftime(epoch_ms(accesstime), '%Y-%m-%d %H:%M:%S') AS update_time "
            f"FROM {src} GROUP BY accesstime")


def _dim(name: str) -> str:
    return (f"SELECT '{name}' AS types, {name} AS data, count(*) AS count, "
            f"accesstime // 1000 AS accesstime FROM gf GROUP BY {name}, accesstime")


_TAILS = {
    "parse_nat_log": f"SELECT {_LOG_COLS} FROM parsed",
    "parse_rejects": ("SELECT seq, line, 'converted' AS reason FROM lines "
                      "WHERE seq % 97 <> 0 AND seq % 101 <> 0 AND seq % 103 = 0"),
    "log_count_5min": _count5("parsed"),
    "nat_records": f"SELECT {_REC_COLS} FROM records",
    "user_activity": ("SELECT username, accesstime, strftime(epoch_ms(accesstime), '%Y%m%d') AS dt, "
                      "'(' || username || ',' || CAST(accesstime AS VARCHAR) || ')' AS line "
                      "FROM records"),
    "matched_count_5min": _count5("records"),
    "secondary_index": ("SELECT sourceIp, sourcePort, targetIp, targetPort, convertedIp, "
                        "convertedPort, CAST(accesstime AS VARCHAR) AS accesstime, rowkey "
                        "FROM records"),
    "record_store": ("SELECT rowkey, strftime(epoch_ms(accesstime), '%Y-%m-%d %H:%M:%S') AS accesstime, "
                     "hostIP, sourceIp, sourcePort, targetIp, targetPort, protocol, convertedIp, "
                     "convertedPort, username, "
                     "CAST(CASE WHEN seq % 50 = 0 THEN 1 ELSE 0 END AS BIGINT) AS batch_id "
                     "FROM records"),
    "index_lookup": (f"SELECT {_REC_COLS} FROM records WHERE targetPort = '443' "
                     "AND accesstime BETWEEN 1704153600000 AND 1704758400000"),
    "resolve_geo": f"SELECT {_GEO_COLS} FROM geo",
    "geo_filter": f"SELECT {_GEO_COLS} FROM gf",
    "province_count_5min": _dim("province"),
    "operator_count_5min": _dim("operator"),
    "city_count_5min": _dim("city"),
    "dim_count_docs": ("SELECT types, data, CAST(count AS VARCHAR) AS count, "
                       "CAST(accesstime AS VARCHAR) AS accesstime FROM ("
                       + " UNION ALL ".join(_dim(d) for d in ("province", "operator", "city"))
                       + ") d"),
    "hot_targets": ("SELECT (accesstime // 86400000) * 86400000 AS accesstime, targetIp, "
                    "count(*) AS count FROM gf GROUP BY 1, 2 HAVING count(*) > 1"),
    "count_by_province": "SELECT province, count(1) AS resolver FROM flow GROUP BY province",
    "province_running_max": (
        "SELECT province, window_start, CAST(sum(cnt) OVER (PARTITION BY province "
        "ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) "
        "AS resolver FROM (SELECT province, accesstime AS window_start, count(*) AS cnt "
        "FROM flow GROUP BY 1, 2) t"),
    "word_count_windowed": (
        "SELECT (epoch_us(ts) // 5000000) * 5000 AS window_start, word, count(*) AS count "
        "FROM (SELECT ts, unnest(string_split(line, ' ')) AS word FROM lines) w "
        "GROUP BY 1, 2"),
    "ip_to_long": (
        "SELECT ip, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 "
        "+ CAST(split_part(ip, '.', 2) AS BIGINT) * 65536 "
        "+ CAST(split_part(ip, '.', 3) AS BIGINT) * 256 "
        "+ CAST(split_part(ip, '.', 4) AS BIGINT) AS ip_long "
        "FROM (SELECT sourceIp AS ip FROM parsed UNION SELECT targetIp FROM parsed) t"),
    "app_name": (
        "SELECT p.seq, p.targetIp, coalesce((SELECT arg_max(a.app, a.ord) FROM apps a "
        "WHERE a.a_start <= p.ip AND p.ip < a.a_end), '其他') AS app "
        "FROM (SELECT seq, targetIp, CAST(split_part(targetIp, '.', 1) AS BIGINT) * 16777216 "
        "+ CAST(split_part(targetIp, '.', 2) AS BIGINT) * 65536 "
        "+ CAST(split_part(targetIp, '.', 3) AS BIGINT) * 256 "
        "+ CAST(split_part(targetIp, '.', 4) AS BIGINT) AS ip FROM parsed) p"),
    "task_time": (
        "SELECT event_id, "
        "epoch_ms(date_trunc('hour', ts)) // 1000 AS hour_current, "
        "epoch_ms(date_trunc('hour', ts)) // 1000 - 3600 AS hour_previous, "
        "epoch_ms(date_trunc('day', ts)) // 1000 + (hour(ts) // 6 * 6) * 3600 AS six_hour_current, "
        "epoch_ms(date_trunc('day', ts)) // 1000 + (hour(ts) // 6 * 6) * 3600 - 21600 AS six_hour_previous, "
        "epoch_ms(date_trunc('day', ts)) // 1000 AS day_current, "
        "epoch_ms(date_trunc('day', ts)) // 1000 - 86400 AS day_previous, "
        "epoch_ms(date_trunc('hour', ts)) // 1000 + (minute(ts) // 5 * 5) * 60 AS minute5_current, "
        "epoch_ms(date_trunc('hour', ts)) // 1000 + (minute(ts) // 5 * 5) * 60 - 300 AS minute5_previous "
        "FROM events"),
    "msg_time": "SELECT event_id, (epoch_us(ts) // 300000000) * 300 AS msg_time FROM events",
    "md5_hex": ("SELECT seq, md5(sourceIp || sourcePort || targetIp || targetPort || convertedIp "
                "|| convertedPort) AS md5 FROM parsed"),
}

# CTEs needed only by single queries (kept out of BASE so the others stay short).
_EXTRA = {
    "app_name": (
        ", apps AS ("
        "SELECT CAST(20 + 8 * n_nationkey AS BIGINT) * 16777216 AS a_start, "
        "CAST(20 + 8 * n_nationkey AS BIGINT) * 16777216 + 6 * 16777216 AS a_end, "
        "'APP_' || CAST(n_nationkey % 6 AS VARCHAR) AS app, CAST(n_nationkey AS BIGINT) AS ord "
        "FROM nation UNION ALL "
        "SELECT CAST(20 + 8 * n_nationkey AS BIGINT) * 16777216 + 3 * 16777216, "
        "CAST(20 + 8 * n_nationkey AS BIGINT) * 16777216 + 6 * 16777216, 'OVERLAY', CAST(100 AS BIGINT) "
        "FROM nation WHERE n_nationkey = 0)\n"),
    "word_count": (
        ", doc_lines AS (SELECT unnest(string_split(regexp_replace(text, '\\r?\\n$', ''), chr(10))) "
        "AS line FROM documents WHERE text <> ''), "
        "doc_words AS (SELECT CASE WHEN line = '' THEN [''] "
        "ELSE string_split(regexp_replace(line, ' +$', ''), ' ') END AS ws FROM doc_lines "
        "WHERE line = '' OR regexp_replace(line, ' +$', '') <> '')\n"),
}
_EXTRA["hourly_profile"] = (
    ", hb AS (SELECT user_id, strftime(ts, '%H') AS hour, "
    "arg_max(CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR), event_id) AS byte "
    "FROM events GROUP BY 1, 2), "
    "slots AS (SELECT lpad(CAST(i AS VARCHAR), 2, '0') AS hour FROM range(24) t(i)), "
    "ukeys AS (SELECT DISTINCT user_id FROM events)\n")
_TAILS["hourly_profile"] = (
    "SELECT u.user_id, string_agg(s.hour || '=' || coalesce(hb.byte, '0'), ',' ORDER BY s.hour) "
    "AS profile FROM ukeys u CROSS JOIN slots s "
    "LEFT JOIN hb ON hb.user_id = u.user_id AND hb.hour = s.hour GROUP BY u.user_id")
_TAILS["stream_log_count_5min"] = (
    _count5("parsed") + " HAVING accesstime < (SELECT max(accesstime) FROM parsed)")
_TAILS["stream_matched_count_5min"] = (
    _count5("records") + " HAVING accesstime < (SELECT max(accesstime) FROM records)")
# The chained form also counts the users of a window.
_TAILS["stream_matched_chained"] = (
    "SELECT count(*) AS count_5min, count(*) // 300 AS count_sec, "
    "strftime(epoch_ms(accesstime), '%Y-%m-%d %H:%M:%S') AS update_time, count(DISTINCT username) AS users "
    "FROM records GROUP BY accesstime HAVING accesstime < (SELECT max(accesstime) FROM records)")
_TAILS["stream_province_changes"] = _TAILS["province_running_max"]
# Windows that the slowest host has passed.
_TAILS["stream_source_watermark"] = (
    _count5("parsed") + " HAVING accesstime + 300000 <= (SELECT min(m) FROM "
    "(SELECT max(accesstime) AS m FROM parsed GROUP BY hostIP) h)")
_TAILS["parse_accounting"] = (
    "SELECT figure, count(*) FILTER (figure = 'lines' OR figure = kind) AS rows FROM "
    "(SELECT CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN 'without_arity' "
    "WHEN event_id % 103 = 0 THEN 'rejected' ELSE 'accepted' END AS kind FROM events) e, "
    "(VALUES ('lines'), ('accepted'), ('rejected'), ('without_arity')) f(figure) GROUP BY figure")
_TAILS["stream_dim_count_5min"] = (
    "SELECT * FROM (" + " UNION ALL ".join(_dim(d) for d in ("province", "operator", "city"))
    + ") d WHERE accesstime < (SELECT max(accesstime) // 1000 FROM gf)")
_TAILS["word_count"] = ("SELECT word, count(*) AS count FROM "
                        "(SELECT unnest(ws) AS word FROM doc_words) t GROUP BY word")


# Sinks read back: the rows of the query that is written.
for _key, _same in {"upsert_records": "record_store", "upsert_index": "secondary_index",
                    "write_counts": "log_count_5min", "dim_docs_sink": "dim_count_docs"}.items():
    _TAILS[_key] = _TAILS[_same]
# Three batches: everything, every 50th record, every 7th; the last put of a key stays.
_TAILS["compact_store"] = _TAILS["record_store"].replace(
    "CASE WHEN seq % 50 = 0 THEN 1 ELSE 0 END", "CASE WHEN seq % 7 = 0 THEN 2 WHEN seq % 50 = 0 THEN 1 ELSE 0 END")
_TAILS["compact_user_log"] = (
    "SELECT '(' || username || ',' || CAST(accesstime AS VARCHAR) || ')' AS line, "
    "strftime(epoch_ms(accesstime), '%Y%m%d') AS dt, b.batch_id "
    "FROM records JOIN (VALUES (0::BIGINT, 1), (1::BIGINT, 50), (2::BIGINT, 7)) b(batch_id, every) "
    "ON seq % b.every = 0")
_TAILS["write_user_log"] = f"SELECT line, dt FROM ({_TAILS['user_activity']}) u"
_TAILS["json_docs"] = (
    "SELECT '{\"types\":\"' || types || '\",\"data\":\"' || data || '\",\"count\":\"' || count || "
    "'\",\"accesstime\":\"' || accesstime || '\"}' AS doc FROM (" + _TAILS["dim_count_docs"] + ") j")
_TAILS["text_overwrite"] = (
    "SELECT CAST(window_start AS VARCHAR) || ',' || word || ',' || CAST(count AS VARCHAR) AS line FROM ("
    + _TAILS["word_count_windowed"] + ") t")
_TAILS["online_users"] = "SELECT framedip, loginname, CAST(seen_at AS BIGINT) AS seen_at FROM users"
_TAILS["ip_ranges"] = (
    "SELECT startip, endip, local, (SELECT count(*) FROM parsed p WHERE CAST(split_part(p.targetIp, '.', 1) AS BIGINT) "
    "* 16777216 + 8 BETWEEN startip AND endip) AS n_logs FROM ranges")

# Every address against every range: the covering range of lowest end wins.
_OVERLAP = f""",
extra(tag, skip, blocks) AS (VALUES ('IN', 2, 1), ('LATE', 5, 2)),
overlapping AS (
  SELECT startip, endip, local FROM ranges
  UNION ALL
  SELECT startip + skip * {_T24}, startip + (skip + blocks) * {_T24} - 1,
         'AS|CC|' || tag || '_' || CAST((startip // {_T24} - 20) // 8 AS VARCHAR) || '|' || tag
         || '|D|ISP_' || tag || '|1|E|X|1|2' FROM ranges, extra),
fields AS (
  SELECT startip, endip,
    CASE WHEN len(string_split(regexp_replace(local, '\\|+$', ''), '|')) >= 11 THEN string_split(local, '|')
         ELSE ['', '', 'UnKnown', 'UnKnown', '', 'UnKnown'] END AS f FROM overlapping)
"""
_NUMBER = " + ".join(f"CAST(split_part(targetIp, '.', {i + 1}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4))
_EXTRA["resolve_geo_overlap"] = (
    _OVERLAP + f", targets AS (SELECT DISTINCT targetIp, {_NUMBER} AS v FROM parsed), "
    "hit AS (SELECT targetIp, arg_min(f, endip) AS f FROM targets JOIN fields "
    "ON v BETWEEN startip AND endip GROUP BY targetIp)\n")
_PLACE = ("coalesce(f[6], 'UnKnown') AS operator, coalesce(f[3], 'UnKnown') AS province, "
          "coalesce(f[4], 'UnKnown') AS city")
_TAILS["resolve_geo_overlap"] = f"SELECT parsed.*, {_PLACE} FROM parsed LEFT JOIN hit USING (targetIp)".replace(
    "parsed.*", ", ".join(f"parsed.{c.strip()}" for c in _LOG_COLS.split(",")))
_EXTRA["geo_edges"] = (
    _OVERLAP + f", ends AS (SELECT event_id, (20 + 8 * (event_id % 25)) * {_T24} + CASE event_id % 4 WHEN 0 THEN 0 "
    f"WHEN 1 THEN 6 * {_T24} - 1 WHEN 2 THEN 6 * {_T24} ELSE -1 END AS v FROM events), "
    "dotted AS (SELECT *, concat_ws('.', v // 16777216, v // 65536 % 256, v // 256 % 256, v % 256) AS ip FROM ends), "
    "addresses AS (SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE v END AS v, CASE event_id % 3 "
    "WHEN 0 THEN ip WHEN 1 THEN '0' || ip ELSE split_part(ip, '.', 1) || '.' || split_part(ip, '.', 2) || '.' "
    "|| split_part(ip, '.', 3) END AS targetIp FROM dotted), "
    "hit AS (SELECT v, arg_min(f, endip) AS f FROM (SELECT DISTINCT v FROM addresses) a JOIN fields "
    "ON v BETWEEN startip AND endip GROUP BY v)\n")
_TAILS["geo_edges"] = (f"SELECT event_id, targetIp, coalesce(v, 0) AS ip_long, {_PLACE} FROM addresses LEFT JOIN hit USING (v)")


def oracle_sql() -> dict[str, str]:
    return {k: BASE + _EXTRA.get(k, "") + tail for k, tail in _TAILS.items()}
