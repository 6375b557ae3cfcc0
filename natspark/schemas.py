"""Fixed record layouts (the reference's case classes, as StructTypes)."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

_S = StringType()
_L = LongType()

ADDRESS_FIELDS = ["sourceIp", "sourcePort", "targetIp", "targetPort",
                  "convertedIp", "convertedPort"]

# Parsed log line.  accesstime is epoch milliseconds floored to 5 minutes.
NAT_LOG = StructType([StructField("accesstime", _L)] + [
    StructField(n, _S) for n in ["hostIP", "sourceIp", "sourcePort", "targetIp",
                                 "targetPort", "protocol", "convertedIp",
                                 "convertedPort"]])
NAT_LOG_COLUMNS = NAT_LOG.fieldNames()

# Log enriched with the logged-in user and the hash row key.
NAT_RECORD = StructType(NAT_LOG.fields + [StructField("username", _S),
                                          StructField("rowkey", _S)])
NAT_RECORD_COLUMNS = NAT_RECORD.fieldNames()

# Log with the target address resolved to operator, province and city.
NAT_GEO = StructType(NAT_LOG.fields + [StructField("operator", _S),
                                       StructField("province", _S),
                                       StructField("city", _S)])

# Online-user dimension.  seen_at orders duplicate framedips (last wins).
ONLINE_USER = StructType([StructField("framedip", _S), StructField("loginname", _S),
                          StructField("seen_at", _L)])

# Geo-IP ranges: inclusive [startip, endip], '|'-delimited location text.
IP_RANGE = StructType([StructField("startip", _L), StructField("endip", _L),
                       StructField("local", _S)])

# Application ranges: half-open [start, end); larger ord wins on overlap.
APP_RANGE = StructType([StructField("start", _L), StructField("end", _L),
                        StructField("app", _S), StructField("ord", _L)])

COUNT_5MIN = StructType([StructField("count_5min", _L), StructField("count_sec", _L),
                         StructField("update_time", _S)])

DIM_COUNT = StructType([StructField(n, _S) for n in
                        ["types", "data", "count", "accesstime"]])

INDEX_DOC_COLUMNS = ADDRESS_FIELDS + ["accesstime", "rowkey"]
INDEX_DOC = StructType([StructField(n, _S) for n in INDEX_DOC_COLUMNS])
