import pytest
from pyspark.sql import functions as F

from natspark.functions import (floor_minutes_ms, ip_to_long, ip_to_long_strict, jsplit,
                                md5_hex, msg_time, rowkey, strip_protocol, task_time,
                                text_lines, to_json_doc)
from natspark.operators.aggregate import log_count_5min


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first().r


@pytest.mark.parametrize("text,sep,expected", [
    ("a,", ",", ["a"]),
    ("", ",", [""]),
    (",", ",", []),
    ("a,,b,,", ",", ["a", "", "b"]),
    (" ", " ", []),
    ("1.2.3.4:", ":", ["1.2.3.4"]),
    ("a:1->b:2()", "[->()]", ["a:1", "", "b:2"]),
    (" a  b ", r"\s+", ["", "a", "b"]),
    ("x snat to ", " snat to ", ["x"]),
    ("a,\n", ",", ["a", "\n"]),
])
def test_jsplit_java_contract(spark, text, sep, expected):
    assert one(spark, jsplit(F.col("v"), sep), text) == expected


def test_jsplit_null(spark):
    assert one(spark, jsplit(F.col("v"), ","), None) is None


def test_floor_time_offset_ignored(spark):
    assert one(spark, floor_minutes_ms("v"), "2020-08-17T09:14:58+08:00") == 1597655400000
    assert one(spark, msg_time("v"), "2020-08-17T09:14:58+08:00") == 1597655400


@pytest.mark.parametrize("text,grain,expected_minute", [
    ("2020-08-17T09:04:59+08:00", 5, 0),
    ("2020-08-17T09:05:00+08:00", 5, 5),
    ("2020-08-17T09:59:59+08:00", 5, 55),
    ("2020-08-17T09:07:30+08:00", 1, 7),
])
def test_floor_grain(spark, text, grain, expected_minute):
    ms = one(spark, floor_minutes_ms("v", grain), text)
    assert ms == 1597654800000 + expected_minute * 60000


@pytest.mark.parametrize("bad", ["2020-08-17", "garbage-text-here", "2020-08-17T09:x4:00", ""])
def test_floor_time_unparseable_is_null(spark, bad):
    assert one(spark, floor_minutes_ms("v"), bad) is None


def test_ip_to_long(spark):
    assert one(spark, ip_to_long("v"), "183.182.31.255") == (183 << 24) + (182 << 16) + (31 << 8) + 255
    assert one(spark, ip_to_long("v"), "1.2.3") == 0
    assert one(spark, ip_to_long("v"), "1.2.3.4.") == 16909060   # trailing empty part dropped
    assert one(spark, ip_to_long("v"), "1.2.3.4.5") == 0
    assert one(spark, ip_to_long("v"), "1.2.3.x") is None
    assert one(spark, ip_to_long_strict("v"), "1.2.3.256") is None
    assert one(spark, ip_to_long_strict("v"), "255.255.255.255") == (1 << 32) - 1


def test_md5_rowkey_literal(spark):
    text = "100.105.57.15959544220.249.46.438058.101.147.20462685"
    assert one(spark, F.substring(md5_hex("v"), 9, 16), text) == "0001514e537dadea"
    df = spark.createDataFrame(
        [("100.105.57.159", "59544", "220.249.46.43", "80", "58.101.147.204", "62685", 7)],
        "sourceIp string, sourcePort string, targetIp string, targetPort string, "
        "convertedIp string, convertedPort string, accesstime long")
    assert df.select(rowkey().alias("k")).first().k == "0001514e537dadea_7"


def test_strip_protocol(spark):
    assert one(spark, strip_protocol("v"), "TCP:") == "TCP"
    assert one(spark, strip_protocol("v"), "TCP") == "TCP"
    assert one(spark, strip_protocol("v"), "TCP::") == "TCP:"


def test_task_time(spark):
    t = one(spark, task_time("v"), 1597655698, "v long")   # 2020-08-17 09:14:58 UTC
    assert t.hour.current == 1597654800 and t.hour.previous == 1597654800 - 3600
    assert t.six_hour.current == 1597644000 and t.six_hour.previous == 1597644000 - 21600
    assert t.day.current == 1597622400 and t.day.previous == 1597622400 - 86400
    assert t.minute5.current == 1597655400 and t.minute5.previous == 1597655100


def test_text_lines(spark):
    assert one(spark, text_lines("v"), "a\nb\n") == ["a", "b"]
    assert one(spark, text_lines("v"), "a\r\n\nb") == ["a", "", "b"]
    assert one(spark, text_lines("v"), "\n") == [""]
    assert one(spark, text_lines("v"), "") == []


def test_json_doc_all_strings(spark):
    df = spark.createDataFrame([("x", 5)], "a string, n long")
    assert df.select(to_json_doc(["a", "n"]).alias("j")).first().j == '{"a":"x","n":"5"}'


def test_count_sec_integer_division(spark):
    df = spark.range(899).select(F.timestamp_seconds(F.lit(0)).alias("ts"))
    r = log_count_5min(df).first()
    assert (r.count_5min, r.count_sec, r.update_time) == (899, 2, "1970-01-01 00:00:00")
