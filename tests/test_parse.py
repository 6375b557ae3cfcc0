import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from natspark.operators.parse import parse_nat_log, parse_rejects
from natspark.schemas import NAT_LOG_COLUMNS

HEAD = "2020-08-17T09:14:58+08:00 10.1.1.1 fw NAT: session log 1.1.1.1:100->2.2.2.2:443(TCP):"
GOOD = HEAD + ", 1.1.1.1:100 snat to 3.3.3.3:2000"


def lines(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, seq long")


def test_good_line(spark):
    r = parse_nat_log(lines(spark, GOOD)).first()
    assert tuple(r) == (1597655400000, "10.1.1.1", "1.1.1.1", "100", "2.2.2.2", "443", "TCP",
                        "3.3.3.3", "2000")
    assert parse_nat_log(lines(spark, GOOD)).columns == NAT_LOG_COLUMNS


def test_protocol_colon_inside_parens(spark):
    line = GOOD.replace("(TCP):", "(UDP:)")
    assert parse_nat_log(lines(spark, line)).first().protocol == "UDP"


def test_arity_filter_drops_silently(spark):
    df = lines(spark, HEAD, HEAD + ",", HEAD + ",,")
    assert parse_nat_log(df).count() == 0
    assert parse_rejects(df).count() == 0


@pytest.mark.parametrize("line,reason", [
    (HEAD + ", no translation", "converted"),
    (HEAD + ",,x", "converted"),
    (GOOD.replace("3.3.3.3:2000", "3.3.3.3:"), "convertedPort"),
    (GOOD.replace("(TCP):", "()"), "protocol"),
    (GOOD.replace("->2.2.2.2:443", "->2.2.2.2"), "targetPort"),
    ("2020-08-17 10.1.1.1 fw NAT: session log 1.1.1.1:1->2.2.2.2:3(TCP), x snat to 3.3.3.3:4",
     "accesstime"),
    ("2020-08-17T09:14:58+08:00 host, x snat to 3.3.3.3:4", "flow"),
])
def test_rejects_keep_reason(spark, line, reason):
    df = lines(spark, line, GOOD)
    rej = parse_rejects(df, keep=["seq"]).collect()
    assert [(r.seq, r.reason, r.line) for r in rej] == [(0, reason, line)]
    assert parse_nat_log(df).count() == 1


def test_extra_converted_parts_ignored(spark):
    r = parse_nat_log(lines(spark, GOOD + ", more, text")).first()
    assert r.convertedIp == "3.3.3.3"


def test_keep_columns_pass_through(spark):
    r = parse_nat_log(lines(spark, GOOD), keep=["seq"]).first()
    assert r.seq == 0


def test_fail_mode_raises(spark):
    df = lines(spark, GOOD, HEAD + ", no translation")
    with pytest.raises(PySparkException):
        parse_nat_log(df, mode="fail").collect()
    assert parse_nat_log(lines(spark, GOOD), mode="fail").count() == 1


def test_unfloored_variant(spark):
    r = parse_nat_log(lines(spark, GOOD), grain_minutes=1).first()
    assert r.accesstime == 1597655640000


def test_parse_plan_is_codegen_only(spark):
    plan = parse_nat_log(lines(spark, GOOD))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "Filter" not in plan.split("Generate")[-1]   # no filter pushed below the parse
