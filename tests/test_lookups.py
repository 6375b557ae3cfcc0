import pytest
from pyspark.sql import functions as F

from natspark.operators.broadcast import row_count_at_most
from natspark.operators.enrich import enrich_user, index_docs, index_lookup, latest_users
from natspark.operators.geo import app_name, geo_filter, parse_location, resolve_geo
from natspark.operators.rangejoin import sweep_lookup
from tests.conftest import rows

LOG_SCHEMA = ("accesstime long, hostIP string, sourceIp string, sourcePort string, "
              "targetIp string, targetPort string, protocol string, convertedIp string, "
              "convertedPort string")


def logs(spark, pairs):
    """pairs: (sourceIp, targetIp)"""
    return spark.createDataFrame(
        [(1000 * i, "h", s, "1", t, "2", "TCP", "9.9.9.9", "3") for i, (s, t) in enumerate(pairs)],
        LOG_SCHEMA)


def users(spark, data):
    return spark.createDataFrame(data, "framedip string, loginname string, seen_at long")


def test_last_login_wins(spark):
    u = users(spark, [("1.1.1.1", "old", 0), ("1.1.1.1", "new", 5), ("2.2.2.2", "x", 1)])
    assert rows(latest_users(u)) == [("1.1.1.1", "new"), ("2.2.2.2", "x")]


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_enrich_drops_unknown(spark, max_rows):
    lg = logs(spark, [("1.1.1.1", "5.0.0.1"), ("2.2.2.2", "5.0.0.1"), ("3.3.3.3", "5.0.0.1"),
                      ("4.4.4.4", "5.0.0.1")])
    u = users(spark, [("1.1.1.1", "alice", 1), ("2.2.2.2", "UnKnown", 1), ("4.4.4.4", None, 1)])
    out = enrich_user(lg, u, max_broadcast_rows=max_rows)
    assert rows(out, "sourceIp", "username") == [("1.1.1.1", "alice")]
    kept = enrich_user(lg, u, keep_unknown=True, max_broadcast_rows=max_rows)
    assert rows(kept, "sourceIp", "username") == [
        ("1.1.1.1", "alice"), ("2.2.2.2", "UnKnown"), ("3.3.3.3", "UnKnown"), ("4.4.4.4", "UnKnown")]
    assert out.first().rowkey.endswith("_0")


def test_broadcast_bound(spark):
    df = spark.range(10)
    assert row_count_at_most(df, 10) and not row_count_at_most(df, 9)


def ranges(spark, data):
    return spark.createDataFrame(data, "startip long, endip long, local string")


GOOD_LOCAL = "AS|CC|PROV|CITY|D|ISP|1|E|X|1|2"


def ip(a, b, c, d):
    return (a << 24) + (b << 16) + (c << 8) + d


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_geo_inclusive_ends_and_field_rule(spark, max_rows):
    r = ranges(spark, [
        (ip(10, 0, 0, 0), ip(10, 0, 0, 255), GOOD_LOCAL),
        (ip(11, 0, 0, 0), ip(12, 255, 255, 255), "AS|CC|P|C|D|ISP|1|E|X|1"),     # 10 fields
        (ip(13, 0, 0, 0), ip(13, 0, 0, 9), "AS|CC|P|C|D|ISP|1|E|X|1|"),          # 11 with trailing empty
        (ip(14, 0, 0, 0), ip(14, 0, 0, 9), "   "),                                # blank
    ])
    lg = logs(spark, [("s", "10.0.0.0"), ("s", "10.0.0.255"), ("s", "10.0.1.0"), ("s", "12.9.9.9"),
                      ("s", "13.0.0.5"), ("s", "14.0.0.1"), ("s", "300.1.1.1"), ("s", "bad")])
    out = resolve_geo(lg, r, max_broadcast_rows=max_rows)
    got = rows(out, "targetIp", "operator", "province", "city")
    unk = ("UnKnown",) * 3
    assert got == sorted([("10.0.0.0", "ISP", "PROV", "CITY"), ("10.0.0.255", "ISP", "PROV", "CITY"),
                          ("10.0.1.0",) + unk, ("12.9.9.9",) + unk, ("13.0.0.5",) + unk,
                          ("14.0.0.1",) + unk, ("300.1.1.1",) + unk, ("bad",) + unk])


def test_geo_plan_has_no_nested_loop(spark):
    r = ranges(spark, [(ip(10, 0, 0, 0), ip(10, 0, 0, 255), GOOD_LOCAL)])
    plan = resolve_geo(logs(spark, [("s", "10.0.0.1")]), r)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "BroadcastHashJoin" in plan


def test_sweep_matches_bruteforce(spark):
    import random
    rnd = random.Random(7)
    starts = sorted(rnd.sample(range(0, 1 << 32, 997), 300))
    data = []
    for i, s in enumerate(starts[:-1]):
        e = s + rnd.randrange(1, starts[i + 1] - s + 1) - 1
        data.append((s, e, f"R{i}"))
    rg = spark.createDataFrame(data, "lo long, hi long, name string")
    pts = [rnd.randrange(0, 1 << 32) for _ in range(2000)] + [d[0] for d in data[:50]] + [d[1] for d in data[:50]]
    pdf = spark.createDataFrame([(p,) for p in pts], "p long")
    got = dict((r.p, r.name) for r in sweep_lookup(pdf, "p", rg, "lo", "hi", ["name"], bits=16).collect())
    for p in set(pts):
        want = next((n for lo, hi, n in data if lo <= p <= hi), None)
        assert got[p] == want, p


def test_geo_filter_sentinel_casing(spark):
    df = spark.createDataFrame([("UnKnown", "UnKnown", "UnKnown"), ("", "", ""), ("Unknown", "Unknown", "Unknown"),
                                ("", "P", ""), ("ISP", "P", "C")], "operator string, province string, city string")
    assert rows(geo_filter(df)) == sorted([("UnKnown", "UnKnown", "UnKnown"), ("", "P", ""), ("ISP", "P", "C")])
    assert rows(geo_filter(df, drop_unresolved=True)) == sorted(
        [("", "P", ""), ("ISP", "P", "C"), ("Unknown", "Unknown", "Unknown")])


def test_parse_location_fields(spark):
    r = parse_location(ranges(spark, [(1, 2, GOOD_LOCAL)])).first()
    assert (r.operator, r.province, r.city) == ("ISP", "PROV", "CITY")


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_app_half_open_last_wins(spark, max_rows):
    apps = spark.createDataFrame([(ip(1, 0, 0, 0), ip(2, 0, 0, 0), "A", 1),
                                  (ip(1, 128, 0, 0), ip(1, 200, 0, 0), "B", 2),
                                  (ip(1, 0, 0, 0), ip(1, 0, 0, 10), "C", 0)],
                                 "start long, end long, app string, ord long")
    lg = logs(spark, [("s", "1.0.0.0"), ("s", "1.0.0.5"), ("s", "1.128.0.0"), ("s", "1.200.0.0"),
                      ("s", "2.0.0.0"), ("s", "1.255.255.255"), ("s", "x")])
    out = app_name(lg, apps, max_broadcast_rows=max_rows)
    assert rows(out, "targetIp", "app") == sorted([
        ("1.0.0.0", "A"), ("1.0.0.5", "A"), ("1.128.0.0", "B"), ("1.200.0.0", "A"),
        ("2.0.0.0", "其他"), ("1.255.255.255", "A"), ("x", "其他")])


def test_index_lookup(spark):
    lg = logs(spark, [("1.1.1.1", "5.0.0.1"), ("1.1.1.1", "5.0.0.2")])
    rec = enrich_user(lg, users(spark, [("1.1.1.1", "alice", 1)]))
    idx = index_docs(rec)
    assert idx.columns[-1] == "rowkey" and dict(idx.dtypes)["accesstime"] == "string"
    hit = index_lookup(idx, rec, time_from=500, targetIp="5.0.0.2")
    assert rows(hit, "targetIp", "accesstime") == [("5.0.0.2", 1000)]
    assert index_lookup(idx, rec, time_to=500, targetIp="5.0.0.2").count() == 0


def test_dyadic_containment_matches_bruteforce(spark):
    import random
    from natspark.operators.rangejoin import containing_ranges
    rnd = random.Random(11)
    data = []
    for i in range(60):
        lo = rnd.randrange(0, 1 << 32)
        hi = min((1 << 32) - 1, lo + rnd.choice([0, 1, 255, 65535, rnd.randrange(1 << 28)]))
        data.append((lo, hi, i))
    data.append((0, (1 << 32) - 1, 99))
    rg = spark.createDataFrame(data, "lo long, hi long, rid long")
    pts = [rnd.randrange(0, 1 << 32) for _ in range(300)] + [d[0] for d in data] + [d[1] for d in data]
    pdf = spark.createDataFrame([(p,) for p in set(pts)], "p long")
    got = sorted((r.p, r.rid) for r in containing_ranges(pdf, "p", rg, "lo", "hi").collect())
    want = sorted((p, rid) for p in set(pts) for lo, hi, rid in data if lo <= p <= hi)
    assert got == want


def test_app_segments_overlap_bruteforce(spark):
    import random
    rnd = random.Random(5)
    apps = []
    ords = rnd.sample(range(1000), 40)           # unique: the winner is well defined
    for i in range(40):
        s = rnd.randrange(0, 1 << 24) << 8
        apps.append((s, s + rnd.choice([1, 256, 70000, 1 << 20]), f"A{i}", ords[i]))
    adf = spark.createDataFrame(apps, "start long, end long, app string, ord long")
    ips = [rnd.randrange(0, 1 << 32) for _ in range(200)] + [a[0] for a in apps] + [a[1] for a in apps]
    lg = logs(spark, [("s", "%d.%d.%d.%d" % (p >> 24, (p >> 16) & 255, (p >> 8) & 255, p & 255)) for p in ips])
    got = {r.targetIp: r.app for r in app_name(lg, adf).collect()}
    for p in ips:
        hits = [(o, a) for s, e, a, o in apps if s <= p < e]
        want = max(hits)[1] if hits else "其他"
        key = "%d.%d.%d.%d" % (p >> 24, (p >> 16) & 255, (p >> 8) & 255, p & 255)
        assert got[key] == want, key
