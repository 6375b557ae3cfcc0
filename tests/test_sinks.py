import os

from pyspark.sql import functions as F

from natspark.sinks import (batch_partition_write, latest_by_key, read_keyed_store,
                            record_rows, upsert_index, upsert_records, user_log_lines,
                            write_counts, write_text_overwrite, write_user_log)
from natspark.streaming.pipelines import record_batch_writer
from tests.conftest import rows

LOG_SCHEMA = ("accesstime long, hostIP string, sourceIp string, sourcePort string, "
              "targetIp string, targetPort string, protocol string, convertedIp string, "
              "convertedPort string, seq long")


def logs(spark, n, base=0, host="h"):
    return spark.createDataFrame(
        [(1704067200000 + 300000 * (i % 3), host, "1.1.1.%d" % (i % 2), str(i), "2.2.2.2", "80", "TCP",
          "3.3.3.3", "9", base + i) for i in range(n)], LOG_SCHEMA)


def users(spark):
    return spark.createDataFrame([("1.1.1.0", "alice", 1), ("1.1.1.1", "bob", 1)],
                                 "framedip string, loginname string, seen_at long")


def test_counts_replay_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "counts")
    df = spark.createDataFrame([(3, 0, "2024-01-01 00:00:00")], "count_5min long, count_sec long, update_time string")
    write_counts(df, path, 0)
    write_counts(df, path, 0)            # replay of batch 0
    write_counts(df, path, 1)
    assert spark.read.parquet(path).count() == 2


def test_user_log_lines_and_folders(spark, tmp_path):
    from natspark.operators.enrich import enrich_user
    rec = enrich_user(logs(spark, 4).drop("seq"), users(spark))
    lines = user_log_lines(rec)
    assert set(r.line for r in lines.collect()) >= {"(alice,1704067200000)"}
    assert set(r.dt for r in lines.collect()) == {"20240101"}
    path = str(tmp_path / "userlog")
    write_user_log(rec, path)
    write_user_log(rec, path)            # replay of batch 0
    assert os.path.isdir(os.path.join(path, "batch_id=0", "dt=20240101"))
    assert spark.read.text(path).count() == 4
    write_user_log(rec, path, 1)
    assert spark.read.text(path).count() == 8


def test_record_branch_replay_and_last_wins(spark, tmp_path):
    paths = {k: str(tmp_path / k) for k in ("user_log", "records", "index")}
    writer = record_batch_writer(lambda: users(spark), paths["user_log"], paths["records"],
                                 paths["index"], order="seq")
    batch0 = logs(spark, 6)
    writer(batch0, 0)
    writer(batch0, 0)                    # replay after a failure: no duplicates
    assert spark.read.parquet(paths["records"]).count() == 6
    assert spark.read.parquet(paths["index"]).count() == 6
    assert spark.read.text(paths["user_log"]).count() == 6
    writer(logs(spark, 2, host="h2"), 1)  # same row keys, newer batch
    store = read_keyed_store(spark, paths["records"])
    assert store.count() == 6
    got = rows(store, "sourcePort", "hostIP", "batch_id")
    assert got[:2] == [("0", "h2", 1), ("1", "h2", 1)] and got[2][1:] == ("h", 0)
    assert dict(store.dtypes)["accesstime"] == "string"
    assert store.where(F.col("sourcePort") == "0").first().accesstime == "2024-01-01 00:00:00"


def test_within_batch_dedupe_by_order(spark, tmp_path):
    from natspark.operators.enrich import enrich_user
    a = logs(spark, 1, base=5, host="first")
    b = logs(spark, 1, base=9, host="second")
    rec = enrich_user(a.unionByName(b), users(spark))
    path = str(tmp_path / "rec")
    upsert_records(rec, path, 0, order="seq")
    assert [r.hostIP for r in spark.read.parquet(path).collect()] == ["second"]


def test_latest_by_key(spark):
    df = spark.createDataFrame([("k", "a", 0), ("k", "b", 2), ("j", "c", 1)], "rowkey string, v string, batch_id long")
    assert rows(latest_by_key(df)) == [("j", "c", 1), ("k", "b", 2)]


def test_text_overwrite(spark, tmp_path):
    path = str(tmp_path / "wc")
    df = spark.createDataFrame([("a", 2), ("b", 1)], "word string, count long")
    write_text_overwrite(df, path, single_file=True)
    write_text_overwrite(df, path, single_file=True)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a,2", "b,1"]


def test_dim_docs_json_by_batch(spark, tmp_path):
    from natspark.sinks import append_dim_docs
    path = str(tmp_path / "docs")
    docs = spark.createDataFrame([("city", "C1", "3", "1704067200")], "types string, data string, count string, accesstime string")
    append_dim_docs(docs, path, 0)
    append_dim_docs(docs, path, 0)       # a replay replaces the batch
    append_dim_docs(docs, path, 1)
    back = spark.read.json(path)
    assert back.count() == 2 and set(back.columns) == {"types", "data", "count", "accesstime", "batch_id"}


def test_dimension_loaders(spark, tmp_path):
    from natspark.sources.streams import read_ip_ranges, read_online_users, register_view
    upath = str(tmp_path / "users")
    spark.createDataFrame([("1.1.1.1", "alice", 3)], "framedip string, loginname string, seen_at int") \
        .write.parquet(upath)
    u = read_online_users(spark, upath)
    assert u.dtypes == [("framedip", "string"), ("loginname", "string"), ("seen_at", "bigint")]
    no_order = str(tmp_path / "users2")
    spark.createDataFrame([("1.1.1.1", "bob")], "framedip string, loginname string").write.parquet(no_order)
    assert read_online_users(spark, no_order).first().seen_at == 0
    rpath = str(tmp_path / "ranges.csv")
    with open(rpath, "w") as f:
        f.write("16777216,16777471,AS|CC|P|C|D|ISP|1|E|X|1|2\n")
    r = read_ip_ranges(spark, rpath, fmt="csv")
    assert [tuple(x) for x in r.collect()] == [(16777216, 16777471, "AS|CC|P|C|D|ISP|1|E|X|1|2")]
    register_view(r, "ranges_view")
    assert spark.sql("select count(*) c from ranges_view").first().c == 1
