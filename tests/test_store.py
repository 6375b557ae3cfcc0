"""The merged store: versions, late replays, pruned searches."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from natspark.operators.enrich import store_lookup
from natspark.sinks import INDEX, RECORDS, USER_LOG, Store, batch_partition_write, bucket_digits, index_rows
from natspark.sinks.folders import Folder
from tests.conftest import rows

DAY = 86_400_000
SCHEMA = "rowkey string, day long, value string"


def put(spark, path, batch, items):
    df = spark.createDataFrame([(k, d, v) for k, d, v in items], SCHEMA)
    batch_partition_write(df, path, batch, partition_cols=("day",))


def contents(store, *days):
    return rows(store.read(*days), "rowkey", "day", "value", "batch_id")


def files_read(df):
    """Files that the scans of ``df`` open, once it has run."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        metrics = node.metrics()
        if metrics.contains("numFiles"):
            found += metrics.apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "store")


def test_merged_days_read_as_before_and_batches_on_top(spark, path):
    store = Store(spark, path, RECORDS)
    put(spark, path, 0, [("a1", 1, "x"), ("b1", 1, "x"), ("c2", 2, "x")])
    put(spark, path, 1, [("a1", 1, "y"), ("d3", 3, "y")])
    before = contents(store)
    assert before == [("a1", 1, "y", 1), ("b1", 1, "x", 0), ("c2", 2, "x", 0), ("d3", 3, "y", 1)]
    assert store.compact(before_day=3) == 1 and contents(store) == before
    put(spark, path, 1, [("a1", 1, "y"), ("d3", 3, "y")])              # a late replay of a merged batch
    put(spark, path, 2, [("b1", 1, "z"), ("e2", 2, "z")])              # late rows of closed days
    after = [("a1", 1, "y", 1), ("b1", 1, "z", 2), ("c2", 2, "x", 0), ("d3", 3, "y", 1), ("e2", 2, "z", 2)]
    assert contents(store) == after
    assert contents(store, 2, 2) == [("c2", 2, "x", 0), ("e2", 2, "z", 2)]
    assert store.compact() == 2 and contents(store) == after
    assert store.compact() == 2                                         # nothing new to merge
    assert sorted(store.manifest()["days"]) == ["1", "2", "3"] and store.batch_files()
    assert store.vacuum() > 0 and contents(store) == after
    assert not store.batch_files() and not [n for n in os.listdir(path) if n.startswith("batch_id")]


def test_files_of_a_version_are_not_read_again(spark, path):
    store = Store(spark, path, replace(RECORDS, digits=0))
    for b in range(6):
        put(spark, path, b, [(f"a{b}", 1, "x"), (f"b{b}", 2, "x")])
    held = set(store.batch_files())
    many = files_read(store.read())
    store.compact()
    merged = store.read()
    assert many >= 12 and files_read(merged) < many / 2 and "Exchange" not in merged._jdf.queryExecution().toString()
    used = {r[0] for r in merged.select(F.input_file_name()).distinct().collect()}
    assert used and not any(h in u for h in held for u in used)
    # the batches are still there, but a reader of the version skips them
    for name in list(held)[:3]:
        os.remove(f"{path}/{name}")
    assert contents(store) == sorted((f"{c}{b}", d, "x", b) for b in range(6) for c, d in (("a", 1), ("b", 2)))


def test_a_merge_that_fails_changes_nothing(spark, path, monkeypatch):
    store = Store(spark, path, RECORDS)
    put(spark, path, 0, [("a1", 1, "x")])
    store.compact()
    put(spark, path, 1, [("a1", 1, "y"), ("b1", 1, "y")])
    before = contents(store)

    def lost(manifest):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_publish", lost)
        with pytest.raises(OSError):
            store.compact()
    assert store.version() == 1 and contents(store) == before
    assert store.compact() == 2 and contents(store) == before
    # two writers of one version: the second doesn't publish
    folder = Folder(spark, f"{path}/_manifest")
    assert not folder.publish("00000002.json", "{}") and contents(store) == before


def test_user_log_replay_replaces_its_lines(spark, path):
    def log(batch, lines):
        df = spark.createDataFrame(lines, "value string, dt long")
        batch_partition_write(df, path, batch, fmt="text", partition_cols=("dt",))

    store = Store(spark, path, USER_LOG)
    log(0, [("(a,1)", 20240101), ("(a,1)", 20240101), ("(b,2)", 20240102)])
    log(1, [("(c,3)", 20240101)])
    want = [("(a,1)", 20240101, 0), ("(a,1)", 20240101, 0), ("(b,2)", 20240102, 0), ("(c,3)", 20240101, 1)]
    assert rows(store.read(), "value", "dt", "batch_id") == want
    store.compact()
    store.vacuum()
    assert rows(store.read(), "value", "dt", "batch_id") == want
    log(1, [("(c,3)", 20240101)])
    log(2, [("(d,4)", 20240102)])
    assert rows(store.read(), "value", "dt", "batch_id") == sorted([*want, ("(d,4)", 20240102, 2)])


def test_empty_stores(spark, path):
    os.makedirs(path)
    store = Store(spark, path, RECORDS)
    assert store.compact() == 0 and store.vacuum() == 0
    with pytest.raises(FileNotFoundError):
        store.read()
    put(spark, path, 0, [("a1", 1, "x")])
    assert store.read(5, 6).count() == 0 and store.read(5, 6).columns == store.read().columns


def _records(spark, n=4000):
    r = spark.range(n)
    return r.select(
        (F.col("id") % 8 * DAY + F.col("id")).alias("accesstime"),
        F.concat(F.lit("1.1.1."), F.col("id") % 50).alias("sourceIp"), (F.col("id") % 900).cast("string").alias("sourcePort"),
        F.concat(F.lit("2.2."), F.col("id") % 200, F.lit(".1")).alias("targetIp"),
        (F.col("id") % 40).cast("string").alias("targetPort"), F.lit("3.3.3.3").alias("convertedIp"),
        F.col("id").cast("string").alias("convertedPort"),
        F.concat(F.substring(F.md5(F.col("id").cast("string")), 9, 16), F.lit("_"), F.col("id")).alias("rowkey"),
        (F.col("id") % 8).alias("day"))


def test_search_prunes_days_buckets_and_row_groups(spark, tmp_path):
    rec = _records(spark)
    stored = Store(spark, str(tmp_path / "records"), RECORDS)
    index = Store(spark, str(tmp_path / "index"), INDEX)
    stored.load(rec, tasks=4)
    index.load(index_rows(rec), tasks=4)
    every = files_read(stored.read())
    assert every >= 8 * 16
    found = store_lookup(index, stored, 2 * DAY, 3 * DAY - 1, targetPort="2", targetIp="2.2.42.1")
    want = rec.where("day = 2 AND targetPort = '2' AND targetIp = '2.2.42.1'")
    assert rows(found, "rowkey") == rows(want, "rowkey") and found.count() == 20
    plan = found._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan and "day" in plan and "bucket" in plan
    one = store_lookup(index, stored, convertedPort="1234")
    assert [r.rowkey for r in one.collect()] == [r.rowkey for r in rec.where("convertedPort = '1234'").collect()]
    # one hit: of 128 files of records one is opened
    hit = spark.createDataFrame([(one.first().rowkey, 1234 % 8)], "rowkey string, day long")
    assert files_read(stored.fetch(hit.where("day >= 0"), small=True)) < every / 4
    assert store_lookup(index, stored, targetPort="no").count() == 0
    with pytest.raises(ValueError):
        stored.load(rec)


def test_merged_files_are_sorted_and_carry_bloom_filters(spark, tmp_path):
    import pyarrow.parquet as pq

    index = Store(spark, str(tmp_path / "index"), INDEX)
    index.load(index_rows(_records(spark, 30_000)), tasks=2)
    base = tmp_path / "index" / "_compacted" / "v=1" / "day=3" / "bucket=all"
    names = [n for n in os.listdir(base) if n.endswith(".parquet")]
    ports = pq.read_table(base / sorted(names)[0]).column("targetPort").to_pylist()
    assert ports == sorted(ports)
    raw = (base / sorted(names)[0]).read_bytes()
    plain = tmp_path / "plain"
    index.read(3, 3).coalesce(1).write.parquet(str(plain))
    assert len(raw) > os.path.getsize(next(plain.glob("*.parquet")))   # the filters take room


@pytest.mark.parametrize("layout", [RECORDS, replace(RECORDS, digits=0), INDEX])
def test_a_merge_shuffles_once(spark, tmp_path, layout):
    rows_in = index_rows(_records(spark, 100)) if layout is INDEX else _records(spark, 100)
    rows_in.withColumn("batch_id", F.lit(0)).write.parquet(str(tmp_path / "in"))
    plan = Store(spark, str(tmp_path / "s"), layout)._sorted(spark.read.parquet(str(tmp_path / "in")), 4)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Exchange rangepartitioning" in text


def test_bucket_digits():
    assert bucket_digits(100, 10) == 0 and bucket_digits(10**9, 10) == 1 and bucket_digits(10**12, 1) == 4
