import os

from natspark import app
from natspark.plans import batch
from natspark.sources.fixtures import ip_ranges, online_users, read_table
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def _inputs(spark, tmp_path):
    lines_dir = str(tmp_path / "lines")
    batch.lines(spark, SF).select("value").write.text(lines_dir)
    users = str(tmp_path / "users")
    online_users(read_table(spark, SF, "customer")).write.parquet(users)
    ranges = str(tmp_path / "ranges")
    ip_ranges(read_table(spark, SF, "nation")).write.parquet(ranges)
    return lines_dir, users, ranges


def test_batch_command(spark, tmp_path):
    lines_dir, users, ranges = _inputs(spark, tmp_path)
    out = str(tmp_path / "out")
    assert app.main(["batch", "--lines", lines_dir, "--users", users, "--ranges", ranges,
                     "--out", out], spark) == 0
    assert spark.read.parquet(f"{out}/records").count() == batch.nat_records(spark, SF).count()
    docs = spark.read.json(f"{out}/dim_docs").select("types", "data", "count", "accesstime")
    assert rows(docs) == rows(batch.dim_count_docs(spark, SF))


def test_stream_command_available_now(spark, tmp_path):
    lines_dir, users, ranges = _inputs(spark, tmp_path)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    assert app.main(["stream", "--text-dir", lines_dir, "--users", users, "--ranges", ranges,
                     "--out", out, "--checkpoint", ckpt, "--available-now"], spark) == 0
    counts = spark.read.parquet(f"{out}/log_count")
    full = rows(batch.log_count_5min(spark, SF))
    newest = max(r[2] for r in full)
    assert rows(counts) == [r for r in full if r[2] != newest]
    assert spark.read.parquet(f"{out}/records").count() == batch.nat_records(spark, SF).count()
    from natspark.streaming.pipelines import read_matched_counts
    assert rows(read_matched_counts(spark, f"{out}/matched_partials")) == \
        rows(batch.matched_count_5min(spark, SF))
    for sub in ("dim_docs", "index", "username"):
        assert os.path.isdir(f"{out}/{sub}")


def test_stream_command_parses_once_and_a_rerun_adds_nothing(spark, tmp_path):
    lines_dir, users, ranges = _inputs(spark, tmp_path)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    args = ["stream", "--text-dir", lines_dir, "--users", users, "--ranges", ranges,
            "--out", out, "--checkpoint", ckpt, "--available-now"]

    def kept():
        parsed = spark.read.parquet(f"{out}/parsed")
        return {"accepted": parsed.where("reason IS NULL").count(),
                "rejected": parsed.where("reason IS NOT NULL").count(),
                **{d: spark.read.parquet(f"{out}/{d}").count()
                   for d in ("log_count", "dim_docs", "records", "rejects")}}

    assert app.main(args, spark) == 0
    first = kept()
    assert first["accepted"] == batch.parse_nat_log(spark, SF).count()
    assert first["rejected"] == first["rejects"] == batch.parse_rejects(spark, SF).count() > 0
    assert app.main(args, spark) == 0         # nothing new to read
    assert kept() == first
    (tmp_path / "lines" / "more.txt").write_text("one, malformed line\n")
    assert app.main(args, spark) == 0
    assert kept() == {**first, "rejected": first["rejected"] + 1, "rejects": first["rejects"] + 1}


def test_wordcount_command(spark, tmp_path):
    src = tmp_path / "t.txt"
    src.write_text("x y x\n")
    out = str(tmp_path / "wc")
    assert app.main(["wordcount", "--input", str(src), "--output", out], spark) == 0
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["x,2", "y,1"]
