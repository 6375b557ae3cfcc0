import os

from natspark.plans import batch
from natspark.plans.jobs import run_dimension_job, run_record_job, run_word_count_job
from natspark.sources.fixtures import ip_ranges, online_users, read_table
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_record_job_end_to_end_and_rerun(spark, tmp_path):
    lines = batch.lines(spark, SF)
    users = online_users(read_table(spark, SF, "customer"))
    out = str(tmp_path / "out")
    run_record_job(lines, users, out, batch_id=0, order="seq")
    run_record_job(lines, users, out, batch_id=0, order="seq")    # re-run replaces
    recs = spark.read.parquet(f"{out}/records")
    assert recs.count() == batch.nat_records(spark, SF).count()
    assert rows(spark.read.parquet(f"{out}/log_count").drop("batch_id")) == \
        rows(batch.log_count_5min(spark, SF))
    assert rows(spark.read.parquet(f"{out}/matched_count").drop("batch_id")) == \
        rows(batch.matched_count_5min(spark, SF))
    assert spark.read.parquet(f"{out}/rejects").count() == batch.parse_rejects(spark, SF).count()
    assert spark.read.parquet(f"{out}/index").count() == recs.count()
    assert spark.read.text(f"{out}/username").count() == recs.count()


def test_dimension_job(spark, tmp_path):
    out = str(tmp_path / "out")
    run_dimension_job(batch.lines(spark, SF), ip_ranges(read_table(spark, SF, "nation")), out)
    docs = spark.read.json(f"{out}/dim_docs").select("types", "data", "count", "accesstime")
    assert rows(docs) == rows(batch.dim_count_docs(spark, SF))


def test_word_count_job(spark, tmp_path):
    src = tmp_path / "in.txt"
    src.write_text("a b a\n\nb\n")
    out = str(tmp_path / "wc")
    run_word_count_job(spark, str(src), out, single_file=True)
    assert sorted(r.value for r in spark.read.text(out).collect()) == [",1", "a,2", "b,2"]
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 1
