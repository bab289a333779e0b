"""Sources, sinks and the incremental stream."""

import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hirelens.operators.cleaning import process
from hirelens.operators.constraints import constraint_violations, star_tables
from hirelens.plans import reports
from hirelens.plans.daily_run import read_warehouse, run_daily
from hirelens.schemas import RAW
from hirelens.sources.bindings import AS_OF, html_pages, raw_jobs
from hirelens.sources.html_cards import job_cards
from hirelens.sources.io import append_new, empty_frame, purge, read_raw, sample_rows, write_table
from hirelens.sources.tables import Tables
from hirelens.streaming.incremental import incremental_ingest

from conftest import SF_SMALL


def fresh(name):
    return os.path.join(tempfile.mkdtemp(prefix="hirelens-test-"), name)


def test_read_raw_missing_path(spark):
    missing = fresh("nope")
    with pytest.raises(AnalysisException):
        read_raw(spark, missing)
    empty = read_raw(spark, missing, on_error="empty")
    assert empty.count() == 0 and empty.schema == RAW


def test_empty_input_runs_through_processing(spark):
    out = process(empty_frame(spark), "2001-01-01T00:00:00")
    assert out.count() == 0 and "salary_min" in out.columns


def test_append_new_is_idempotent_and_purge_counts(spark):
    path = fresh("t")
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "url string, v int")
    assert append_new(df, path) == 3          # in-batch duplicates are kept
    assert append_new(df, path) == 0          # re-running adds nothing
    assert purge(spark, {"t": (path, df.schema)}) == {"t": 3}
    assert spark.read.parquet(path).count() == 0


def test_write_table_partitioned_overwrite(spark):
    path = fresh("p")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string")
    assert write_table(df, path, partition_by=["p"]) == 2
    write_table(spark.createDataFrame([(3, "x")], "v int, p string"), path, partition_by=["p"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [2, 3]


def test_sample_rows_is_ordered(spark):
    df = spark.range(100).withColumn("k", -F.col("id"))
    assert [r.k for r in sample_rows(df, 3, ["k"]).collect()] == [-99, -98, -97]


def test_incremental_ingest_rerun_adds_nothing(spark):
    raw = raw_jobs(Tables(spark, SF_SMALL))
    landing, target, ckpt = fresh("landing"), fresh("target"), fresh("ckpt")
    raw.write.parquet(f"{landing}/b0")
    incremental_ingest(spark, f"{landing}/*", raw.schema, target, ckpt)
    first = spark.read.parquet(target).count()
    incremental_ingest(spark, f"{landing}/*", raw.schema, target, ckpt)   # nothing new landed
    assert spark.read.parquet(target).count() == first == raw.count()
    raw.write.parquet(f"{landing}/b1")                                     # same urls again
    incremental_ingest(spark, f"{landing}/*", raw.schema, target, ckpt)
    n_na = raw.where(F.col("url") == "N/A").count()
    assert spark.read.parquet(target).count() == first  # every url was stored by batch 0
    assert n_na > 0


def test_daily_run_end_to_end(spark):
    pages = html_pages(Tables(spark, SF_SMALL)).withColumn("batch_idx", F.col("page_id") % 5)
    out = fresh("run")
    res = run_daily(pages, out, AS_OF)
    assert res.passed and res.raw_rows > 0 and res.processed_rows == res.raw_rows
    fact = spark.read.parquet(f"{out}/warehouse/fact_jobs")
    assert fact.count() == res.raw_rows
    texts = spark.read.option("recursiveFileLookup", "true").option("wholetext", "true") \
        .text(f"{out}/reports").collect()
    assert any("ETL Pipeline Report" in r.value for r in texts)
    # reports over the written (month-partitioned) star equal those over what the run returned
    written = read_warehouse(spark, f"{out}/warehouse").star()
    assert sorted(reports.q01_top_skills(written).collect()) == sorted(reports.q01_top_skills(res.warehouse.star()).collect())
    assert os.listdir(f"{out}/warehouse/fact_jobs/run_id=2001-07-30") == ["posted_month=2001-07"]
    # a date-bounded report prunes month folders of the stored fact
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        reports.q10_recent_jobs(written, as_of=AS_OF).explain("formatted")
    assert "PartitionFilters: [isnotnull(posted_month" in buf.getvalue()
    assert reports.q10_recent_jobs(written, as_of=AS_OF).count() == \
        reports.q10_recent_jobs(res.warehouse.star(), as_of=AS_OF).count()


def test_command_line(spark, tmp_path):
    from hirelens.__main__ import main

    pages = html_pages(Tables(spark, SF_SMALL)).withColumn("batch_idx", F.col("page_id") % 3)
    pages_path, out = str(tmp_path / "pages"), str(tmp_path / "run")
    pages.write.parquet(pages_path)
    assert main(["daily", "--pages", pages_path, "--out", out, "--as-of", AS_OF]) == 0
    assert main(["report", "--warehouse", f"{out}/warehouse", "--query", "q01_top_skills",
                 "--out", str(tmp_path / "q01")]) == 0
    assert spark.read.parquet(str(tmp_path / "q01")).count() > 0
    assert main(["check", "--warehouse", f"{out}/warehouse"]) == 0


def test_postings_without_a_url_are_not_one_posting(spark):
    """Three postings without a url after two others: nothing is lost, and a re-run adds nothing."""
    path, schema = fresh("match") + "/t", "title string, url string, processed_at string"
    old = spark.createDataFrame([("a", "N/A", "1"), ("b", None, "1"), ("c", "/1", "1")], schema)
    new = spark.createDataFrame([("d", "N/A", "2"), ("e", None, "2"), ("f", "", "2"), ("c2", "/1", "2"), ("a", "N/A", "2"),
                                 ("g", "/2", "2")], schema)
    append_new(old, path)
    for _ in range(2):
        append_new(new, path)
    got = sorted(r["title"] for r in spark.read.parquet(path).collect())
    assert got == ["a", "b", "c", "d", "e", "f", "g"]


def test_appended_rows_are_seen_by_a_new_reader(spark):
    base = fresh("tables")
    spark.range(3).write.parquet(f"{base}/orders.parquet")
    assert Tables(spark, base)("orders").count() == 3
    spark.range(3).write.mode("append").parquet(f"{base}/orders.parquet")
    assert Tables(spark, base)("orders").count() == 6


def test_a_run_again_replaces_itself_and_an_empty_one_goes_on(spark):
    pages = html_pages(Tables(spark, SF_SMALL)).withColumn("batch_idx", F.lit(0).cast("long"))
    out = fresh("again")
    first = run_daily(pages.where("page_id % 2 = 0"), out, "2001-01-31 06:00:00")
    run_daily(pages.where("page_id % 2 = 1"), out, "2001-02-01 06:00:00")
    second = run_daily(pages.where("page_id % 2 = 1"), out, "2001-02-01 07:00:00")
    empty = run_daily(pages.where("false"), out, "2001-02-02 06:00:00")
    assert not empty.passed and empty.raw_rows == 0
    fact = empty.warehouse.fact_jobs
    assert fact.count() == first.raw_rows + second.raw_rows == fact.select("job_id").distinct().count()
    assert constraint_violations(star_tables(empty.warehouse)).where("violations > 0").count() == 0
    # the second day, now without a card: its rows go
    gone = run_daily(pages.where("false"), out, "2001-02-01 08:00:00")
    assert gone.warehouse.fact_jobs.count() == first.raw_rows
    assert constraint_violations(star_tables(gone.warehouse)).where("violations > 0").count() == 0


def test_pages_are_parsed_once(spark):
    """What the run lands is one parse; everything behind reads the landed cards."""
    cards = job_cards(html_pages(Tables(spark, SF_SMALL)).withColumn("batch_idx", F.lit(0)), carry=("batch_idx",))
    plan = cards._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1
