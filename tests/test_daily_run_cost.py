"""What a daily run may not do twice, or in one task, however large its day is."""

import glob
import tempfile

from conftest import SF_SMALL

from hirelens.operators.constraints import run_violations
from hirelens.operators.warehouse import load_warehouse
from hirelens.plans.daily_run import write_run
from hirelens.sources.bindings import AS_OF, html_pages, raw_jobs
from hirelens.sources.html_cards import job_cards
from hirelens.sources.tables import Tables


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_without_a_card_make_no_rows(spark):
    pages = spark.createDataFrame([(1, "<p>a job & no card</p>", 0)], "page_id long, html string, batch_idx long")
    assert job_cards(pages, scraped_at="2001-07-30T06:00:00", carry=("batch_idx",)).count() == 0


def test_a_run_is_written_where_its_rows_are(spark):
    path = tempfile.mkdtemp()
    assert write_run(spark.range(400).repartition(4), path, "2001-07-30") == 400
    assert len(glob.glob(f"{path}/run_id=2001-07-30/*.parquet")) == 4
    assert write_run(spark.range(3).coalesce(1), path, "2001-07-30") == 3  # in place of the earlier rows
    assert spark.read.parquet(path).count() == 3


def test_pages_are_shuffled_before_their_markup_is_written(spark):
    plan = html_pages(Tables(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert "job-card" in plan and "job-card" not in plan[plan.index("RepartitionByExpression"):]


def test_postings_are_cleaned_once(spark):
    wh = load_warehouse(raw_jobs(Tables(spark, SF_SMALL)), AS_OF, tiebreak="job_id")
    for df in (wh.new_companies, wh.new_fact_jobs, wh.new_bridge, wh.new_locations, wh.rejected_jobs):
        assert "regexp_replace" not in executed(df)


def test_keys_after_the_stored_ones_need_no_filter(spark):
    def jobs(keys):
        return {"fact_jobs": spark.createDataFrame([(k, 1, "x") for k in keys],
                                                   "job_id long, company_id long, job_title string")}

    def violations(new, old):
        found = run_violations(jobs(new), jobs(old))
        return executed(found), {r["check_name"]: r["violations"] for r in found.collect()}["fact_jobs(job_id) unique"]

    plan, n = violations([4, 5, 5], [1, 2, 3])
    assert n == 1 and "bitmap_construct_agg" not in plan
    plan, n = violations([3, 5, 5], [1, 2, 3, 4])
    assert n == 2 and "bitmap_construct_agg" in plan


def test_parents_are_looked_up_by_distinct_keys(spark):
    def firms(keys):
        return spark.createDataFrame([(k, f"c{k}") for k in keys], "company_id long, company_name string")

    jobs = spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (3, 7, "x"), (4, 7, "x"), (5, 9, "x"), (6, None, "x")],
                                 "job_id long, company_id long, job_title string")
    found = {r["check_name"]: r["violations"] for r in run_violations(
        {"fact_jobs": jobs, "dim_companies": firms([9])}, {"dim_companies": firms([1, 2, 8])}).collect()}
    assert found["fact_jobs.company_id -> dim_companies.company_id"] == 2
    assert found["fact_jobs.company_id not null"] == 1
