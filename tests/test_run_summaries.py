"""Reports from summaries equal those over all jobs, after every kind of run."""

import tempfile

from conftest import SF_SMALL

from hirelens.plans import daily_run, reports
from hirelens.plans import run_summaries as S
from hirelens.sources.bindings import html_pages
from hirelens.sources.files import delete
from hirelens.sources.manifest import Manifest
from hirelens.sources.tables import Tables


def both(spark, base):
    wh = daily_run.read_warehouse(spark, base)
    summary = S.stored_summary(spark, base)
    skills = sorted(map(str, S.top_skills(summary, wh.dim_skills, 100).collect()))
    assert skills == sorted(map(str, reports.q01_top_skills(wh.star(), 100).collect()))
    quality = {tuple(r) for r in S.data_quality(summary).collect()}
    assert quality == {tuple(r) for r in reports.q08_data_quality(wh.star()).collect()}
    return summary


def test_summaries_equal_the_full_reports(spark):
    out = tempfile.mkdtemp()
    pages = html_pages(Tables(spark, SF_SMALL))
    batch = pages.selectExpr("*", "0L as batch_idx")
    base = f"{out}/warehouse"
    daily_run.run_daily(batch.where("page_id % 2 = 0"), out, "2001-07-30 06:00:00")
    both(spark, base)
    daily_run.run_daily(batch.where("page_id % 2 = 1"), out, "2001-07-31 23:00:00", run_id="second")
    both(spark, base)
    daily_run.run_daily(batch.where("page_id % 4 = 1"), out, "2001-08-01 01:00:00", run_id="second")  # again, fewer
    daily_run.run_daily(batch.where("false"), out, "2001-08-02 06:00:00")                           # empty
    summary = both(spark, base)
    # A report reads summaries only.
    assert summary.inputFiles() and all("/run_summary/" in f for f in summary.inputFiles())
    # Runs stored without a summary still count.
    manifest = Manifest(spark, base)
    tables = manifest.read()["tables"]
    for run, folders in tables.pop(S.NAME).items():
        for folder in folders:
            delete(spark, f"{base}/{S.NAME}/{folder}")
    manifest.publish({"tables": tables})
    both(spark, base)


def test_an_empty_warehouse_has_an_empty_summary(spark):
    base = tempfile.mkdtemp()
    assert {r["value"] for r in S.data_quality(S.stored_summary(spark, base)).collect()} == {"0"}
