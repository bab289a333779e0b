"""A run's tables become visible together, and a repeated run replaces itself."""

import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from hirelens.operators.constraints import constraint_violations, star_tables
from hirelens.plans import daily_run
from hirelens.schemas import WAREHOUSE
from hirelens.sources.bindings import html_pages
from hirelens.sources.tables import Tables


def pages(spark):
    return html_pages(Tables(spark, SF_SMALL)).withColumn("batch_idx", F.lit(0).cast("long"))


def state(wh):
    return {name: sorted(map(str, getattr(wh, name).collect())) for name in WAREHOUSE}


def test_a_run_repeated_in_another_month_replaces_itself(spark):
    out = tempfile.mkdtemp()
    some = pages(spark).where("page_id % 3 = 0")
    daily_run.run_daily(some, out, "2001-07-31 23:00:00", run_id="night:1")
    second = daily_run.run_daily(some, out, "2001-08-01 01:00:00", run_id="night:1")
    fact = daily_run.read_warehouse(spark, f"{out}/warehouse").fact_jobs
    assert fact.count() == second.raw_rows == fact.select("job_id").distinct().count()
    assert [tuple(r) for r in fact.select("run_id", "posted_month").distinct().collect()] == [("night:1", "2001-08")]
    assert spark.read.parquet(f"{out}/warehouse/fact_jobs").count() == second.raw_rows


@pytest.mark.parametrize("broken", ["dim_companies", "bridge_job_skills", "publish"])
def test_a_broken_run_leaves_readers_on_the_old_state(spark, monkeypatch, broken):
    out = tempfile.mkdtemp()
    daily_run.run_daily(pages(spark).where("page_id % 3 = 0"), out, "2001-07-30 06:00:00")
    before = state(daily_run.read_warehouse(spark, f"{out}/warehouse"))
    write = daily_run.write_table

    def fails(df, path, **options):
        if f"/{broken}/" in path:
            write(df, path, **options)
            raise OSError("lost")
        return write(df, path, **options)

    def unpublished(self, content):
        raise OSError("lost")

    with monkeypatch.context() as m:
        if broken == "publish":
            m.setattr(daily_run.Manifest, "publish", unpublished)
        else:
            m.setattr(daily_run, "write_table", fails)
        for run_id in ("2001-07-30", "2001-07-31"):  # again, and new
            with pytest.raises(OSError):
                daily_run.run_daily(pages(spark).where("page_id % 3 > 0"), out, "2001-07-31 06:00:00", run_id=run_id)
    assert state(daily_run.read_warehouse(spark, f"{out}/warehouse")) == before
    done = daily_run.run_daily(pages(spark).where("page_id % 3 = 1"), out, "2001-07-31 06:00:00")
    after = done.warehouse
    assert constraint_violations(star_tables(after)).where("violations > 0").count() == 0
    assert after.fact_jobs.count() == len(before["fact_jobs"]) + done.raw_rows
    assert spark.read.parquet(f"{out}/warehouse/fact_jobs").count() == after.fact_jobs.count()
