"""Properties from the test plan: totals add up, the bridge is unique."""

from pyspark.sql import functions as F

from hirelens.plans import reports
from hirelens.sources.bindings import star
from hirelens.sources.tables import Tables

from conftest import SF_SMALL


def test_bucket_counts_sum_to_fact(spark):
    s = star(Tables(spark, SF_SMALL))
    total = reports.q07_salary_buckets(s).agg(F.sum("job_count")).first()[0]
    assert total == s.fact_jobs.count()


def test_quality_total_is_fact_size(spark):
    s = star(Tables(spark, SF_SMALL))
    got = {r.metric: r.value for r in reports.q08_data_quality(s).collect()}
    assert int(got["Total Jobs"]) == s.fact_jobs.count()
    assert int(got["Unique Skills Mentioned"]) == s.bridge_job_skills.select("skill_id").distinct().count()


def test_bridge_unique_and_job_key_unique(spark):
    s = star(Tables(spark, SF_SMALL))
    b = s.bridge_job_skills
    assert b.count() == b.select("job_id", "skill_id").distinct().count()
    assert s.fact_jobs.count() == s.fact_jobs.select("job_id").distinct().count()


def test_v1_covers_every_skill(spark):
    s = star(Tables(spark, SF_SMALL))
    assert reports.v1_top_skills(s).count() == s.dim_skills.count()
