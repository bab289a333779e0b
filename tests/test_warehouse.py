"""Warehouse load properties: idempotent upsert, dense keys, constraints."""

from pyspark.sql import functions as F

from hirelens.operators.constraints import cascade_delete, constraint_violations, star_tables
from hirelens.operators.warehouse import load_warehouse, prepare_jobs, stage_jobs, upsert_companies
from hirelens.sources.bindings import AS_OF, raw_jobs, star
from hirelens.sources.tables import Tables

from conftest import SF_SMALL


def test_upsert_twice_adds_nothing(spark):
    jobs = prepare_jobs(stage_jobs(raw_jobs(Tables(spark, SF_SMALL)), AS_OF))
    once = upsert_companies(None, jobs, AS_OF).checkpoint()
    twice = upsert_companies(once, jobs, AS_OF)
    assert twice.count() == once.count()
    ids = sorted(r.company_id for r in once.collect())
    assert ids == list(range(1, len(ids) + 1))


def test_loaded_warehouse_has_no_violations(spark):
    wh = load_warehouse(raw_jobs(Tables(spark, SF_SMALL)), AS_OF)
    bad = [r for r in constraint_violations(star_tables(wh.star())).collect() if r.violations]
    assert bad == []
    n = wh.fact_jobs.count()
    assert sorted(r.job_id for r in wh.fact_jobs.select("job_id").collect()) == list(range(1, n + 1))


def test_second_load_appends_after_max(spark):
    raw = raw_jobs(Tables(spark, SF_SMALL))
    first = load_warehouse(raw, AS_OF)
    second = load_warehouse(raw, AS_OF, previous=first)
    assert second.fact_jobs.count() == 2 * first.fact_jobs.count()
    assert second.dim_companies.count() == first.dim_companies.count()
    assert second.fact_jobs.agg(F.count_distinct("job_id")).first()[0] == second.fact_jobs.count()


def test_constraint_checks_detect_violations(spark):
    s = star(Tables(spark, SF_SMALL))
    dup = s.fact_jobs.unionByName(s.fact_jobs.limit(3))
    bad_bridge = s.bridge_job_skills.unionByName(spark.createDataFrame([(10**9, 1)], "job_id long, skill_id long"))
    tables = {**star_tables(s), "fact_jobs": dup, "bridge_job_skills": bad_bridge}
    got = {r.check_name: r.violations for r in constraint_violations(tables).collect()}
    assert got["fact_jobs(job_id) unique"] == 3
    assert got["bridge_job_skills.job_id -> fact_jobs.job_id"] == 1


def test_cascade_delete(spark):
    s = star(Tables(spark, SF_SMALL))
    doomed = F.col("posted_date") < F.lit("1996-01-01").cast("timestamp_ntz")
    rest = cascade_delete(s, doomed)
    gone = s.fact_jobs.where(doomed).select("job_id")
    assert rest.bridge_job_skills.join(gone, "job_id").count() == 0
    assert rest.fact_jobs.count() + gone.count() == s.fact_jobs.count()
