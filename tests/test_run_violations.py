"""A run's rows are held against the rules without reading the stored ones again."""

import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from hirelens.operators import key_filter
from hirelens.operators.constraints import run_violations
from hirelens.operators.key_filter import KeyFilter
from hirelens.operators.warehouse import load_warehouse
from hirelens.plans import daily_run
from hirelens.sources.bindings import AS_OF, raw_jobs
from hirelens.sources.tables import Tables


def found(new, stored):
    return {r["check_name"]: r["violations"] for r in run_violations(new, stored).collect() if r["violations"]}


def companies(spark, rows):
    return spark.createDataFrame(rows, "company_id long, company_name string, industry string")


def test_taken_doubled_null_and_orphaned_keys(spark):
    old = {"dim_companies": companies(spark, [(1, "a", None), (2, "b", None), (2, "b", None)]),
           "fact_jobs": spark.createDataFrame([(1, 1, "x")], "job_id long, company_id long, job_title string")}
    none = {"dim_companies": old["dim_companies"].where("false"), "fact_jobs": old["fact_jobs"].where("false")}
    assert found(none, old) == {} and found(none, {}) == {}
    new = {"dim_companies": companies(spark, [(2, "c", None), (3, "c", None), (3, None, None), (None, "a", None)]),
           "fact_jobs": spark.createDataFrame([(1, 1, "x"), (1, 3, "x"), (2, 9, None), (None, None, "x"), (4, 2, "y")],
                                              old["fact_jobs"].schema)}
    assert found(new, old) == {
        "dim_companies.company_id not null": 1, "dim_companies.company_name not null": 1,
        "dim_companies(company_id) unique": 2, "dim_companies(company_name) unique": 2,
        "fact_jobs.job_id not null": 1, "fact_jobs.company_id not null": 1, "fact_jobs.job_title not null": 1,
        "fact_jobs(job_id) unique": 2, "fact_jobs.company_id -> dim_companies.company_id": 1}
    # Without stored or new parents there is nothing to look in; with either there is.
    assert found({"fact_jobs": new["fact_jobs"].where("job_id = 4")}, {}) == {}
    assert found({"fact_jobs": new["fact_jobs"].where("job_id = 2")}, old) == {
        "fact_jobs.job_title not null": 1, "fact_jobs.company_id -> dim_companies.company_id": 1}


def test_the_filter_keeps_all_new_keys_and_few_others(spark):
    new = spark.range(0, 200_000, 100).select("id", F.concat(F.lit("n"), "id").alias("name"))
    stored = spark.range(200_000).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("n"), "id").alias("name"))
    keys = KeyFilter.of(new, ["id", "name"])
    for key in (["id"], ["name"], ["id", "name"]):
        kept = keys.candidates(stored, key)
        assert kept.join(new, key, "left_semi").count() == 2_000
        assert kept.count() < 2_000 + 198_000 // 100
    plan = keys.candidates(stored, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_stored_runs_are_not_read_for_surrogate_keys(spark):
    base = tempfile.mkdtemp() + "/t"
    spark.range(0, 50_000).selectExpr("id as job_id").repartitionByRange(5, "job_id").write.parquet(base)
    stored = spark.read.parquet(base)
    later = spark.range(50_000, 50_100).selectExpr("id as job_id")
    read = KeyFilter.of(later, ["job_id"]).candidates(stored, ["job_id"])
    scans = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(job_id,50000)" in scans and "LessThanOrEqual(job_id,50099)" in scans
    assert read.count() == 0


def test_a_run_that_breaks_a_key_is_not_published(spark):
    base, raw = tempfile.mkdtemp(), raw_jobs(Tables(spark, SF_SMALL))
    daily_run.write_warehouse(load_warehouse(raw.where("job_id % 2 = 0"), AS_OF, tiebreak="job_id"), base, "first")
    before = daily_run.read_warehouse(spark, base).fact_jobs.count()
    # Loaded as if nothing were stored: its keys begin at 1 again.
    apart = load_warehouse(raw.where("job_id % 2 = 1"), AS_OF, tiebreak="job_id")
    with pytest.raises(ValueError, match=r"fact_jobs\(job_id\) unique"):
        daily_run.write_warehouse(apart, base, "second")
    assert daily_run.read_warehouse(spark, base).fact_jobs.count() == before
    after = load_warehouse(raw.where("job_id % 2 = 1"), AS_OF, daily_run.read_warehouse(spark, base), tiebreak="job_id")
    daily_run.write_warehouse(after, base, "second")
    assert daily_run.read_warehouse(spark, base).fact_jobs.count() > before


@pytest.mark.parametrize("most", [0, 1 << 30])
def test_many_new_keys_are_looked_up_without_a_filter(spark, monkeypatch, most):
    monkeypatch.setattr(key_filter, "MOST_KEYS", most)
    old = {"dim_companies": companies(spark, [(1, "a", None), (1, "a", None), (2, "b", None), (None, None, None)]),
           "fact_jobs": spark.createDataFrame([(1, 1, "x")], "job_id int, company_id long, job_title string")}
    new = {"dim_companies": companies(spark, [(2, "c", None), (2, "a", None), (3, "z", None), (None, None, None)]),
           "fact_jobs": spark.createDataFrame([(1, 1, "x"), (1, 3, "x"), (2, 9, "x")],
                                              "job_id long, company_id long, job_title string")}
    assert found(new, old) == {
        "dim_companies.company_id not null": 1, "dim_companies.company_name not null": 1,
        "dim_companies(company_id) unique": 2, "dim_companies(company_name) unique": 1,
        "fact_jobs(job_id) unique": 2, "fact_jobs.company_id -> dim_companies.company_id": 1}
    plan = KeyFilter.of(new["fact_jobs"], ["job_id"]).candidates(old["fact_jobs"], ["job_id"])
    assert ("bitmap_construct_agg" in plan._jdf.queryExecution().toString()) == bool(most)
