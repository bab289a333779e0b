"""Checked queries for the warehouse load and its constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens.operators.constraints import cascade_delete, constraint_violations, run_violations, star_tables
from hirelens.operators.catalog import ensure_tables, register_views
from hirelens.operators.warehouse import conform, load_warehouse, prepare_jobs, stage_jobs, upsert_companies
from hirelens.plans import reports
from hirelens.plans import run_summaries
from hirelens.plans.daily_run import read_warehouse, run_daily, write_warehouse
from hirelens.schemas import WAREHOUSE
from hirelens.session import scratch_path
from hirelens.sources.bindings import AS_OF, html_pages, raw_jobs, star
from hirelens.sources.io import spooled
from hirelens.sources.tables import Tables

# Jobs posted before this date are deleted by the cascade example.
CASCADE_BEFORE = "1995-07-01 00:00:00"


# The raw binding keeps its source key (the order key): it identifies each
# raw row, so exact copies are ordered by it and spread by the range split.
SOURCE_KEY = "job_id"


def _loaded(spark, sf_dir):
    return load_warehouse(raw_jobs(Tables(spark, sf_dir)), AS_OF, tiebreak=SOURCE_KEY)


def stage_jobs_q(spark, sf_dir):
    return stage_jobs(raw_jobs(Tables(spark, sf_dir)), AS_OF, tiebreak=SOURCE_KEY)


def stage_jobs_copies_q(spark, sf_dir):
    """Staging without a source key: exact copies are numbered first."""
    return stage_jobs(raw_jobs(Tables(spark, sf_dir)).drop("job_id"), AS_OF)


def upsert_companies_q(spark, sf_dir):
    t = Tables(spark, sf_dir)
    jobs = prepare_jobs(stage_jobs(raw_jobs(t), AS_OF, tiebreak=SOURCE_KEY))
    # Every other stored name is spelled as the batch spells it, and so is found.
    known = star(t).dim_companies.withColumn("company_name", F.when(
        F.col("company_id") % 2 == 0, F.lower("company_name")).otherwise(F.col("company_name")))
    return upsert_companies(known, jobs, AS_OF)


def load_fact_q(spark, sf_dir):
    return _loaded(spark, sf_dir).fact_jobs


def load_bridge_q(spark, sf_dir):
    return _loaded(spark, sf_dir).bridge_job_skills


def load_locations_q(spark, sf_dir):
    return _loaded(spark, sf_dir).dim_locations


def loaded_top_skills_q(spark, sf_dir):
    return reports.q01_top_skills(_loaded(spark, sf_dir).star())


def loaded_salary_buckets_q(spark, sf_dir):
    return reports.q07_salary_buckets(_loaded(spark, sf_dir).star())


def loaded_constraint_violations_q(spark, sf_dir):
    return constraint_violations(star_tables(_loaded(spark, sf_dir)))


def planted_violations_q(spark, sf_dir):
    """The rules over tables with nulls, doubles, orphans and overlong texts."""
    s = star(Tables(spark, sf_dir))
    cid, jid = F.col("company_id"), F.col("job_id")
    none = F.lit(None)
    firms = s.dim_companies.select(
        "company_id", F.when(cid % 7 != 0, F.col("company_name")).alias("company_name"),
        F.repeat("industry", F.when(cid % 11 == 0, 20).otherwise(1)).alias("industry")).unionByName(
        s.dim_companies.where(cid % 13 == 0))
    f = s.fact_jobs.select("job_id", "company_id", "job_title", "job_url", "location")
    jobs = (f.withColumns({"job_url": F.repeat("job_url", F.when(jid % 9 == 0, 40).otherwise(1)),
                           "location": F.repeat("location", F.when(jid % 10 == 0, 40).otherwise(1))})
            .unionByName(f.where(jid % 5 == 0).withColumns({"company_id": none.cast("long"),
                                                            "job_title": none.cast("string")}))
            .unionByName(f.where(jid % 6 == 0).withColumns({"job_id": -jid, "company_id": -cid})))
    b = s.bridge_job_skills
    bridge = (b.select((jid * 1000000 + F.col("skill_id")).alias("job_skill_id"), "job_id", "skill_id")
              .unionByName(b.where(jid % 8 == 0).select(jid.alias("job_skill_id"), "job_id",
                                                        (-F.col("skill_id")).alias("skill_id")))
              .unionByName(b.where(jid % 12 == 0).select(none.cast("long").alias("job_skill_id"),
                                                         none.cast("long").alias("job_id"), "skill_id")))
    places = s.fact_jobs.select(cid.alias("location_id"), F.col("location").alias("location_name"),
                                F.lit("c" * 51).alias("city"), F.lit("x").alias("country"))
    return constraint_violations({"fact_jobs": jobs, "dim_companies": firms, "bridge_job_skills": bridge,
                                  "dim_locations": places})


def planted_run_violations_q(spark, sf_dir):
    """The rules for what a run adds to stored tables: keys that are stored
    already, doubled, null or without a parent, beside right ones."""
    s = star(Tables(spark, sf_dir))
    cid, jid, sid = F.col("company_id"), F.col("job_id"), F.col("skill_id")
    # The rules read their tables many times, as written ones: the two that a join and a distinct make are written first.
    f = spooled(s.fact_jobs.select("job_id", "company_id", "job_title", "job_url", "location"), "jobs")
    firms = s.dim_companies.select("company_id", "company_name", "industry")
    b = spooled(s.bridge_job_skills.select((jid * 1000 + sid).alias("job_skill_id"), "job_id", "skill_id"), "bridge")
    skills = s.dim_skills.select("skill_id", "skill_name")
    stored = {"fact_jobs": f.where(jid % 3 > 0), "dim_companies": firms.where(cid % 4 > 0),
              "dim_skills": skills.where(sid % 9 > 0), "bridge_job_skills": b.where(jid % 3 > 0)}
    new = {
        "fact_jobs": f.where(jid % 3 == 0).unionByName(f.where(jid % 5 == 0))
        .unionByName(f.where(jid % 6 == 0).withColumns({"job_id": -jid, "company_id": -cid})),
        "dim_companies": firms.where((cid % 4 == 0) & (cid % 8 > 0)).unionByName(firms.where(cid % 13 == 0))
        .unionByName(firms.where(cid % 17 == 0).withColumn("company_id", -cid)),
        "bridge_job_skills": b.where(jid % 3 == 0).unionByName(b.where(jid % 8 == 0))
        .unionByName(b.where(jid % 7 == 0).withColumn("job_id", F.when(jid % 2 == 0, jid + 1_000_000_000)))}
    return run_violations(new, stored)


def loaded_and_rejected_q(spark, sf_dir):
    """No posting gets lost: staged = loaded + rejected."""
    w = _loaded(spark, sf_dir)
    unknown = (w.new_fact_jobs.join(w.new_companies.where("company_name = 'N/A'"), "company_id")
               .agg(F.count("*").alias("without_company")))
    return (w.new_staging.agg(F.count("*").alias("staged"))
            .select("staged", F.lit(w.new_fact_jobs.count()).cast("long").alias("loaded"),
                    F.lit(w.rejected_jobs.count()).cast("long").alias("rejected"),
                    F.lit(unknown.first()[0]).cast("long").alias("without_company")))


def daily_runs_q(spark, sf_dir):
    """Three days across a month's end into one stored warehouse: the second
    run twice, on either side of the month's end, the third over pages without a
    card.  The rows of the fact, and the violations of all rules (none)."""
    t, out = Tables(spark, sf_dir), scratch_path(spark, "daily")
    pages = html_pages(t).withColumn("batch_idx", F.col("page_id") % 3)
    run_daily(pages.where("page_id % 2 = 0"), out, "2001-07-30 06:00:00")
    for as_of in ("2001-07-31 23:00:00", "2001-08-01 01:00:00"):
        run_daily(pages.where("page_id % 2 = 1"), out, as_of, run_id="2001-07-31")
    run_daily(t("pages").select("page_id", "html", F.lit(0).cast("long").alias("batch_idx")), out, "2001-08-01 06:00:00")
    stored = read_warehouse(spark, f"{out}/warehouse")
    bad = constraint_violations(star_tables(stored)).agg(F.sum("violations")).first()[0]
    return stored.fact_jobs.join(stored.dim_companies, "company_id").select(
        "run_id", "job_id", "job_title", "company_name", "location", "salary_min", "salary_max",
        F.lit(bad).cast("long").alias("violations"))


def _two_runs(spark, sf_dir):
    """Half of the postings loaded in one run, the other half in a second one."""
    base, raw = scratch_path(spark, "two-runs"), raw_jobs(Tables(spark, sf_dir))
    for i in (0, 1):
        previous = read_warehouse(spark, base) if i else None
        part = raw.where(F.pmod("job_id", F.lit(2)) == i)
        write_warehouse(load_warehouse(part, AS_OF, previous, tiebreak=SOURCE_KEY), base, f"run {i}")
    return base


def summarised_top_skills_q(spark, sf_dir):
    """Skill demand over two runs, from their summaries alone."""
    base = _two_runs(spark, sf_dir)
    return run_summaries.top_skills(run_summaries.stored_summary(spark, base), read_warehouse(spark, base).dim_skills)


def summarised_data_quality_q(spark, sf_dir):
    """The quality metrics over two runs, from their summaries alone."""
    return run_summaries.data_quality(run_summaries.stored_summary(spark, _two_runs(spark, sf_dir)))


def created_tables_q(spark, sf_dir):
    """CREATE TABLE IF NOT EXISTS twice, with the bound fact written in
    between: which were new, and what each holds."""
    base = scratch_path(spark, "tables")
    first = ensure_tables(spark, base)
    conform(star(Tables(spark, sf_dir)).fact_jobs, spark.createDataFrame([], WAREHOUSE["fact_jobs"])).write.mode(
        "append").parquet(f"{base}/fact_jobs")
    second = ensure_tables(spark, base)
    rows = [(n, first[n], second[n], spark.read.parquet(f"{base}/{n}").count()) for n in WAREHOUSE]
    return spark.createDataFrame(rows, "table_name string, created boolean, created_again boolean, n_rows long")


def view_top_skills_q(spark, sf_dir):
    """A reporting view read by SQL."""
    register_views(star(Tables(spark, sf_dir)))
    return spark.sql("SELECT skill_name, skill_count FROM v_top_skills WHERE skill_count > 0")


def cascade_delete_jobs_q(spark, sf_dir):
    s = star(Tables(spark, sf_dir))
    doomed = F.col("posted_date") < F.lit(CASCADE_BEFORE).cast("timestamp_ntz")
    return cascade_delete(s, doomed).fact_jobs.select("job_id", "company_id")


def constraint_violations_q(spark, sf_dir):
    return constraint_violations(star_tables(star(Tables(spark, sf_dir))))


def cascade_delete_q(spark, sf_dir):
    s = star(Tables(spark, sf_dir))
    doomed = F.col("posted_date") < F.lit(CASCADE_BEFORE).cast("timestamp_ntz")
    return cascade_delete(s, doomed).bridge_job_skills.select("job_id", "skill_id")


def skill_category_demand_q(spark, sf_dir):
    """Jobs per skill category (a job counts once per category)."""
    w = _loaded(spark, sf_dir)
    per = w.bridge_job_skills.join(F.broadcast(w.dim_skills.select("skill_id", "skill_category")), "skill_id")
    return per.groupBy("skill_category").agg(F.count_distinct("job_id").alias("job_count"))


WAREHOUSE_QUERIES = {
    "stage_jobs": stage_jobs_q,
    "stage_jobs_copies": stage_jobs_copies_q,
    "upsert_companies": upsert_companies_q,
    "load_fact": load_fact_q,
    "load_bridge": load_bridge_q,
    "load_locations": load_locations_q,
    "loaded_top_skills": loaded_top_skills_q,
    "loaded_salary_buckets": loaded_salary_buckets_q,
    "loaded_constraint_violations": loaded_constraint_violations_q,
    "constraint_violations": constraint_violations_q,
    "planted_violations": planted_violations_q,
    "planted_run_violations": planted_run_violations_q,
    "loaded_and_rejected": loaded_and_rejected_q,
    "daily_runs": daily_runs_q,
    "summarised_top_skills": summarised_top_skills_q,
    "summarised_data_quality": summarised_data_quality_q,
    "created_tables": created_tables_q,
    "view_top_skills": view_top_skills_q,
    "cascade_delete": cascade_delete_q,
    "cascade_delete_jobs": cascade_delete_jobs_q,
    "skill_category_demand": skill_category_demand_q,
}
