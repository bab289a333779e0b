"""Reports over all runs that read a small summary of each.

With each run the warehouse writes, from that run's rows alone, what the
demand and quality reports need, in a form that merges:

* jobs per skill, jobs in all, with a salary, with a location: sums;
* companies and locations: bitmaps over their dense ids, as one company may
  have jobs in many runs.  Merged by OR, their bits count distinct values
  exactly.

A report adds the summaries up.  Its cost grows with runs, skills and bits, not
with jobs: a company takes one bit a run, at most.  Runs stored without a
summary (by an earlier version) are summarised when a report is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from hirelens.functions.numeric import percent
from hirelens.plans.reports import QUALITY_METRICS

#: One row per skill (id, n), total (n) and bitmap page (id, bits) of a run.
RUN_SUMMARY = StructType([
    StructField("kind", StringType()), StructField("id", LongType()), StructField("n", LongType()),
    StructField("bits", BinaryType())])
NAME = "run_summary"


def _pages(kind: str, ids: DataFrame, col: str) -> DataFrame:
    return (ids.groupBy(F.bitmap_bucket_number(col).alias("id"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(col)).alias("bits"))
            .select(F.lit(kind).alias("kind"), "id", F.lit(None).cast("long").alias("n"), "bits"))


def summarise(fact: DataFrame, bridge: DataFrame, locations: DataFrame) -> DataFrame:
    """The summary of some runs' jobs and skills; ``locations`` is the dimension."""
    skills = bridge.groupBy(F.col("skill_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    totals = {"jobs": F.count(F.lit(1)), "located": F.count("location"),
              "paid": F.count_if(F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull())}
    counted = fact.agg(*[v.alias(k) for k, v in totals.items()]).unpivot([], list(totals), "kind", "n")
    places = fact.select(F.col("location").alias("location_name")).distinct().join(
        locations.select("location_name", "location_id"), "location_name")
    none = F.lit(None)
    return (skills.select(F.lit("skill").alias("kind"), "id", "n", none.cast("binary").alias("bits"))
            .unionByName(counted.select("kind", none.cast("long").alias("id"), "n", none.cast("binary").alias("bits")))
            .unionByName(_pages("company", fact.select("company_id"), "company_id"))
            .unionByName(_pages("place", places, "location_id")))


def merged(summaries: DataFrame) -> DataFrame:
    """One summary of several: sums, and bitmaps by OR."""
    return summaries.groupBy("kind", "id").agg(F.sum("n").alias("n"), F.bitmap_or_agg("bits").alias("bits"))


def _total(summary: DataFrame, kind: str):
    return summary.where(F.col("kind") == kind).select(F.coalesce(F.sum("n"), F.lit(0)).cast("long")).scalar()


def _distinct(summary: DataFrame, kind: str):
    return summary.where(F.col("kind") == kind).select(
        F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long")).scalar()


def top_skills(summary: DataFrame, skills: DataFrame, k: int = 20) -> DataFrame:
    """The most demanded skills (q01); those without a job have 0."""
    counts = merged(summary).where("kind = 'skill'").select(F.col("id").alias("skill_id"), "n")
    return (skills.select("skill_id", "skill_name").join(counts, "skill_id", "left")
            .select("skill_id", "skill_name", F.coalesce("n", F.lit(0)).cast("long").alias("job_count"))
            .withColumn("percentage", percent(F.col("job_count"), _total(summary, "jobs")))
            .orderBy(F.desc("job_count"), "skill_id").limit(k).select("skill_name", "job_count", "percentage"))


def data_quality(summary: DataFrame) -> DataFrame:
    """The six quality metrics (q08)."""
    one = merged(summary)
    n_skills = one.where("kind = 'skill'").select(F.count(F.lit(1))).scalar()
    values = [_total(summary, "jobs"), _total(summary, "paid"), _total(summary, "located"),
              _distinct(one, "company"), _distinct(one, "place"), n_skills]
    row = summary.sparkSession.range(1).select(*[v.cast("string").alias(m) for v, m in zip(values, QUALITY_METRICS)])
    return row.unpivot([], QUALITY_METRICS, "metric", "value")


def stored_summary(spark: SparkSession, base: str) -> DataFrame:
    """The summaries of all published runs."""
    from hirelens.plans.daily_run import published, stored

    tables = published(spark, base)
    found = stored(spark, base, tables, NAME, RUN_SUMMARY).drop("run_id")
    lacking = [run for run in tables.get("fact_jobs", {}) if run not in tables.get(NAME, {})]
    if not lacking:
        return found
    rows = {name: {run: tables.get(name, {}).get(run, []) for run in lacking} for name in ("fact_jobs", "bridge_job_skills")}
    more = summarise(stored(spark, base, rows, "fact_jobs"), stored(spark, base, rows, "bridge_job_skills"),
                     stored(spark, base, tables, "dim_locations"))
    return found.unionByName(more)
