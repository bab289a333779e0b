"""The reporting questions (q01-q14) and reporting views (v1-v4).

Each function takes the warehouse tables and returns a lazy DataFrame (q12
first picks its jobs, which runs a job).
Plan choices that matter at scale:

* Aggregate on ids first and join names afterwards: the join then sees one
  row per group instead of one per fact row, and the aggregate's output is
  already hash-partitioned on the join key.
* No dimension is broadcast by hint unless its size is fixed; AQE measures
  shuffle outputs at runtime and broadcasts a side only under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``, keeping a sort-merge
  join otherwise.  The only hinted broadcasts carry at most ``k`` rows.
* ``job_id`` is the fact's primary key (the warehouse load assigns it and
  ``constraint_violations`` checks it), so COUNT(DISTINCT job_id) over the
  fact is COUNT(*) and needs no shuffle of job ids.
* Top-k results and the ordered full reports get a unique tie-break, so
  they are deterministic.
* Scalar subqueries (``DataFrame.scalar``) run once as separate jobs.
* Hot keys: partial aggregation combines map-side before every shuffle, the
  distinct aggregates are expanded on (key, value) so a hot key is spread
  out, AQE's skew-join splits oversized join partitions (q09, q12, v4),
  and q04 cuts a job with very many skills into skill blocks.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.numeric import int_midpoint, percent, round0
from hirelens.session import small_shuffle_tasks
from hirelens.sources.bindings import Star

DATA_ENGINEER = "%data engineer%"


def _n_jobs(fact: DataFrame) -> Column:
    return fact.select(F.count(F.lit(1))).scalar()


def _desc(c: str) -> Column:
    # PostgreSQL puts NULLs first on DESC; keep that explicitly.
    return F.desc_nulls_first(c)


# --------------------------------------------------------------------- skills

def _skill_counts(star: Star, count_col: str, pct_col: str) -> DataFrame:
    per_skill = star.bridge_job_skills.groupBy("skill_id").agg(F.count("skill_id").alias("_n"))
    return (
        star.dim_skills.select("skill_id", "skill_name")
        .join(per_skill, "skill_id", "left")
        .select("skill_id", "skill_name", F.coalesce("_n", F.lit(0)).alias(count_col))
        .withColumn(pct_col, percent(F.col(count_col), _n_jobs(star.fact_jobs)))
    )


def q01_top_skills(star: Star, k: int = 20) -> DataFrame:
    """Most demanded skills; skills with no job are kept with count 0."""
    return (_skill_counts(star, "job_count", "percentage")
            .orderBy(_desc("job_count"), "skill_id").limit(k)
            .select("skill_name", "job_count", "percentage"))


def v1_top_skills(star: Star) -> DataFrame:
    return (_skill_counts(star, "skill_count", "skill_percentage")
            .orderBy(_desc("skill_count"), "skill_id")
            .select("skill_name", "skill_count", "skill_percentage"))


# Skills per job above which a job's pairs are split over several tasks.
HOT_JOB_SKILLS = 1024


def _job_skill_pairs(bridge: DataFrame, block: int = HOT_JOB_SKILLS) -> DataFrame:
    """(job_id, skill_id_1 < skill_id_2) for every unordered skill pair of a job.

    A job with m > ``block`` skills is cut into g = ceil(m / block) blocks by
    skill hash; every block pair (i <= j) is its own join key, so its pairs
    are spread over g(g+1)/2 tasks of at most block x block pairs each, and
    every unordered pair is produced exactly once (i < j: all cross pairs;
    i = j: a < b).  Ordinary jobs have g = 1, which is the plain self-join.
    The per-job skill counts are combined map-side; only jobs above the
    threshold are joined back (a small table that AQE broadcasts when its
    measured size allows).
    """
    per_job = bridge.groupBy("job_id").agg(F.count(F.lit(1)).alias("_m"))
    hot = per_job.where(F.col("_m") > block).select(
        "job_id", F.ceil(F.col("_m") / F.lit(block)).cast("int").alias("_g"))
    b = (bridge.join(hot, "job_id", "left")
         .withColumn("_g", F.coalesce("_g", F.lit(1)))
         .withColumn("_blk", F.pmod(F.xxhash64("skill_id"), F.col("_g")).cast("int")))
    left = b.select("job_id", F.col("skill_id").alias("_x"), F.col("_blk").alias("_i"),
                    F.explode(F.sequence(F.col("_blk"), F.col("_g") - 1)).alias("_j"))
    right = b.select("job_id", F.col("skill_id").alias("_y"), F.col("_blk").alias("_j"),
                     F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_i"))
    pairs = left.join(right, ["job_id", "_i", "_j"]).where(
        ((F.col("_i") < F.col("_j")) & (F.col("_x") != F.col("_y"))) | (F.col("_x") < F.col("_y")))
    return pairs.select("job_id", F.least("_x", "_y").alias("skill_id_1"),
                        F.greatest("_x", "_y").alias("skill_id_2"))


def q04_skill_pairs(star: Star, k: int = 20, hot_job_skills: int = HOT_JOB_SKILLS) -> DataFrame:
    """Skills required together: unordered pairs (a < b) and their job count.

    The bridge is unique on (job_id, skill_id), so the number of distinct
    jobs of a pair is its row count.  Pairs are counted on ids and combined
    map-side; only the k winners are joined to names.  Hot jobs are split
    into skill blocks (see ``_job_skill_pairs``).
    """
    small_shuffle_tasks(star.bridge_job_skills.sparkSession)
    b = star.bridge_job_skills.join(star.dim_skills.select("skill_id"), "skill_id", "left_semi")
    top = (_job_skill_pairs(b, hot_job_skills).groupBy("skill_id_1", "skill_id_2")
           .agg(F.count(F.lit(1)).alias("co_occurrence_count"))
           .orderBy(_desc("co_occurrence_count"), "skill_id_1", "skill_id_2").limit(k))
    names = star.dim_skills.select("skill_id", "skill_name")
    n1 = names.select(F.col("skill_id").alias("skill_id_1"), F.col("skill_name").alias("skill_1"))
    n2 = names.select(F.col("skill_id").alias("skill_id_2"), F.col("skill_name").alias("skill_2"))
    return (top.join(n1, "skill_id_1").join(n2, "skill_id_2")
            .orderBy(_desc("co_occurrence_count"), "skill_id_1", "skill_id_2")
            .select("skill_1", "skill_2", "co_occurrence_count"))


def q09_skills_for_title(star: Star, pattern: str = DATA_ENGINEER) -> DataFrame:
    """Skills of jobs whose title matches ``pattern`` (ILIKE); the share is
    over all matching jobs, including those with no skill."""
    jobs = star.fact_jobs.where(F.col("job_title").ilike(pattern)).select("job_id")
    # job_id is unique in the fact, so the inner join is a semi join; written
    # as one, Catalyst can push it below an aggregate that builds the bridge.
    per_skill = (star.bridge_job_skills.join(jobs, "job_id", "left_semi")
                 .groupBy("skill_id").agg(F.count("skill_id").alias("required_count")))
    return (per_skill.join(star.dim_skills.select("skill_id", "skill_name"), "skill_id")
            .orderBy(_desc("required_count"), "skill_id")
            .select("skill_name", "required_count",
                    percent(F.col("required_count"), _n_jobs(jobs)).alias("percentage_required")))


def v4_skills_by_location(star: Star) -> DataFrame:
    jobs = star.fact_jobs.where(F.col("location").isNotNull()).select("job_id", "location")
    per = (jobs.join(star.bridge_job_skills, "job_id")
           .groupBy("location", "skill_id").agg(F.count("skill_id").alias("skill_count")))
    return (per.join(star.dim_skills.select("skill_id", "skill_name"), "skill_id")
            .orderBy("location", _desc("skill_count"), "skill_id")
            .select("location", "skill_name", "skill_count"))


# -------------------------------------------------------------------- salaries

def _with_both_salaries(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull())


def _midpoint_of_averages() -> Column:
    # (AVG(min) + AVG(max)) / 2 over rows where both are set equals
    # (SUM(min) + SUM(max)) / (2 COUNT): one exact division, then half-up.
    return round0((F.sum("salary_min") + F.sum("salary_max")) / (F.count(F.lit(1)) * 2))


def q02_salary_by_location(star: Star) -> DataFrame:
    f = _with_both_salaries(star.fact_jobs).where(F.col("location").isNotNull())
    return f.groupBy("location").agg(
        F.count(F.lit(1)).alias("total_jobs"),
        round0(F.avg("salary_min")).alias("avg_min_salary"),
        round0(F.avg("salary_max")).alias("avg_max_salary"),
        _midpoint_of_averages().alias("avg_midpoint"),
    ).orderBy(_desc("avg_midpoint"), "location")


def v2_salary_by_company(star: Star) -> DataFrame:
    per = _with_both_salaries(star.fact_jobs).groupBy("company_id").agg(
        F.count("job_id").alias("job_count"),
        round0(F.avg("salary_min")).alias("avg_salary_min"),
        round0(F.avg("salary_max")).alias("avg_salary_max"),
        _midpoint_of_averages().alias("avg_salary_midpoint"),
    )
    return (per.join(star.dim_companies.select("company_id", "company_name"), "company_id")
            .orderBy(_desc("avg_salary_midpoint"), "company_id")
            .select("company_name", "job_count", "avg_salary_min", "avg_salary_max",
                    "avg_salary_midpoint"))


def q11_company_salary(star: Star, k: int = 20) -> DataFrame:
    per = _with_both_salaries(star.fact_jobs).groupBy("company_id").agg(
        F.count("job_id").alias("job_count"),
        F.max("salary_max").alias("max_salary"),
        round0(F.avg(int_midpoint("salary_min", "salary_max"))).alias("avg_salary"),
        F.min("salary_min").alias("min_salary"),
    )
    return (per.join(star.dim_companies.select("company_id", "company_name"), "company_id")
            .orderBy(_desc("avg_salary"), "company_id").limit(k)
            .select("company_name", "job_count", "max_salary", "avg_salary", "min_salary"))


SALARY_BUCKETS = [(1000, "Under 1000"), (2000, "1000 - 2000"), (3000, "2000 - 3000"),
                  (4000, "3000 - 4000"), (5000, "4000 - 5000")]


def salary_bucket(c: Column) -> Column:
    out = F.when(c.isNull(), F.lit("Not disclosed"))
    for bound, label in SALARY_BUCKETS:
        out = out.when(c < bound, F.lit(label))
    return out.otherwise(F.lit("Above 5000"))


def q07_salary_buckets(star: Star) -> DataFrame:
    """Histogram of salary_max.  The share's denominator excludes undisclosed
    salaries while the 'Not disclosed' row is still counted, as in the
    original; shares can therefore add up to more than 100."""
    fact = star.fact_jobs
    disclosed = fact.where(F.col("salary_max").isNotNull()).select(F.count(F.lit(1))).scalar()
    return (fact.groupBy(salary_bucket(F.col("salary_max")).alias("salary_range"))
            .agg(F.count(F.lit(1)).alias("job_count"))
            .withColumn("percentage", percent(F.col("job_count"), disclosed))
            .orderBy(_desc("job_count"), "salary_range"))


# ------------------------------------------------------------ companies, titles

def q03_top_companies(star: Star, k: int = 15) -> DataFrame:
    per = star.fact_jobs.groupBy("company_id").agg(
        F.count("job_id").alias("job_count"),
        F.count_distinct("location").alias("locations_count"),
        round0(F.avg(int_midpoint("salary_min", "salary_max"))).alias("avg_salary"),
    )
    return (per.join(star.dim_companies.select("company_id", "company_name"), "company_id")
            .orderBy(_desc("job_count"), "company_id").limit(k)
            .select("company_name", "job_count", "locations_count", "avg_salary"))


def q05_title_distribution(star: Star, k: int = 20) -> DataFrame:
    return (star.fact_jobs.groupBy("job_title").agg(
        F.count(F.lit(1)).alias("job_count"),
        round0(F.avg(int_midpoint("salary_min", "salary_max"))).alias("avg_salary"),
        F.count_distinct("company_id").alias("unique_companies"),
    ).orderBy(_desc("job_count"), "job_title").limit(k))


# ------------------------------------------------------------------ locations

def q06_location_popularity(star: Star, k: int = 15) -> DataFrame:
    """Share per location; the denominator counts all jobs, NULL location too."""
    fact = star.fact_jobs
    return (fact.where(F.col("location").isNotNull()).groupBy("location").agg(
        F.count(F.lit(1)).alias("job_count"),
        F.count_distinct("company_id").alias("unique_companies"),
    ).withColumn("percentage", percent(F.col("job_count"), _n_jobs(fact)))
        .orderBy(_desc("job_count"), "location").limit(k))


def v3_jobs_by_location(star: Star) -> DataFrame:
    return star.fact_jobs.where(F.col("location").isNotNull()).groupBy("location").agg(
        F.count(F.lit(1)).alias("job_count"),
        round0(F.avg("salary_min")).alias("avg_salary_min"),
        round0(F.avg("salary_max")).alias("avg_salary_max"),
    ).orderBy(_desc("job_count"), "location")


# ------------------------------------------------------------ quality, recency

QUALITY_METRICS = ["Total Jobs", "Jobs with Salary Info", "Jobs with Location",
                   "Unique Companies", "Unique Locations", "Unique Skills Mentioned"]


def q08_data_quality(star: Star) -> DataFrame:
    """Six metrics as (metric, value text) from one fact scan and one bridge
    scan, instead of six separate scans of a UNION ALL."""
    fact = star.fact_jobs
    n_skills = star.bridge_job_skills.select(F.count_distinct("skill_id")).scalar()
    values = [
        F.count(F.lit(1)),
        F.count_if(F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull()),
        F.count("location"),
        F.count_distinct("company_id"),
        F.count_distinct("location"),
    ]
    row = fact.agg(*[v.alias(f"m{i}") for i, v in enumerate(values)]).withColumn("m5", n_skills)
    named = row.select(*[F.col(f"m{i}").cast("string").alias(m) for i, m in enumerate(QUALITY_METRICS)])
    return named.unpivot([], QUALITY_METRICS, "metric", "value")


def _as_of_literal(as_of: str | None) -> Column:
    return F.lit(as_of).cast("timestamp_ntz") if as_of else F.localtimestamp()


def q10_recent_jobs(star: Star, as_of: str | None = None, days: int = 7, k: int = 20) -> DataFrame:
    """Jobs posted since midnight ``days`` days before ``as_of``."""
    if as_of:
        start = (datetime.fromisoformat(as_of).date() - timedelta(days=days)).isoformat()
        since = F.lit(start).cast("timestamp_ntz")
    else:
        since = F.date_sub(F.current_date(), days).cast("timestamp_ntz")
    recent = star.fact_jobs.where(F.col("posted_date") >= since)
    if "posted_month" in star.fact_jobs.columns:
        # Stored fact partitioned by month: the same bound on the partition
        # column lets the scan skip every older month folder.
        recent = recent.where(F.col("posted_month") >= F.date_format(since, "yyyy-MM"))
    return (recent.join(star.dim_companies.select("company_id", "company_name"), "company_id")
            .orderBy(_desc("posted_date"), "job_id").limit(k)
            .select("job_title", "company_name", "location", "salary_min", "salary_max",
                    "posted_date"))


def q13_scrape_status(star: Star, as_of: str | None = None, hours: int = 24) -> DataFrame:
    """Rolling window monitor; always exactly one row."""
    if as_of:
        since = F.lit((datetime.fromisoformat(as_of) - timedelta(hours=hours)).isoformat(" ")) \
            .cast("timestamp_ntz")
    else:
        since = F.localtimestamp() - F.make_dt_interval(hours=F.lit(hours))
    return star.fact_jobs.where(F.col("scraped_at") >= since).agg(
        F.max("scraped_at").alias("last_scrape_time"),
        F.count(F.lit(1)).alias("jobs_added"),
        F.round(F.avg("data_quality_score"), 2).alias("avg_quality"),
    )


def q14_missing_fields(star: Star, k: int = 20) -> DataFrame:
    f = star.fact_jobs
    flags = [("salary_min", "Missing salary_min"), ("location", "Missing location"),
             ("company_id", "Missing company")]
    cond = None
    for c, _ in flags:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return (f.where(cond).select(
        "job_id", "job_title",
        *[F.when(F.col(c).isNull(), F.lit(msg)).otherwise(F.lit("")).alias(f"missing_field_{i + 1}")
          for i, (c, msg) in enumerate(flags)],
    ).orderBy("job_id").limit(k))


# --------------------------------------------------------------------- export

def q12_export_jobs(star: Star, k: int = 100) -> DataFrame:
    """The k most recent jobs with their sorted skill list.

    The k jobs are chosen first (top-k over fact ⋈ companies) and written to
    the checkpoint folder, so the big inputs are read once; only then are the
    k jobs joined to the bridge (a broadcast of at most k ids) and their
    skill names aggregated.  Jobs without skills keep a NULL list.
    """
    top = (star.fact_jobs.join(star.dim_companies.select("company_id", "company_name"), "company_id")
           .orderBy(_desc("posted_date"), "job_id").limit(k)
           .select("job_id", "job_title", "company_name", "location", "salary_min", "salary_max",
                   "posted_date"))
    top = top.checkpoint(eager=True)
    skills = (star.bridge_job_skills.join(F.broadcast(top.select("job_id")), "job_id", "left_semi")  # k ids
              .join(star.dim_skills.select("skill_id", "skill_name"), "skill_id")
              .groupBy("job_id")
              .agg(F.array_join(F.array_sort(F.collect_list("skill_name")), ", ").alias("required_skills")))
    return (top.join(skills, "job_id", "left")
            .orderBy(_desc("posted_date"), "job_id")
            .select("job_id", "job_title", "company_name", "location", "salary_min", "salary_max",
                    "required_skills"))
