"""The star as catalog tables: fact and bridge bucketed by job, with statistics.

* ``store_bucketed`` writes fact and bridge with the same number of buckets on
  ``job_id``, sorted in each.  A report that joins them reads bucket by bucket:
  no row of either moves.  The shuffle is paid once, when a table is stored,
  and not by every report.
* ``collect_statistics`` counts rows, distinct values and ranges per column
  (``ANALYZE TABLE``), from which the cost-based optimiser orders joins;
  ``cost_based`` switches it on for a session.

A bucket is one task.  That is safe here since a job's rows are few: one in the
fact, and in the bridge at most one per skill (UNIQUE (job_id, skill_id), a
dictionary of fixed size).  A bridge whose jobs have skills without bound should
stay unbucketed, where AQE splits a hot job's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelens.sources.bindings import Star

#: Tables that are joined on the job, and the column.
BY_JOB, JOB = ("fact_jobs", "bridge_job_skills"), "job_id"
TABLES = ("fact_jobs", "dim_companies", "dim_skills", "bridge_job_skills")


def store_bucketed(star: Star, base: str, prefix: str, buckets: int | None = None) -> Star:
    """Store the star's tables at ``base`` under names that begin with
    ``prefix`` and give them back as stored.  ``buckets``: as many as a shuffle
    has partitions, if not given; size them so that a bucket fits a task."""
    spark = star.fact_jobs.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in TABLES:
        df: DataFrame = getattr(star, name)
        if name in BY_JOB:  # one file per bucket
            writer = df.repartition(n, JOB).write.bucketBy(n, JOB).sortBy(JOB)
        else:
            writer = df.write
        writer.mode("overwrite").option("path", f"{base.rstrip('/')}/{name}").saveAsTable(prefix + name)
    return stored_star(spark, prefix)


def stored_star(spark: SparkSession, prefix: str) -> Star:
    return Star(*(spark.table(prefix + name) for name in
                  ("fact_jobs", "dim_companies", "dim_skills", "bridge_job_skills")))


def collect_statistics(spark: SparkSession, prefix: str) -> None:
    """Row counts and column statistics of the stored tables, for the optimiser."""
    for name in TABLES:
        spark.sql(f"ANALYZE TABLE {prefix}{name} COMPUTE STATISTICS FOR ALL COLUMNS")


def cost_based(spark: SparkSession, on: bool = True) -> None:
    """Let the optimiser order joins by the collected statistics."""
    for key in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled"):
        spark.conf.set(key, str(on).lower())
