"""Name -> (spark, sf_dir) -> DataFrame for every checked query."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hirelens.operators.stored import store_bucketed
from hirelens.plans import reports
from hirelens.plans.cleaning_queries import CLEANING_QUERIES
from hirelens.plans.ingest_queries import INGEST_QUERIES
from hirelens.plans.io_queries import IO_QUERIES
from hirelens.plans.warehouse_queries import WAREHOUSE_QUERIES
from hirelens.session import scratch_path
from hirelens.sources import bindings
from hirelens.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


def _on_star(fn, **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(bindings.star(Tables(spark, sf_dir)), **params)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _on_stored(fn, **params) -> Query:
    """The report over fact and bridge stored in buckets of job ids."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prefix = f"star_{uuid.uuid4().hex[:12]}_"
        return fn(store_bucketed(bindings.star(Tables(spark, sf_dir)), scratch_path(spark, "star"), prefix), **params)

    run.__name__, run.__doc__ = f"stored_{fn.__name__}", fn.__doc__
    return run


AS_OF = bindings.AS_OF

REPORT_QUERIES: dict[str, Query] = {
    "q01_top_skills": _on_star(reports.q01_top_skills),
    "q02_salary_by_location": _on_star(reports.q02_salary_by_location),
    "q03_top_companies": _on_star(reports.q03_top_companies),
    "q04_skill_pairs": _on_star(reports.q04_skill_pairs),
    "q05_title_distribution": _on_star(reports.q05_title_distribution),
    "q06_location_popularity": _on_star(reports.q06_location_popularity),
    "q07_salary_buckets": _on_star(reports.q07_salary_buckets),
    "q08_data_quality": _on_star(reports.q08_data_quality),
    "q09_skills_for_title": _on_star(reports.q09_skills_for_title),
    "q10_recent_jobs": _on_star(reports.q10_recent_jobs, as_of=AS_OF),
    "q11_company_salary": _on_star(reports.q11_company_salary),
    "q12_export_jobs": _on_star(reports.q12_export_jobs),
    "q13_scrape_status": _on_star(reports.q13_scrape_status, as_of=AS_OF),
    "q14_missing_fields": _on_star(reports.q14_missing_fields),
    "v1_top_skills": _on_star(reports.v1_top_skills),
    "v2_salary_by_company": _on_star(reports.v2_salary_by_company),
    "v3_jobs_by_location": _on_star(reports.v3_jobs_by_location),
    "v4_skills_by_location": _on_star(reports.v4_skills_by_location),
}

STORED_QUERIES: dict[str, Query] = {
    "stored_q09_skills_for_title": _on_stored(reports.q09_skills_for_title),
    "stored_q12_export_jobs": _on_stored(reports.q12_export_jobs),
    "stored_v4_skills_by_location": _on_stored(reports.v4_skills_by_location),
}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(REPORT_QUERIES)
    out.update(STORED_QUERIES)
    out.update(CLEANING_QUERIES)
    out.update(WAREHOUSE_QUERIES)
    out.update(INGEST_QUERIES)
    out.update(IO_QUERIES)
    return out
