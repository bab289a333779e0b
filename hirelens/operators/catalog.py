"""Table creation and reporting views.

``ensure_tables`` is the ``CREATE TABLE IF NOT EXISTS`` of the warehouse
DDL: each table is a Parquet folder with the DDL's schema, created empty
only when missing, so running it again changes nothing.  ``register_views``
is ``CREATE OR REPLACE VIEW`` for the four reporting views, as session temp
views over whatever star tables are given.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hirelens.plans import reports
from hirelens.schemas import WAREHOUSE
from hirelens.sources.bindings import Star
from hirelens.sources.io import path_exists

VIEWS = {
    "v_top_skills": reports.v1_top_skills,
    "v_salary_by_company": reports.v2_salary_by_company,
    "v_jobs_by_location": reports.v3_jobs_by_location,
    "v_skills_by_location": reports.v4_skills_by_location,
}


def ensure_tables(spark: SparkSession, base: str, table_prefix: str | None = None) -> dict[str, bool]:
    """Create every missing warehouse table under ``base``; report which were new.

    With ``table_prefix`` each table is also registered in the session
    catalog as an external Parquet table ``<prefix><name>`` at its folder
    (CREATE TABLE IF NOT EXISTS ... USING parquet LOCATION ...).
    """
    created = {}
    for name, schema in WAREHOUSE.items():
        path = f"{base.rstrip('/')}/{name}"
        if path_exists(spark, path):
            created[name] = False
        else:
            spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
            created[name] = True
        if table_prefix and not spark.catalog.tableExists(table_prefix + name):
            spark.catalog.createTable(table_prefix + name, path=path, source="parquet", schema=schema)
    return created


def register_views(star: Star) -> list[str]:
    for name, fn in VIEWS.items():
        fn(star).createOrReplaceTempView(name)
    return list(VIEWS)
