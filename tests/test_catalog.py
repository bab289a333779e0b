"""Idempotent table creation and the reporting views."""

import os
import tempfile

from hirelens.operators.catalog import ensure_tables, register_views
from hirelens.schemas import WAREHOUSE
from hirelens.sources.bindings import star
from hirelens.sources.tables import Tables

from conftest import SF_SMALL


def test_ensure_tables_is_idempotent(spark):
    base = os.path.join(tempfile.mkdtemp(prefix="hirelens-test-"), "wh")
    first = ensure_tables(spark, base)
    assert all(first.values())
    assert not any(ensure_tables(spark, base).values())
    for name, schema in WAREHOUSE.items():
        df = spark.read.schema(schema).parquet(f"{base}/{name}")
        assert df.count() == 0
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_views(spark):
    names = register_views(star(Tables(spark, SF_SMALL)))
    assert spark.sql("SELECT count(*) FROM v_jobs_by_location").first()[0] == 25
    assert set(names) == {"v_top_skills", "v_salary_by_company", "v_jobs_by_location", "v_skills_by_location"}


def test_tables_registered_in_catalog(spark):
    import uuid

    base = os.path.join(tempfile.mkdtemp(prefix="hirelens-test-"), "wh")
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    ensure_tables(spark, base, table_prefix=prefix)
    ensure_tables(spark, base, table_prefix=prefix)       # idempotent
    assert spark.table(prefix + "fact_jobs").count() == 0
    assert [f.name for f in spark.table(prefix + "dim_skills").schema] == \
        ["skill_id", "skill_name", "skill_category", "created_at"]
