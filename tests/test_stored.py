"""Bucketed tables join without a shuffle; statistics change a join order."""

import re
import tempfile
import uuid

import pytest
from conftest import SF_SMALL

from hirelens.operators import stored
from hirelens.plans import reports
from hirelens.sources.bindings import star
from hirelens.sources.tables import Tables


@pytest.fixture(scope="module")
def kept(spark):
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield prefix, stored.store_bucketed(star(Tables(spark, SF_SMALL)), tempfile.mkdtemp(), prefix, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def shuffled_on(df):
    """Columns that the final plan deals rows by."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)), plan


@pytest.mark.parametrize("report", [reports.q09_skills_for_title, reports.v4_skills_by_location])
def test_no_row_moves_by_job(spark, kept, report):
    by, plan = shuffled_on(report(kept[1]))
    assert "job_id" not in by and "SortMergeJoin" in plan
    plain, _ = shuffled_on(report(star(Tables(spark, SF_SMALL))))
    assert "job_id" in plain
    assert report(kept[1]).collect() == report(star(Tables(spark, SF_SMALL))).collect()


def test_export_reads_the_bucketed_bridge_in_place(spark, kept):
    by, _ = shuffled_on(reports.q12_export_jobs(kept[1]))
    fact_or_bridge = reports.q12_export_jobs(kept[1]).collect()
    assert fact_or_bridge == reports.q12_export_jobs(star(Tables(spark, SF_SMALL))).collect()
    plan = reports.q12_export_jobs(kept[1])._jdf.queryExecution().optimizedPlan().toString()
    assert "bridge_job_skills" in plan and "hashpartitioning(job_id" not in re.sub(r"(?s)^.*?bridge_job_skills", "", plan)


def test_statistics_change_the_join_order(spark, kept):
    """Three tables, written with the two large ones first: with statistics the one company comes first."""
    prefix, tables = kept
    name = tables.dim_companies.first()["company_name"]
    sql = f"""SELECT count(*) FROM {prefix}bridge_job_skills b JOIN {prefix}fact_jobs f ON f.job_id = b.job_id
        JOIN {prefix}dim_companies c ON c.company_id = f.company_id WHERE c.company_name = '{name}'"""

    def first_joined():
        """Tables below the innermost join."""
        lines = spark.sql(sql)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        indent = [len(line) - len(line.lstrip(" :+-")) for line in lines]
        inner = max((i for i, line in enumerate(lines) if "Join Inner" in line), key=lambda i: indent[i])
        below = next((i for i in range(inner + 1, len(lines)) if indent[i] <= indent[inner]), len(lines))
        return set(re.findall(rf"{prefix}(\w+)", "\n".join(lines[inner:below])))

    stored.cost_based(spark)
    try:
        spark.sql(f"ANALYZE TABLE {prefix}dim_companies COMPUTE STATISTICS NOSCAN")
        without = first_joined()
        stored.collect_statistics(spark, prefix)
        with_statistics = first_joined()
        counted = spark.sql(sql).first()[0]
    finally:
        stored.cost_based(spark, on=False)
    assert counted == spark.sql(sql).first()[0]
    assert without == {"bridge_job_skills", "fact_jobs"}
    assert with_statistics == {"fact_jobs", "dim_companies"}
