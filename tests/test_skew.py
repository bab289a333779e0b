"""Hot keys: a job / url holding a third of all rows is split by AQE's
skew join (thresholds lowered to test size), and results stay exact."""

import contextlib
import io
from contextlib import contextmanager

from pyspark.sql import functions as F

from hirelens.operators.dedupe import dedupe_cross_batch
from hirelens.plans import reports
from hirelens.sources.bindings import Star


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def final_plan(df):
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("\n+- == Initial Plan ==")[0]


def hot_star(spark, n_jobs=3000, hot=0):
    import datetime as dt
    t = dt.datetime(2001, 7, 1)
    facts = [(j, 1, "t", "u", f"L{j % 7}", 1, 2, t, t, 1.0) for j in range(n_jobs)]
    bridge = [(j, j % 50) for j in range(1, n_jobs)] + [(hot, s) for s in range(n_jobs // 2)]
    fact = spark.createDataFrame(facts, "job_id long, company_id long, job_title string, job_url string, "
                                 "location string, salary_min int, salary_max int, posted_date timestamp_ntz, "
                                 "scraped_at timestamp_ntz, data_quality_score double")
    return Star(fact.repartition(8),
                spark.createDataFrame([(1, "c")], "company_id long, company_name string"),
                spark.createDataFrame([(s, f"s{s}") for s in range(n_jobs)], "skill_id long, skill_name string"),
                spark.createDataFrame(bridge, "job_id long, skill_id long").repartition(8))


def test_hot_job_join_is_split(spark):
    star = hot_star(spark)
    with conf(spark, **SKEW):
        df = reports.v4_skills_by_location(star)
        plan = final_plan(df)
        got = df.agg(F.sum("skill_count")).first()[0]
    assert "skew=true" in plan
    assert got == star.bridge_job_skills.count()


def test_hot_url_dedupe_is_split_and_exact(spark):
    rows = [(i, i % 3, "hot" if i % 3 == 0 else f"u{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "pos long, batch_idx long, url string").repartition(8)
    with conf(spark, **SKEW):
        out = dedupe_cross_batch(df)
        plan = final_plan(out)
        n = out.count()
    assert "skew=true" in plan
    assert n == 6000 - 0  # the hot url only occurs in batch 0: all its rows survive
