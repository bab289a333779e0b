"""q04 pair counting: exact against brute force, also with hot jobs split."""

import itertools
import random
from collections import Counter

import pytest

from hirelens import session
from hirelens.plans.reports import _job_skill_pairs, q04_skill_pairs
from hirelens.sources.bindings import Star


def brute(rows):
    by_job = {}
    for j, s in rows:
        by_job.setdefault(j, set()).add(s)
    c = Counter()
    for skills in by_job.values():
        for a, b in itertools.combinations(sorted(skills), 2):
            c[(a, b)] += 1
    return c


@pytest.mark.parametrize("block", [1, 2, 3, 5, 1024])
def test_pairs_exact_with_split(spark, block):
    rnd = random.Random(block)
    rows = {(0, s) for s in range(40)}                     # one hot job: 40 skills
    rows |= {(j, rnd.randint(0, 50)) for j in range(1, 60) for _ in range(4)}
    rows = sorted(rows)
    df = spark.createDataFrame(rows, "job_id long, skill_id long")
    got = Counter((r.skill_id_1, r.skill_id_2) for r in _job_skill_pairs(df, block).collect())
    assert got == brute(rows)


def test_top_pairs_with_hot_job(spark):
    rows = sorted({(0, s) for s in range(30)} | {(j, s) for j in range(1, 5) for s in (3, 7, 9)})
    star = Star(spark.createDataFrame([(1,)], "job_id long"),
                spark.createDataFrame([], "company_id long, company_name string"),
                spark.createDataFrame([(s, f"s{s}") for s in range(30)], "skill_id long, skill_name string"),
                spark.createDataFrame(rows, "job_id long, skill_id long"))
    top = q04_skill_pairs(star, k=3, hot_job_skills=4).collect()
    assert sorted((r.skill_1, r.skill_2, r.co_occurrence_count) for r in top) == \
        [("s3", "s7", 5), ("s3", "s9", 5), ("s7", "s9", 5)]


def test_larger_inputs_make_more_tasks_not_larger_ones(spark, monkeypatch):
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}
    monkeypatch.setattr(session, "TASK_BYTES", 1 << 20)
    try:
        spark.conf.unset(keys[2])
        rows = spark.range(3_000_000).selectExpr("xxhash64(id) as a").groupBy("a").count().where("count > 0")
        merged = rows.rdd.getNumPartitions()
        session.small_shuffle_tasks(spark)
        rows = spark.range(3_000_000).selectExpr("xxhash64(id) as a").groupBy("a").count().where("count > 0")
        assert rows.rdd.getNumPartitions() >= 20 > merged
        spark.conf.set(keys[0], "512k")
        session.small_shuffle_tasks(spark)
        assert spark.conf.get(keys[0]) == "512k"  # a smaller one stays
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_pairs_are_counted_in_small_tasks(spark):
    bridge = spark.createDataFrame([(1, 1), (1, 2)], "job_id long, skill_id long")
    skills = spark.createDataFrame([(1, "a"), (2, "b")], "skill_id long, skill_name string")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    q04_skill_pairs(Star(bridge, skills, skills, bridge))
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= session.TASK_BYTES
