"""Surrogate keys, dedupe rules and exact quantiles against brute force."""

import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from hirelens.operators.dedupe import dedupe_cross_batch, dedupe_strict, keyword_slice, keyword_targets
from hirelens.operators.keys import assign_keys
from hirelens.operators.quality import exact_quantiles, null_profile
from hirelens.sources.bindings import url_batches
from hirelens.sources.tables import Tables

from conftest import SF_SMALL


def test_assign_keys_equals_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 50), rnd.choice(["a", "b", None]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "x int, y string, u int")
    order = ["x", "y", "u"]
    got = assign_keys(df, order, "k", start=100, num_partitions=7)
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    want = df.withColumn("k", F.row_number().over(w) + 100)
    assert sorted(got.select("u", "k").collect()) == sorted(want.select("u", "k").collect())


def test_assign_keys_dense(spark):
    df = spark.range(0, 1000).withColumn("v", -F.col("id"))
    keys = sorted(r.k for r in assign_keys(df, ["v"], "k").collect())
    assert keys == list(range(1, 1001))


def _reference_rule(rows):
    """The scraper's loop: drop urls seen in earlier batches only."""
    kept, seen_all = [], []
    for b in sorted({r[1] for r in rows}):
        seen = {r[2] for r in seen_all}
        batch = [r for r in rows if r[1] == b]
        new = [r for r in batch if r[2] not in seen]
        kept += new
        seen_all += new
    return sorted(kept, key=lambda r: (r[0], r[1], str(r[2])))


def test_dedupe_cross_batch_matches_loop(spark):
    df = url_batches(Tables(spark, SF_SMALL))
    rows = [tuple(r) for r in df.collect()]
    got = sorted((tuple(r) for r in dedupe_cross_batch(df).collect()), key=lambda r: (r[0], r[1], str(r[2])))
    assert got == _reference_rule(rows)


def test_dedupe_strict_first_per_url(spark):
    df = url_batches(Tables(spark, SF_SMALL))
    rows = [tuple(r) for r in df.collect()]
    first = {}
    for pos, b, url in sorted(rows, key=lambda r: (r[1], r[0])):
        first.setdefault(url, (pos, b, url))
    got = sorted(tuple(r) for r in dedupe_strict(df).collect())
    assert got == sorted(first.values())


def test_keyword_slice(spark):
    assert len(keyword_slice(50)) == 50 and keyword_slice(3) == ["java", "python", "javascript"]
    assert len(keyword_slice(0)) == 50 and len(keyword_slice(5)) == 50
    t = keyword_targets(spark, 2).collect()
    assert [r.target_url for r in t][-1].endswith("/python")


def test_exact_quantiles_vs_numpy(spark):
    rnd = np.random.default_rng(3)
    vals = rnd.integers(0, 500, 2001).tolist() + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, "v", probs).first()
    arr = np.array([v for v in vals if v is not None], dtype=float)
    for i, p in enumerate(probs):
        assert abs(got[f"q{i}"] - np.quantile(arr, p)) < 1e-9


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (3, None)], "a int, b string")
    got = {r.column_name: (r.null_count, r.total_rows) for r in null_profile(df).collect()}
    assert got == {"a": (1, 3), "b": (2, 3)}


def test_assign_keys_with_copy_groups(spark):
    rows = [("dup", 1)] * 3000 + [(f"r{i}", i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "a string, b int")
    got = assign_keys(df, ["a", "b"], "k", num_partitions=8, copies_chunk=100)
    keys = sorted(r.k for r in got.collect())
    assert keys == list(range(1, 5001))
    # same keys per row as the plain path (copies are interchangeable)
    plain = assign_keys(df, ["a", "b"], "k", num_partitions=8)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in plain.collect())
    # no partition holds the whole copy group
    sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3000


def test_quantiles_of_nothing_are_null(spark):
    from hirelens.operators.quality import salary_outliers, salary_quartiles

    df = spark.createDataFrame([(1, None, None), (2, 5, None)], "job_id long, salary_min int, salary_max int")
    q = salary_quartiles(df).first()
    assert q.q1 is None and q.upper_fence is None
    assert salary_outliers(df).count() == 0
