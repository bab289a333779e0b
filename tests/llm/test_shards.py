"""Jump consistent hashing against a plain version, and the numbering of slots."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from hirelens.llm import jump_shards


def plain_jump(key, n):
    key, passed, following = key % 2**64, -1, 0
    while following < n:
        passed = following
        key = (key * jump_shards.MULTIPLIER + 1) % 2**64
        following = int((passed + 1) * (2.0**31 / ((key >> 33) + 1)))
    return passed


@pytest.mark.parametrize("shards", [1, 2, 16, 1000])
def test_walk_equals_the_plain_one(spark, shards):
    rng = random.Random(shards)
    keys = [0, 1, -1, 2**63 - 1, -2**63, *(rng.randrange(-2**63, 2**63) for _ in range(200)), *range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    shard, grown = jump_shards.shard_columns(F.col("k"), shards)
    for r in df.select("k", shard.alias("s"), grown.alias("g")).collect():
        assert (r["s"], r["g"]) == (plain_jump(r["k"], shards), plain_jump(r["k"], shards + 1))


def test_shards_are_even_and_growth_moves_one_part(spark):
    df = jump_shards.sharded(spark.range(200_000).withColumnRenamed("id", "doc_id"), 16, grown_col="g")
    sizes = [r["count"] for r in df.groupBy("shard").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.03 * min(sizes)
    moved = df.where("shard <> g")
    assert moved.where("g <> 16").count() == 0
    assert abs(moved.count() / 200_000 - 1 / 17) < 0.003


def checked(got, rows, shards):
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    places = {}
    for r in got:
        assert (r["law"], r["shard"], r["grown_shard"]) == (
            "key", plain_jump(r["doc_id"] or 0, shards), plain_jump(r["doc_id"] or 0, shards + 1))
        places.setdefault(r["shard"], []).append(r["slot"])
    for slots in places.values():
        assert sorted(slots) == list(range(len(slots)))


def test_slots(spark, monkeypatch):
    monkeypatch.setattr(jump_shards, "COPIES_CHUNK", 50)
    rows = [(i, f"text {i} é") for i in range(300)] + [(7, "same")] * 400 + [(7, "other")] * 3 + [(None, None)] * 5 + [
        (8, ""), (8, None), (9, "long " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x")).withColumn(
        "size", F.lit(-1)).withColumn("slot", F.lit(0))
    got = jump_shards.slots(df, 5)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    checked(got.collect(), rows, 5)
    assert jump_shards.slots(df.limit(0), 5).count() == 0


def test_ids_of_other_kinds(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z"), ("a", "w")], "doc_id string, text string")
    got = jump_shards.slots(df, 3).collect()
    assert len(got) == 4 and len({r["shard"] for r in got if r["doc_id"] == "a"}) == 1


def test_no_python_on_the_path(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = jump_shards.slots(df, 16)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_written_shards(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    jump_shards.write_shards(df, str(tmp_path / "out"), 4, rows_per_file=60)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500
    assert all(r["shard"] == plain_jump(r["doc_id"], 4) for r in back.collect())
