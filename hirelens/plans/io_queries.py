"""Checked queries for sources, sinks and the incremental stream.

Each writes to a fresh folder under the session's checkpoint directory
(a shared location on a cluster), then reads the result back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.operators.cleaning import process
from hirelens.schemas import RAW
from hirelens.session import scratch_path
from hirelens.sources.bindings import AS_OF, landed_postings, raw_jobs
from hirelens.operators.keys import assign_keys
from hirelens.sources.io import append_new, append_raw, purge, read_raw, sample_rows, with_scrape_month, write_table
from hirelens.sources.tables import Tables
from hirelens.streaming.dedupe import ingest_within
from hirelens.streaming.incremental import incremental_ingest

PROCESSED_AT = AS_OF.replace(" ", "T")
PROCESSED_COLS = ["job_id", "title", "company", "location", "url", "scraped_at", "salary_min", "salary_max",
                 "processed_at", "data_quality_score"]
RAW_COLS = [f.name for f in RAW.fields]
# Landing batches of the incremental example: postings arrive by scrape year.
LANDING_YEARS = [1997, 1999, 2001]


def _processed(spark, sf_dir):
    return process(raw_jobs(Tables(spark, sf_dir)), PROCESSED_AT).select(*PROCESSED_COLS)


def _skills_as_text(raw):
    return raw.select(*[c for c in RAW_COLS if c != "skills"], F.array_join("skills", ",").alias("skills"))


def parquet_roundtrip_q(spark, sf_dir):
    path = scratch_path(spark, "processed")
    write_table(with_scrape_month(_processed(spark, sf_dir)), path, partition_by=["scrape_month"])
    return spark.read.parquet(path).select(*PROCESSED_COLS)


def append_processed_q(spark, sf_dir):
    """Appending the same processed batch twice stores it once."""
    path = scratch_path(spark, "processed-append")
    df = _processed(spark, sf_dir)
    append_new(df, path, key="url")
    append_new(df, path, key="url")
    return spark.read.parquet(path).select(*PROCESSED_COLS)


def sample_rows_q(spark, sf_dir):
    return sample_rows(_processed(spark, sf_dir), 5, ["job_id"])


def read_raw_json_q(spark, sf_dir):
    """Raw postings landed as JSON lines, read back with the explicit schema."""
    path = scratch_path(spark, "raw-json")
    raw_jobs(Tables(spark, sf_dir)).select(*RAW_COLS).write.json(path)
    return _skills_as_text(read_raw(spark, path, fmt="json"))


def landing_batch(scraped_at):
    year = F.year(scraped_at.try_cast("timestamp_ntz"))
    out = None
    for i, y in enumerate(LANDING_YEARS):
        out = F.when(year < y, i) if out is None else out.when(year < y, i)
    return out.otherwise(len(LANDING_YEARS))


def incremental_ingest_q(spark, sf_dir):
    """Raw postings land in yearly batches; after each landing the stream
    runs (AvailableNow), cleans each micro-batch (the C10 chain) and keeps a
    posting unless an earlier batch already stored its url."""
    raw = raw_jobs(Tables(spark, sf_dir)).withColumn("_b", landing_batch(F.col("scraped_at")))
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "target", "stream-ckpt"))
    schema = raw.drop("_b").schema
    for b in range(len(LANDING_YEARS) + 1):
        raw.where(F.col("_b") == b).drop("_b").write.parquet(f"{landing}/b{b}")
        incremental_ingest(spark, f"{landing}/*", schema, target, ckpt, key="url",
                           transform=lambda batch: process(batch, PROCESSED_AT))
    return spark.read.parquet(target).select("job_id", "title", "company", "url", "salary_min", "salary_max")


def streamed_postings_q(spark, sf_dir):
    """Postings land out of order and again, in five landings; after each the
    stream runs.  What it stored, and how many rows were too late in all."""
    landed = landed_postings(Tables(spark, sf_dir))
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "streamed", "stream-ckpt"))
    schema, late = landed.drop("landing").schema, 0
    for i in range(5):
        landed.where(F.col("landing") == i).drop("landing").write.parquet(f"{landing}/l{i}")
        late += ingest_within(spark, f"{landing}/*", schema, target, ckpt, delay="700 days")
    return spark.read.parquet(target).withColumn("late_rows", F.lit(late).cast("long"))


def append_raw_q(spark, sf_dir):
    """Raw postings appended by scrape month and read back."""
    path = scratch_path(spark, "raw-append")
    append_raw(raw_jobs(Tables(spark, sf_dir)).select(*RAW_COLS), path)
    return _skills_as_text(spark.read.parquet(path))


def purge_q(spark, sf_dir):
    """Two stored collections emptied: how many rows each lost, and holds."""
    raw = raw_jobs(Tables(spark, sf_dir)).select(*RAW_COLS)
    tables = {"raw_jobs": (scratch_path(spark, "purge-raw"), RAW),
              "jobs_without_salary": (scratch_path(spark, "purge-some"), RAW)}
    raw.write.parquet(tables["raw_jobs"][0])
    raw.where("salary is null").write.parquet(tables["jobs_without_salary"][0])
    deleted = purge(spark, tables)
    left = [spark.read.parquet(path).select(F.lit(name).alias("collection"), F.lit(deleted[name]).cast("long").alias(
        "deleted")).groupBy("collection", "deleted").count() for name, (path, _) in tables.items()]
    counts = spark.createDataFrame([(n, d) for n, d in deleted.items()], "collection string, deleted long")
    held = reduce(DataFrame.unionByName, left).select("collection", F.col("count").alias("_left"))
    return counts.join(held, "collection", "left").select("collection", "deleted",
                                                          F.coalesce("_left", F.lit(0)).cast("long").alias("left"))


def surrogate_keys_q(spark, sf_dir):
    """Dense keys over the largest table in (order, line) order, no
    single-partition window."""
    li = Tables(spark, sf_dir)("lineitem").select("l_orderkey", "l_linenumber")
    return assign_keys(li, ["l_orderkey", "l_linenumber"], "line_key")


IO_QUERIES = {
    "parquet_roundtrip": parquet_roundtrip_q,
    "append_processed": append_processed_q,
    "sample_rows": sample_rows_q,
    "read_raw_json": read_raw_json_q,
    "incremental_ingest": incremental_ingest_q,
    "streamed_postings": streamed_postings_q,
    "append_raw": append_raw_q,
    "purge": purge_q,
    "surrogate_keys": surrogate_keys_q,
}
