"""Dedupe of a stream by keyed state: no stored table is read at all.

``incremental_ingest`` looks every posting up in what is stored, for all time.
A scraper mostly sees the same posting again within some days, and for that
Spark's own state is enough: a key that was seen stays in the state for
``delay`` of event time, a posting that brings it again meanwhile is dropped.
State grows with the keys of that span only.

What becomes of a posting, by its key and its time:

* its time isn't after the watermark (the latest time of earlier batches less
  ``delay``): it is *late*, its key may have been forgotten, so it is neither
  stored nor remembered; late postings are counted and the number is returned;
* its key was first seen at a time less than ``delay`` before the watermark or
  after it: a repetition, dropped (it doesn't prolong the memory);
* otherwise it is stored, and remembered until the watermark passes its time
  plus ``delay``;
* without a real key, or without a time, it can't be compared: stored.

Of repetitions inside one batch one is stored.  The sink is a file sink with its
own log, so a batch that is repeated after a failure is stored once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirelens.sources.io import NO_KEY

#: Reports of batches that one run keeps (to sum up late rows): more batches than this in one run is an error.
MOST_BATCHES = 100_000


def dedupe_within(stream: DataFrame, delay: str, key: str = "url", time: str = "scraped_at") -> DataFrame:
    """The streaming plan: rows of ``stream`` but repetitions and late ones."""
    at = F.col(time).try_cast("timestamp")
    timed = stream.withColumn("_at", at)
    comparable = F.col(key).isNotNull() & ~F.col(key).isin(*NO_KEY) & F.col("_at").isNotNull()
    known = timed.where(comparable).withWatermark("_at", delay).dropDuplicatesWithinWatermark([key])
    return known.drop("_at").unionByName(timed.where(~comparable).drop("_at"))


def ingest_within(spark: SparkSession, landing: str, schema: StructType, target: str, checkpoint: str, delay: str,
                  key: str = "url", time: str = "scraped_at", files_per_batch: int | None = None) -> int:
    """Store what has landed since the last run but repetitions; returns the number of late rows."""
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    spark.conf.set(kept, MOST_BATCHES)
    try:
        query = (dedupe_within(reader.parquet(landing), delay, key, time).writeStream.format("parquet")
                 .option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(kept, before)
    batches = query.recentProgress
    if len(batches) >= MOST_BATCHES:
        raise RuntimeError("more batches than reports of them")
    return sum(op["numRowsDroppedByWatermark"] for batch in batches for op in batch["stateOperators"])
