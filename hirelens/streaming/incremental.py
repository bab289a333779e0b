"""Incremental ingest with Structured Streaming (E5).

The original re-reads and re-processes the whole raw collection every day.
Here landed raw files are a file stream; each micro-batch is processed and
appended once:

* ``Trigger.AvailableNow`` drains what has landed and stops, so a daily
  schedule becomes a bounded run with exactly-once progress tracking in the
  checkpoint folder;
* ``foreachBatch`` drops postings whose url an *earlier* batch already
  stored (the scraper's cross-batch rule); a posting without a url is known
  only by its whole content (``with_match``).  The batch is computed once, and
  what is stored is looked up in the target's key table (``History``): only key
  buckets that may hold one of the batch's keys are read.  Then the batch is
  written as its own ``_batch`` partition, so a retried batch replaces its own
  output and keys instead of duplicating them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirelens.sources.history import BATCH_COL, History
from hirelens.sources.io import MATCH, path_exists, spooled, with_match, write_batch


def _ensure_target(spark: SparkSession, target: str, schema: StructType,
                   transform: Callable[[DataFrame], DataFrame] | None, key: str) -> None:
    """Create the target once, typed and empty."""
    if not path_exists(spark, target):
        empty = spark.createDataFrame([], schema)
        out = with_match(transform(empty) if transform else empty, key).withColumn(BATCH_COL, F.lit(-1).cast("long"))
        out.write.partitionBy(BATCH_COL).parquet(target)


def incremental_ingest(spark: SparkSession, landing: str, schema: StructType, target: str,
                       checkpoint: str, key: str = "url",
                       transform: Callable[[DataFrame], DataFrame] | None = None,
                       files_per_batch: int | None = None) -> None:
    """Process every landed file not processed yet, then stop.

    Without ``files_per_batch`` everything that landed since the last run is
    one micro-batch (the daily run); with it, at most that many files each.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        history = History(batch.sparkSession, target, MATCH)
        history.begin_batch(batch_id)
        rows = spooled(with_match(transform(batch) if transform else batch, key), "micro-batch")
        history.end_batch(batch_id, write_batch(history.unknown(rows, batch_id), target, batch_id))

    _ensure_target(spark, target, schema, transform, key)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (reader.parquet(landing)
             .writeStream.foreachBatch(ingest)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
