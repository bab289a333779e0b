"""Reading, spooling and Arrow helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import scratch_path

#: Text bytes handled at once inside a task; bounds a Python worker's memory.
SLICE_BYTES = 600_000
#: The same where every word is classified, which takes some hundred times a text's bytes.
CLASSIFIED_BYTES = 300_000
#: Rows that a task gets at once.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Tasks pass at most ``BATCH_ROWS`` rows at once between the JVM and
    Python (fewer, if the session says so): whole texts are wide rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fresh read of one input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spooled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage ends
    at files that outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return _read(df, path)


def _read(like: DataFrame, path: str) -> DataFrame:
    out = like.sparkSession.read.schema(like.schema).parquet(path)
    out.spool_path = path
    return out


def again(df: DataFrame) -> DataFrame:
    """Another read of a ``spooled`` table, to join or cogroup it with itself."""
    return _read(df, df.spool_path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a ``spooled`` table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.spool_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sampled(rows: DataFrame, id_col: str, count: int, most: int) -> DataFrame:
    """At most ``most`` rows, those with the least hash of their id: by a
    threshold first, so that only about twice as many are sorted at all."""
    share = min(1.0, 2 * most / max(count, 1))
    key = F.pmod(F.xxhash64(id_col), F.lit(1_000_000))
    return (rows.where(key < F.lit(int(share * 1_000_000) + 1)).distinct()
            .orderBy(key, id_col).limit(most))


def text_slices(batch: pa.RecordBatch, column: str = "text",
                most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into slices of whole rows with at most ``most`` text bytes
    (one longer text is a slice of its own).  Yields the slice, its UTF-8
    bytes and the row offsets into them; a null text is empty.
    """
    col = batch.column(column)
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    col = col.fill_null("")
    n = len(col)
    if n == 0:
        return
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[col.offset:col.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield batch.slice(i, j - i), raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j
