"""Sources and sinks.

* raw postings are read with the explicit RAW schema from any file format
  or installed connector, never inferred;
* writes are Parquet (or any format) with dynamic partition overwrite, so
  re-running a day replaces that day only;
* ``append_new`` is idempotent: rows that the target already holds are not
  written again (the original re-processed and re-appended everything);
  ``append_raw`` is a plain append, as the original's was;
* counts come from ``observe`` in the same job as the write.

Everything works on paths (a shared file system or object store on a
cluster).  Database connectors (JDBC, document stores) go through the same
``format``/``options`` calls; no server is started or contacted here.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirelens.schemas import RAW
from hirelens.session import scratch_path
from hirelens.sources.files import delete, path_exists
from hirelens.sources.history import BATCH_COL, History


def empty_frame(spark: SparkSession, schema: StructType = RAW) -> DataFrame:
    """Typed empty frame, so later steps run on empty input (A2)."""
    return spark.createDataFrame([], schema)


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType = RAW,
             on_error: str = "raise", **options) -> DataFrame:
    """Read raw postings with an explicit schema (A1).  A missing source
    raises, unless ``on_error="empty"`` asks for the typed empty frame."""
    try:
        df = spark.read.schema(schema).format(fmt).options(**options).load(path)
        df.schema  # noqa: B018 - resolve now so a missing path fails here
        return df
    except AnalysisException:
        if on_error == "empty":
            return empty_frame(spark, schema)
        raise


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, one_partition: bool = False, **options) -> int:
    """Write and return the row count, measured in the same job (A3, A5).  With
    ``one_partition`` all rows lie in one partition: they are written where they
    are, as a shuffle by its value would bring them all to one task."""
    obs = Observation("write_table")
    if partition_by and not one_partition:
        # One writer per output partition instead of every task writing into
        # every partition; AQE splits a skewed partition and merges small ones.
        df = df.hint("rebalance", *partition_by)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.save(path)
    return int(obs.get.get("rows", 0))


def append_raw(raw: DataFrame, path: str) -> int:
    """Append raw postings partitioned by scrape month; 0 rows writes nothing."""
    return write_table(with_scrape_month(raw), path, mode="append", partition_by=["scrape_month"])


def with_scrape_month(df: DataFrame, col: str = "scraped_at") -> DataFrame:
    ts = F.col(col).try_cast("timestamp_ntz")
    return df.withColumn("scrape_month", F.date_format(ts, "yyyy-MM"))


#: Column that append targets carry: what a stored row is recognised by.
MATCH = "_match"
#: Values of a key that name nothing, and columns that differ between runs over the same posting.
NO_KEY, STAMPS = ("", "N/A"), ("processed_at",)


def with_match(df: DataFrame, key: str) -> DataFrame:
    """Add ``_match``: a digest of a real key, else of the row's whole content
    (but for run stamps).  A missing key is no key: rows without one are the
    same posting only if everything else is equal."""
    content = F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in STAMPS]),
                        {"ignoreNullFields": "false"})
    real = F.col(key).isNotNull() & ~F.col(key).isin(*NO_KEY)
    named = F.when(real, F.concat(F.lit("k"), F.col(key))).otherwise(F.concat(F.lit("c"), content))
    return df.withColumn(MATCH, F.md5(named))


def append_new(df: DataFrame, path: str, key: str = "url") -> int:
    """Append only rows that the target doesn't hold yet (A4), by ``_match``.

    Re-running the same batch adds nothing; duplicates inside one batch are
    kept, as the original kept them.  The batch is computed once (it is
    spooled); what the target holds is looked up in its key table
    (``History``), so the target itself isn't read.  Each append is a partition
    ``_batch``, and what a broken append left behind goes with the next one.
    """
    batch = with_match(df, key)
    history = History(df.sparkSession, path, MATCH)
    number = history.begin_batch()
    if history.state["keys"]:
        batch = history.unknown(spooled(batch, "append"), number)
    rows = write_batch(batch, path, number)
    history.end_batch(number, rows)
    return rows


def write_batch(batch: DataFrame, path: str, number: int) -> int:
    """Write the rows of one batch as its partition; the row count."""
    return write_table(batch, f"{path.rstrip('/')}/{BATCH_COL}={number}")


def spooled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once,
    however often it is read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_seen(batch: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose ``key`` is not in ``history``; rows with a null
    key stay.

    History is first reduced to the keys the batch carries: a semi join
    whose small side is the batch's key set (AQE broadcasts it when it
    measures small), so the large history is scanned, not shuffled.
    """
    wanted = batch.select(F.col(key).alias("_k")).distinct()
    hits = (history.select(F.col(key).alias("_seen"))
            .join(wanted, F.col("_seen") == F.col("_k"), "left_semi").distinct())
    return batch.join(hits, F.col(key) == F.col("_seen"), "left_anti")


def drop_partition(spark: SparkSession, path: str, partition: str) -> None:
    """Remove one partition folder (``column=value``) of a table, if there."""
    delete(spark, f"{path.rstrip('/')}/{partition}")


def purge(spark: SparkSession, tables: dict[str, tuple[str, StructType]]) -> dict[str, int]:
    """Delete all rows of the named tables, returning how many were deleted
    (A7).  Explicit only; never part of a default run."""
    deleted = {}
    for name, (path, schema) in tables.items():
        n = spark.read.parquet(path).count() if path_exists(spark, path) else 0
        empty_frame(spark, schema).write.mode("overwrite").parquet(path)
        deleted[name] = n
    return deleted


def count_rows(df: DataFrame) -> int:
    """Document count."""
    return df.count()


def sample_rows(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a stated order (A9): top-k, no full sort."""
    order_by = order_by or df.columns[:1]
    return df.orderBy(*order_by).limit(n)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 1000,
               **properties) -> None:
    """Relational sink through Spark's JDBC writer (A5); needs a driver jar."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table)
     .option("batchsize", batchsize).options(**properties).mode(mode).save())
