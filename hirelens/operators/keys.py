"""Dense surrogate keys without a single-partition window.

``row_number() OVER (ORDER BY k)`` moves every row into one task.  Instead:

1. range-partition on the order columns and sort within partitions, so
   partition i holds a contiguous run of the order;
2. count rows per partition (one row per partition);
3. a running sum over those counts gives each partition's offset; the
   offsets table has one row per partition, so broadcasting it is bounded
   by the partition count, not by the data;
4. key = start + offset + position within the partition.

The result equals ``start + row_number() OVER (ORDER BY order_cols)`` when
the order is total.  The sorted, position-tagged frame is read twice (for
the counts and for the keys), and its input may come from a shuffle whose
row order is not reproducible, so it is written once with ``checkpoint()``
to the shared checkpoint folder: both reads see the same rows, and a lost
executor cannot change a key afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols):
    return [c if isinstance(c, Column) else F.col(c).asc_nulls_first() for c in cols]


def _numbered_copies(df: DataFrame, chunk: int) -> DataFrame:
    """Give every exact copy of a row its own occurrence index ``_i``.

    Copies are counted first (combined map-side).  A row with at most
    ``chunk`` copies is expanded where it is; a larger copy group is cut into
    chunks that are spread over tasks before they are expanded, so no task
    generates more than ``chunk`` copies of one row.  With distinct keys the
    range partitioning that follows can split a copy group that holds a third
    of all rows over many partitions.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    small = (counted.where(F.col("_n") <= chunk)
             .withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))))
    big = (counted.where(F.col("_n") > chunk)
           .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_n") / chunk) - 1)))
           .repartition("_c", *cols)
           .withColumn("_i", F.explode(F.sequence(F.col("_c") * chunk,
                                                 F.least(F.col("_n"), (F.col("_c") + 1) * chunk) - 1))))
    return small.select(*cols, "_i").unionByName(big.select(*cols, "_i"))


def assign_keys(df: DataFrame, order_cols: list, key_col: str, start: Column | int = 0,
                num_partitions: int | None = None, copies_chunk: int | None = None) -> DataFrame:
    """Add ``key_col`` = start + 1, 2, 3, ... in ``order_cols`` order.

    ``copies_chunk`` is for inputs that may hold many exact copies of one
    row: copies get distinct occurrence indexes first (see
    ``_numbered_copies``), so a copy group is split over partitions.  The
    keys are the same as without it (copies are interchangeable).
    """
    order = _order(order_cols)

    def by_range(frame: DataFrame, cols: list) -> DataFrame:
        # Without a fixed count AQE may merge small neighbouring ranges;
        # merged partitions are still contiguous, so the order holds.
        if num_partitions:
            return frame.repartitionByRange(num_partitions, *cols)
        return frame.repartitionByRange(*cols)

    if copies_chunk:
        # Tie-break on every column and then the copy index: a total order.
        named = {c for c in order_cols if isinstance(c, str)}
        full = order + [F.col(c).asc_nulls_first() for c in df.columns if c not in named] + [F.col("_i")]
        ranged = by_range(_numbered_copies(df, copies_chunk), full).sortWithinPartitions(*full).drop("_i")
    else:
        ranged = by_range(df, order).sortWithinPartitions(*order)
    # Positions are materialised once: both uses below read the same rows.
    return _keyed(_tagged(ranged).checkpoint(eager=True), key_col, start)


def number_in_order(df: DataFrame, key_col: str, start: Column | int = 0) -> DataFrame:
    """Dense keys for a frame that is already in its final global order.

    ``df`` must come from ``assign_keys`` output (or its checkpoint) through
    narrow steps only (filter, project, explode): partitions are then still
    a contiguous, sorted run each and are read back identically, so the
    keys follow the order without another range shuffle or checkpoint.
    """
    return _keyed(_tagged(df), key_col, start)


def _tagged(df: DataFrame) -> DataFrame:
    """Partition index and position inside it, from one 64-bit id."""
    return (df.withColumn("_mid", F.monotonically_increasing_id())
            .withColumn("_pid", F.shiftright("_mid", 33)))


def _keyed(tagged: DataFrame, key_col: str, start: Column | int) -> DataFrame:
    """key = start + rows in earlier partitions + position + 1."""
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per partition: this window and the broadcast below are bounded
    # by the partition count, not by the data.
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(key_col, (start_col + F.col("_off") + local + 1).cast("long"))
            .drop("_mid", "_pid", "_off"))


def next_key_start(existing: DataFrame | None, key_col: str) -> Column:
    """max(existing key), or 0 for an empty / missing table.  One number, read
    now: the caller may go on to write into the same table."""
    if existing is None:
        return F.lit(0).cast("long")
    return F.lit(existing.agg(F.max(key_col)).first()[0] or 0).cast("long")
