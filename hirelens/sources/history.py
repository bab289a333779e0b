"""What a table already holds, looked up without reading it.

Beside the table, in its hidden folder ``_keys``, lies a table of its keys:

* keys are dealt by hash into *buckets*, a folder each; a batch adds a file to
  the buckets it touches;
* each batch also leaves a Bloom filter per bucket: pages of bits, of which a
  key sets ``HASHES`` in one page.

A new batch tests its keys against the filters (about two bytes per stored
key), and only buckets where a key may be found are read.  So a batch of new
postings reads no stored key but for the filters' errors (four bits set in
``BITS_PER_KEY`` bits of room: one key in 400), and one with d known postings at
most d buckets of about ``KEYS_PER_BUCKET`` keys, however long the history is (up
to ``MOST_BUCKETS`` buckets; beyond, buckets grow).

After ``MOST_BATCHES`` batches, or when buckets have grown too large, the keys are
written anew into a new generation with as many buckets as their number asks
for: few files per bucket, at the cost of rereading the keys once in so many
batches.

A batch is valid once the manifest says so.  What a broken attempt left under
its number is removed when the number is used again, from rows and keys alike.
One writer at a time (the manifest refuses the second).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import scratch_path
from hirelens.sources.files import delete, matching, path_exists
from hirelens.sources.manifest import Manifest

#: Number of the batch that a stored row came with: the table's partition column.
BATCH_COL = "_batch"
#: Keys of a bucket that ask for more buckets, and the most buckets there are.
KEYS_PER_BUCKET, MOST_BUCKETS = 16_384, 1 << 16
#: Bits of a filter per key, those that a key sets, and the bits of a page (as ``bitmap_construct_agg`` has them).
BITS_PER_KEY, HASHES, PAGE_BITS = 16, 4, 1 << 15
#: Batches whose files lie beside each other in a bucket.
MOST_BATCHES = 32


def _power_of_two(n: float, most: int) -> int:
    return 1 << max(0, min(most.bit_length() - 1, int(max(n, 1) - 1).bit_length() if n > 1 else 0))


class History:
    """The keys of the table at ``path``; ``key`` is the column that holds them."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.manifest = Manifest(spark, f"{self.path}/_keys")
        self.state = self.manifest.read()
        if not self.state:
            self._begin()

    # -- layout --

    def _begin(self) -> None:
        """An empty key table; of rows stored without one, the keys are read once."""
        self.state = {"generation": 0, "buckets": 1, "pages": 1, "batches": 0, "keys": 0, "last": -1}
        stored = [p.rsplit("/", 1)[1] for p in matching(self.spark, f"{self.path}/*")]
        stored = [name for name in stored if name.startswith(f"{BATCH_COL}=") or not name.startswith(("_", "."))]
        if not all(name.startswith(f"{BATCH_COL}=") for name in stored):
            raise ValueError(f"{self.path} isn't a table of {BATCH_COL} partitions")
        if stored:
            self.state["last"] = max(int(name.split("=")[1]) for name in stored)
            self._generation(self.spark.read.parquet(self.path).select(self.key, F.col(BATCH_COL).cast("long")))

    def _folder(self, kind: str) -> str:
        return f"{self.path}/_keys/g{self.state['generation']}/{kind}"

    def _bucket(self) -> Column:
        bits = self.state["buckets"].bit_length() - 1
        return F.shiftrightunsigned(F.xxhash64(self.key), 64 - bits) if bits else F.lit(0).cast("long")

    def _placed(self, keys: DataFrame) -> DataFrame:
        """Bucket, page of its filter, and the bits that the key sets there."""
        place = [F.pmod(F.xxhash64(F.col(self.key), F.lit(i)), F.lit(PAGE_BITS)).cast("int") for i in range(HASHES)]
        page = F.pmod(F.xxhash64(F.col(self.key), F.lit(HASHES)), F.lit(self.state["pages"])).cast("long")
        return keys.withColumns({"bucket": self._bucket(), "page": page, "set": F.array(*place)})

    def _add(self, keys: DataFrame) -> None:
        """Files of (key, _batch) in their buckets, and the batch's filters."""
        placed = self._placed(keys)
        (placed.select(self.key, "bucket", BATCH_COL).repartition("bucket")
         .write.mode("append").partitionBy("bucket", BATCH_COL).parquet(self._folder("keys")))
        (placed.select("bucket", "page", BATCH_COL, F.explode("set").alias("bit"))
         .groupBy("bucket", "page", BATCH_COL).agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
         .repartition(1 + self.state["buckets"] * self.state["pages"] // 4_096)
         .write.mode("append").partitionBy(BATCH_COL).parquet(self._folder("filters")))

    def _generation(self, keys: DataFrame) -> None:
        """Write (key, _batch) anew, with buckets for their number; then drop the old files."""
        count, old = keys.count(), self._folder("keys").rsplit("/", 1)[0]
        buckets = _power_of_two(count / KEYS_PER_BUCKET, MOST_BUCKETS)
        pages = _power_of_two(count / buckets * BITS_PER_KEY / PAGE_BITS, 1 << 20)
        self.state = {**self.state, "generation": self.state["generation"] + 1, "buckets": buckets, "pages": pages,
                      "batches": 1, "keys": count, "sized_for": count}
        delete(self.spark, self._folder("keys").rsplit("/", 1)[0])  # of a broken attempt
        self._add(keys)
        self.manifest.publish(self.state)
        delete(self.spark, old)

    def _keys(self, buckets: list[int] | None, before: int) -> DataFrame | None:
        """The valid keys of earlier batches in some buckets (all, if None)."""
        base = self._folder("keys")
        if buckets is None:
            paths = [base] if path_exists(self.spark, base) else []
        else:
            paths = [p for p in (f"{base}/bucket={b}" for b in buckets) if path_exists(self.spark, p)]
        if not paths:
            return None
        read = self.spark.read.schema(f"`{self.key}` string, bucket long, {BATCH_COL} long").option("basePath", base)
        return read.parquet(*paths).where(F.col(BATCH_COL) < before)

    # -- use --

    def begin_batch(self, number: int | None = None) -> int:
        """The number of the next batch (a stream brings its own).  Leftovers
        under it go, and the key table is renewed if it is due."""
        number = self.state["last"] + 1 if number is None else number
        for pattern in (f"{self.path}/{BATCH_COL}={number}", f"{self._folder('keys')}/bucket=*/{BATCH_COL}={number}",
                        f"{self._folder('filters')}/{BATCH_COL}={number}"):
            for found in matching(self.spark, pattern):
                delete(self.spark, found)
        crowded = self.state["keys"] > 4 * max(KEYS_PER_BUCKET, self.state.get("sized_for", 0)) and (
            self.state["buckets"] < MOST_BUCKETS)
        if self.state["batches"] >= MOST_BATCHES or crowded:
            keys = self._keys(None, number)
            if keys is not None:
                self._generation(keys.select(self.key, F.lit(-1).cast("long").alias(BATCH_COL)))
        return number

    def possible(self, batch: DataFrame, number: int) -> DataFrame | None:
        """(key, bucket): the batch's keys that a filter of an earlier batch has."""
        folder = self._folder("filters")
        if not path_exists(self.spark, folder):
            return None
        filters = self.spark.read.schema(f"bucket long, page long, bits binary, {BATCH_COL} long").parquet(folder).where(
            F.col(BATCH_COL) < number).drop(BATCH_COL)
        wanted = self._placed(batch.select(self.key).distinct())
        hit = F.expr("forall(set, b -> (cast(conv(hex(substring(bits, b div 8 + 1, 1)), 16, 10) as int) "
                     "& shiftleft(1, b % 8)) != 0)")
        return wanted.join(filters, ["bucket", "page"]).where(hit).select(self.key, "bucket").distinct()

    def unknown(self, batch: DataFrame, number: int) -> DataFrame:
        """Rows of ``batch`` whose key no earlier batch has stored."""
        possible = self.possible(batch, number)
        if possible is None:
            return batch
        path = scratch_path(self.spark, "possible-keys")
        possible.write.parquet(path)
        possible = self.spark.read.schema(possible.schema).parquet(path)
        # At most MOST_BUCKETS numbers.
        buckets = [r["bucket"] for r in possible.select("bucket").distinct().collect()]
        stored = self._keys(buckets, number) if buckets else None
        if stored is None:
            return batch
        found = stored.select(self.key).join(possible.select(self.key), self.key, "left_semi").distinct()
        return batch.join(found, self.key, "left_anti").select(*batch.columns)

    def end_batch(self, number: int, rows: int) -> None:
        """Note the stored keys of a batch and make it valid."""
        if rows:
            kept = self.spark.read.parquet(f"{self.path}/{BATCH_COL}={number}").select(self.key).distinct()
            self._add(kept.withColumn(BATCH_COL, F.lit(number).cast("long")))
        self.state = {**self.state, "last": number, "batches": self.state["batches"] + bool(rows),
                      "keys": self.state["keys"] + rows}
        self.manifest.publish(self.state)
