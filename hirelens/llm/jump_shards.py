"""Jump consistent hashing of stable keys to shards (native: DataFrame functions only).

A key walks through a sequence of shard numbers drawn from a generator that
it seeds; the last number below the shard count is its shard.  No ring and no
table is kept, and since more shards only lengthen the walk, appending a shard
moves just the keys whose next number is the new one, 1 in n + 1.

The generator's 64-bit product is taken in three limbs of 22, 22 and 20 bits,
so that no intermediate value passes 64 bits and the result is the same on
every engine.  A walk makes about ln(n) steps; ``MOST_STEPS`` are computed,
which only a failing generator could exceed (the query then stops, no row is
put into a wrong shard).

Defined results: a null id is the key 0, as is the id 0; ids other than
integers are hashed first.  A null text has no bytes (size 1, checksum 0).
Rows with equal ids share a shard, whatever their texts, even if they are a
third of all rows: that is the law.  An empty table gives no rows; further
columns are not read, whatever their names.

``slots`` numbers the rows of each shard from 0 without a gap.  Only (id,
size, checksum) move.  Equal rows are counted before the shuffle and large
groups of them are numbered in chunks, the rest is numbered along a range
partitioning: no shard, id or group of copies passes through one task.  Rows
equal in id, size and checksum are interchangeable, so their slots are, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from hirelens.llm.common import spooled
from hirelens.operators.keys import assign_keys

#: Multiplier of the generator x -> a x + 1 (mod 2^64): a fixed value of the published algorithm.
MULTIPLIER = 2862933555777941757
#: Steps of a walk that are computed; a walk over n shards makes at most n + 1.
MOST_STEPS = 128
#: Copies of one row that are numbered in one place.
COPIES_CHUNK = 10_000

LIMB, TOP = (1 << 22) - 1, (1 << 20) - 1
A0, A1, A2 = MULTIPLIER & LIMB, MULTIPLIER >> 22 & LIMB, MULTIPLIER >> 44


def stable_key(df: DataFrame, id_col: str) -> Column:
    """The 64-bit key of an id: an integer itself, a hash of anything else; 0 for null."""
    integral = isinstance(df.schema[id_col].dataType, IntegralType)
    return F.coalesce(df[id_col].cast("long") if integral else F.xxhash64(df[id_col]), F.lit(0).cast("long"))


def _advanced(walk: Column, shards: int) -> Column:
    """A walk one number further.  ``at`` is its last number up to ``shards``,
    ``shard`` the last one below, ``next`` the number it would go to."""
    low = walk["k0"] * A0 + 1
    mid = walk["k0"] * A1 + walk["k1"] * A0 + F.shiftright(low, 22)
    high = walk["k0"] * A2 + walk["k1"] * A1 + walk["k2"] * A0 + F.shiftright(mid, 22)
    k1, k2 = mid.bitwiseAND(LIMB), high.bitwiseAND(TOP)
    upper = F.shiftleft(k2, 11) + F.shiftright(k1, 11)  # bits 33 to 63 of the state
    following = ((walk["next"] + 1) * (F.lit(2.0 ** 31) / (upper + 1).cast("double"))).cast("long")
    return F.struct(low.bitwiseAND(LIMB).alias("k0"), k1.alias("k1"), k2.alias("k2"), walk["next"].alias("at"),
                    F.when(walk["next"] < shards, walk["next"]).otherwise(walk["shard"]).alias("shard"),
                    following.alias("next"))


def shard_columns(key: Column, shards: int) -> tuple[Column, Column]:
    """The shard of a 64-bit key among ``shards``, and among one more."""
    if shards < 1:
        raise ValueError("at least one shard")
    zero = F.lit(0).cast("long")
    start = F.struct(key.bitwiseAND(LIMB).alias("k0"), F.shiftright(key, 22).bitwiseAND(LIMB).alias("k1"),
                     F.shiftrightunsigned(key, 44).bitwiseAND(TOP).alias("k2"), zero.alias("at"), zero.alias("shard"),
                     zero.alias("next"))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards + 1, MOST_STEPS))), start,
                       lambda w, _: F.when(w["next"] > shards, w).otherwise(_advanced(w, shards)))
    if shards + 1 > MOST_STEPS:
        walk = F.when(walk["next"] > shards, walk).otherwise(F.raise_error(F.lit("walk longer than MOST_STEPS")))
    return walk["shard"].cast("int"), walk["at"].cast("int")


def sharded(df: DataFrame, shards: int, id_col: str = "doc_id", shard_col: str = "shard",
            grown_col: str | None = None) -> DataFrame:
    """``df`` with each row's shard (and, if named, its shard among one more).
    A narrow step; a column of that name is replaced."""
    shard, grown = shard_columns(stable_key(df, id_col), shards)
    out = df.withColumns({shard_col: shard, **({grown_col: grown} if grown_col else {})})
    return out


def write_shards(df: DataFrame, path: str, shards: int, id_col: str = "doc_id", rows_per_file: int = 1_000_000) -> None:
    """Whole rows written to one folder per shard (``shard=0`` ...).  Tasks
    write where they read, so a hot id doesn't move, and files stay bounded."""
    (sharded(df, shards, id_col).write.partitionBy("shard").option("maxRecordsPerFile", rows_per_file).parquet(path))


def slots(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: the id, size (UTF-8 bytes + 1), text_crc32, law, shard,
    slot (from 0 in its shard) and grown_shard (its shard among one more)."""
    shard, grown = shard_columns(stable_key(df, id_col), shards)
    text = F.coalesce(df[text_col], F.lit(""))
    light = spooled(df.select(df[id_col].alias(id_col), (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(text.cast("binary")).alias("text_crc32"), shard.alias("shard"),
                              grown.alias("grown_shard")), "sizes")
    numbered = assign_keys(light, ["shard", id_col, "size", "text_crc32"], "_place", copies_chunk=COPIES_CHUNK)
    first = numbered.groupBy(F.col("shard").alias("_shard")).agg(F.min("_place").alias("_first"))  # a row per shard
    return numbered.join(F.broadcast(first), F.col("shard") == F.col("_shard")).select(
        id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_place") - F.col("_first")).alias("slot"), "grown_shard")
