"""What stored rows may hold one of a few new keys: ranges and a Bloom filter.

``KeyFilter`` knows the least and largest value of each column of the new rows.
``candidates`` reads stored keys within that range (a predicate
that Parquet row groups are skipped by) and keeps those that a Bloom filter of
the new keys lets pass, so that a join with the new keys shuffles the new keys
and little else of the stored ones.

The filter is a table of bitmap pages made and tested by Spark's own
functions.  It is broadcast: at most ``MOST_PAGES`` pages of 4 KB, whatever the
number of keys.  Beyond about a million keys it lets more stored ones pass; the
join stays right.  For more than ``MOST_KEYS``, where it would pass a seventh of
the others, none is made: the join alone is cheaper.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, those that a key sets, the bits of a page (as ``bitmap_construct_agg`` has them) and the most pages.
BITS_PER_KEY, HASHES, PAGE_BITS, MOST_PAGES = 16, 4, 1 << 15, 512
#: New rows for which a filter is made.
MOST_KEYS = 4 * MOST_PAGES * PAGE_BITS // BITS_PER_KEY


def ends(columns: list[str]) -> list[Column]:
    """Aggregates: least and largest value of each column."""
    return [f(c) for c in columns for f in (F.min, F.max)]


def paired(columns: list[str], values: tuple) -> dict[str, tuple]:
    """The values of ``ends`` by column."""
    return {c: (values[2 * i], values[2 * i + 1]) for i, c in enumerate(columns)}


class KeyFilter:
    """The keys of ``new`` in some columns, for looking them up among stored rows.

    Null values are no keys.  Columns of whole numbers of any width and texts
    may be compared with each other's kind (hashed as text).
    """

    def __init__(self, new: DataFrame, rows: int, ranges: dict[str, tuple]):
        self.new, self.ranges = new, ranges
        self.filters = rows <= MOST_KEYS
        wanted = rows * BITS_PER_KEY // PAGE_BITS + 1
        self.pages = min(MOST_PAGES, 1 << (wanted - 1).bit_length())

    @staticmethod
    def of(new: DataFrame, columns: list[str]) -> KeyFilter:
        """With the number of rows and the columns' ranges taken in one pass."""
        row = new.agg(F.count(F.lit(1)), *ends(columns)).first()
        return KeyFilter(new, row[0], paired(columns, row[1:]))

    def empty(self, column: str) -> bool:
        """No new row has a value there."""
        return self.ranges[column][0] is None

    def meets(self, stored: DataFrame, column: str) -> bool:
        """A stored row lies within the range of the new ones.  Keys that rise
        from run to run meet none: then there is nothing to filter or to join."""
        low, high = self.ranges[column]
        return low is not None and not stored.select(column).where(F.col(column).between(F.lit(low), F.lit(high))).isEmpty()

    def _placed(self, keys: DataFrame, key: list[str]) -> DataFrame:
        text = [F.col(k).cast("string") for k in key]
        bits = [F.pmod(F.xxhash64(*text, F.lit(i)), F.lit(PAGE_BITS)).cast("int") for i in range(HASHES)]
        page = F.pmod(F.xxhash64(*text, F.lit(HASHES)), F.lit(self.pages))
        return keys.withColumns({"_page": page, "_set": F.array(*bits)})

    def candidates(self, stored: DataFrame, key: list[str], keys: DataFrame | None = None) -> DataFrame:
        """(key): stored keys that may be new ones too, among them all that are.
        The range is that of the key's first column.  ``keys`` are the new rows'
        keys, if they are at hand without the doubles."""
        low, high = self.ranges[key[0]]
        if low is None:
            return stored.select(*key).where(F.lit(False))
        whole: Column = reduce(Column.__and__, [F.col(k).isNotNull() for k in key])
        read = stored.select(*key).where(F.col(key[0]).between(F.lit(low), F.lit(high)))
        if not self.filters:
            return read.where(whole)
        pages = (self._placed((self.new if keys is None else keys).where(whole).select(*key), key).select("_page", F.explode("_set").alias("_bit"))
                 .groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits")))
        hit = F.expr("forall(_set, b -> (cast(conv(hex(substring(_bits, b div 8 + 1, 1)), 16, 10) as int) "
                     "& shiftleft(1, b % 8)) != 0)")
        return self._placed(read, key).join(F.broadcast(pages), "_page").where(hit).select(*key)
