"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted.  A text longer than the longest is
cut into whole longest pieces and a rest.  Pieces are taken longest first;
each goes into the open bin with the least room that still holds it (of
equal rooms the bin opened first); if none does, a bin is opened.  The opening
size is optimised over the permitted lengths jointly: the packing is computed
with each of them as the preferred opening size (a piece that needs more opens
the cheapest size that holds it), and the one with the least total cost stays,
of equal costs the smaller size.  That is one preferred size for a group, not
one chosen anew for each bin; on small cases the cost is the optimum's or close
to it (tested).  Finally every bin shrinks to the smallest permitted length
that holds its contents.

Only (row, id, length) is shuffled, never text: rows are dealt evenly,
whatever their ids, into groups of a fixed number of rows, and every group is
packed in one task.  A group's last bins are the only ones that may stay
poorly filled, so the loss is a few bins in ``group_rows`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Permitted sequence lengths, in words.
CAPACITIES = (256, 512, 1024, 2048)
#: Rows packed together; the bound of one task's memory.
GROUP_ROWS = 40_000
#: Cost of one sequence beside its length, in words.
OVERHEAD = 8.0


def word_count(text: Column) -> Column:
    """Runs of characters other than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def best_fit(sizes: np.ndarray, capacities: Sequence[int], opening: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of every piece, and the contents of every bin.  Pieces
    come longest first.  ``rooms`` has a bit for each room that some open
    bin has, so the best fit is the lowest set bit from the piece's size; the
    bins of one room lie in a heap, the smallest number on top."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    used: list[int] = []
    size_of: list[int] = []
    open_by_room: dict[int, list[int]] = {}
    rooms = 0
    for i, n in enumerate(sizes.tolist()):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            heap = open_by_room[room]
            b = heappop(heap)
            if not heap:
                rooms &= ~(1 << room)
        else:
            b, room = len(used), opening if n <= opening else min(c for c in capacities if c >= n)
            used.append(0)
            size_of.append(room)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        left = room - n
        if left:
            heappush(open_by_room.setdefault(left, []), b)
            rooms |= 1 << left
    return bins, offsets, used


def pack_group(sizes: np.ndarray, capacities: Sequence[int], overhead: float):
    """The cheapest of the packings, one for each opening size: bin, offset,
    final capacity and contents of every piece's bin."""
    caps = np.asarray(sorted(capacities))
    best = None
    for opening in caps.tolist():
        bins, offsets, used = best_fit(sizes, caps.tolist(), opening)
        final = caps[np.searchsorted(caps, used)] if used else np.zeros(0, np.int64)
        cost = float(final.sum()) + overhead * len(used)
        if best is None or cost < best[0]:
            best = cost, bins, offsets, final, np.asarray(used, np.int64)
    _, bins, offsets, final, used = best
    return bins, offsets, final[bins], used[bins]


def pack(df: DataFrame, id_col: str = "doc_id", length: Column | None = None,
         capacities: Sequence[int] = CAPACITIES, group_rows: int = GROUP_ROWS,
         overhead: float = OVERHEAD) -> DataFrame:
    """One row for each piece of each input row: id, piece (from 0), start and
    n_words (the piece's place in the text), bin_id, bin_offset, bin_capacity,
    bin_used, bin_group.

    ``length``: the rows' lengths; the words of ``text`` if not given.  A row
    without words (null, empty) gives one row with n_words 0 and no bin, as
    does one whose ``length`` is null or negative.  Ids may be null or repeated;
    an empty table gives no row; further columns, whatever their names, are not
    read.  Two bins never share a bin_id: it is the group
    number times 2^32 plus the bin's number in its group.
    """
    caps = sorted(set(int(c) for c in capacities))
    if not caps or caps[0] <= 0:
        raise ValueError("capacities must be positive")
    words = length if length is not None else word_count(df["text"])
    sized = df.select(df[id_col].alias(id_col), F.greatest(F.coalesce(words, F.lit(0)), F.lit(0)).cast("long").alias("_n"))
    kind = sized.schema[id_col].dataType.simpleString()
    groups = max(1, -(-df.count() // group_rows))

    def run(batches):
        from pyspark import TaskContext

        group = TaskContext.get().partitionId()
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got)
        n = rows.column("_n").to_numpy()
        pieces = np.maximum(1, -(-n // caps[-1]))
        row = np.repeat(np.arange(len(n)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * caps[-1]
        size = np.minimum(n[row] - start, caps[-1])
        order = np.argsort(-size, kind="stable")
        order = order[size[order] > 0]
        none = np.ones(len(row), bool)
        none[order] = False
        values = np.zeros((4, len(row)), np.int64)
        if len(order):
            values[:, order] = pack_group(size[order], caps, overhead)
            values[0, order] += group << 32
        bins = [pa.array(v, mask=none) for v in values]
        out = pa.Table.from_arrays(
            [rows.column(id_col).take(pa.array(row)), pa.array(piece), pa.array(start), pa.array(size), *bins,
             pa.array(np.full(len(row), group, np.int64))],
            names=[id_col, "piece", "start", "n_words", "bin_id", "bin_offset", "bin_capacity", "bin_used", "bin_group"])
        yield from out.to_batches(max_chunksize=20_000)

    return sized.repartition(groups).mapInArrow(
        run, f"`{id_col}` {kind}, piece bigint, start bigint, n_words bigint, bin_id bigint, bin_offset bigint, "
             "bin_capacity bigint, bin_used bigint, bin_group bigint")
