"""Exact top-k inner-product search as a Voronoi kNN join.

Inner products become distances: with every data vector x lengthened by
sqrt(M^2 - |x|^2), M the largest norm, and every query by 0, the nearest data
vector has the largest product.  In that space:

1. a bounded sample of rows are the pivots; every row belongs to the cell of
   its nearest pivot and keeps its distance to it;
2. a cell's summary is its size and the k + 1 least distances to its pivot, of
   different ids;
3. from the summaries each query gets a distance theta that surely holds its
   k nearest: the k-th least of |q, p| + |p, x| over the other ids in the
   summaries (rows with the query's own id don't count, however many);
4. queries are grouped, cells near each other together, in groups of bounded
   size; a row x of cell p has to be seen by a group only if, for some query
   of it, |q, p| - theta <= |p, x| <= |q, p| + theta (triangle inequality), so
   the join of rows and groups on the cell replicates only those;
5. each (group, block of rows) is solved by a matrix product in one task, and
   the blocks' k best are merged.

A group meets its rows in blocks of ``BLOCK_ROWS``, so a cell that holds a
third of the table is spread over many tasks.  Pivots grow with the root of the
number of rows, so that cells get narrower and fuller at the same rate.  The
driver sees the pivots and the cells' summaries only: at most ``MOST_PIVOTS``
vectors (``MOST_NUMBERS`` components) and k + 1 distances of each.  All this
decides the work, never the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from hirelens.llm.common import again, spooled
from hirelens.llm.vectors import matrix, usable

#: The least and most pivots, and the most components of all of them.
LEAST_PIVOTS, MOST_PIVOTS, MOST_NUMBERS = 64, 4_096, 1 << 20
#: Queries in a group, and rows that meet a group in one task.
GROUP_QUERIES, BLOCK_ROWS = 2_048, 16_384
#: Rows multiplied at once, and numbers held at once while distances are taken.
CHUNK_ROWS, CHUNK_NUMBERS = 4_096, 1 << 21
#: Rounding slack of the bounds, relative to M.
SLACK = 1e-6


def _packed(ints: np.ndarray) -> list[bytes]:
    """Whole-number vectors as bytes, in 16 bits where they fit."""
    short = (np.abs(ints) < 32768).all(axis=1)
    small = ints.astype(np.int16)
    return [small[i].tobytes() if short[i] else ints[i].tobytes() for i in range(len(ints))]


def _unpacked(column, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, b in enumerate(column.to_pylist()):
        out[i] = np.frombuffer(b, np.int16 if len(b) == 2 * width else np.float64)
    return out


def _products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond the reach of doubles by whole numbers, cut to a long's range."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(queries.shape[1], 1)
    if most < 2.0 ** 53:
        return (queries @ data.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    out = exact(queries) @ exact(data).T
    return np.clip(out, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best_of(scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int):
    """(query row, data row) of each query's k best, without its own id; ties to the smaller id."""
    own = query_ids[:, None] == ids[None, :]
    least = np.iinfo(np.int64).min
    ranked = np.where(own, least, scores)
    if ranked.shape[1] > k:
        bar = np.partition(ranked, ranked.shape[1] - k, axis=1)[:, ranked.shape[1] - k]
        q, x = np.nonzero((ranked >= bar[:, None]) & ~own)
    else:
        q, x = np.nonzero(~own)
    order = np.lexsort((ids[x], ~scores[q, x], q))  # ~s falls as s rises, without overflow
    q, x = q[order], x[order]
    new = np.ones(len(q), bool)
    new[1:] = q[1:] != q[:-1]
    place = np.arange(len(q)) - np.maximum.accumulate(np.where(new, np.arange(len(q)), 0))
    keep = place < k
    return q[keep], x[keep]


def pivot_groups(pivots: np.ndarray, queries: list[int], group_queries: int) -> list[list[int]]:
    """Cells in groups of about ``group_queries`` queries, near cells together:
    a walk from pivot to nearest unvisited pivot, cut when a group is full."""
    left, at, groups, held = np.ones(len(pivots), bool), 0, [[]], 0
    while left.any():
        left[at] = False
        if held and held + queries[at] > group_queries:
            groups.append([])
            held = 0
        groups[-1].append(at)
        held += queries[at]
        rest = np.flatnonzero(left)
        if len(rest):
            at = int(rest[((pivots[rest] - pivots[at]) ** 2).sum(axis=1).argmin()])
    return groups


def pivots_for(rows: int, width: int) -> int:
    """As many pivots as the root of the number of rows, within the bounds."""
    return max(1, min(max(LEAST_PIVOTS, int(np.ceil(np.sqrt(rows)))), MOST_PIVOTS, MOST_NUMBERS // max(width, 1)))


def top_k(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 256.0, n_pivots: int | None = None, group_queries: int = GROUP_QUERIES,
          block_rows: int = BLOCK_ROWS, observation: Observation | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` holds
    its ``k`` best other rows by the inner product of floor(scale * x).

    Vectors that are null or hold null or non-finite components, and rows
    with a null id, take no part.  Shorter vectors count as ending in zeros.
    Rows that share an id never find each other; as queries they count once
    (the least vector), as candidates each.  With fewer than k others, all
    are returned; without rows or queries, none.  Equal scores go by the smaller
    id; other columns, whatever their names, are not read.  ``n_pivots``:
    ``pivots_for`` the table, if not given.  ``observation`` gets ``copies``, the
    rows that groups were sent, once the result has been computed.
    """
    rows = df.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"))
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("double"))
    norm = F.aggregate(whole, F.lit(0.0), lambda a, x: a + x * x)
    seen = rows.agg(F.max(F.size("v")).alias("width"), F.max(norm).alias("norm"), F.count("*").alias("rows")).first()
    width, top = seen["width"] or 0, seen["norm"] or 0.0
    spark = df.sparkSession
    out = "query_id bigint, rank int, vec_id bigint, score bigint"
    if seen["width"] is None:
        return spark.createDataFrame([], out)
    slack = SLACK * (np.sqrt(top) + 1)

    def lengthened(x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))[:, None]])

    n_pivots = n_pivots or pivots_for(seen["rows"], width)
    sample = rows.orderBy(F.xxhash64("id"), "id", "v").limit(n_pivots).select("v").collect()
    at = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        at[i, :len(r["v"])] = np.floor(np.asarray(r["v"], np.float64) * scale)
    pivots = lengthened(np.unique(at, axis=0))

    def assign(batches):
        for batch in batches:
            step = max(1, min(CHUNK_ROWS, CHUNK_NUMBERS // len(pivots)))
            for s in range(0, batch.num_rows, step):
                part = batch.slice(s, step)
                x = np.floor(matrix(part.column("v"), width) * scale)
                far = distances(lengthened(x), pivots)
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("is_query"), pa.array(_packed(x), pa.binary()),
                     pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(cell)), cell])],
                    names=["id", "is_query", "x", "cell", "far"])

    cells = spooled(rows.mapInArrow(assign, "id bigint, is_query boolean, x binary, cell int, far double"), "cells")
    near = Window.partitionBy("cell").orderBy("far")
    least = (cells.groupBy("cell", "id").agg(F.min("far").alias("far"))
             .withColumn("n", F.row_number().over(near)).where(F.col("n") <= k + 1)
             .select("id", "cell", "far").orderBy("id").collect())
    sizes = {r["cell"]: r for r in cells.groupBy("cell").agg(F.count("*").alias("rows")).collect()}
    s_cell = np.asarray([r["cell"] for r in least])
    s_far = np.asarray([r["far"] for r in least])
    s_id, s_begin = np.unique(np.asarray([r["id"] for r in least], np.int64), return_index=True)
    salt = F.shiftrightunsigned(F.xxhash64("id"), 33).alias("salt")
    queries = cells.where("is_query").groupBy("id").agg(F.min(F.struct("x", "cell")).alias("one")).select(
        "id", "one.x", "one.cell", salt)
    asked = {r["cell"]: r["count"] for r in queries.groupBy("cell").count().collect()}
    counts = [asked.get(c, 0) for c in range(len(pivots))]
    groups = pivot_groups(pivots, counts, group_queries)
    group_of, salts_of = np.zeros(len(pivots), np.int64), np.zeros(len(pivots), np.int64)
    for g, members in enumerate(groups):
        group_of[members] = g << 20
        salts_of[members] = max(1, -(-sum(counts[c] for c in members) // group_queries))

    # A group's queries come together, so one range a group and cell leaves the task.
    plan = spark.createDataFrame([(c, int(group_of[c]), int(salts_of[c])) for c in range(len(pivots))],
                                 "cell int, first bigint, turns bigint")
    queries = queries.join(F.broadcast(plan), "cell").select(
        "id", "x", (F.col("first") + F.col("salt") % F.col("turns")).alias("group"))

    def thetas(batches):
        group, low, high = None, None, None
        step = max(1, min(512, CHUNK_NUMBERS // max(len(s_cell), len(pivots))))

        def found():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(low), group)), pa.array(np.arange(len(low), dtype=np.int32)), pa.array(low),
                 pa.array(high)], names=["group", "cell", "low", "high"])

        for batch in batches:
            for s in range(0, batch.num_rows, step):
                part = batch.slice(s, step)
                x = _unpacked(part.column("x"), width)
                far = distances(np.hstack([x, np.zeros((len(x), 1))]), pivots)
                reach = np.minimum.reduceat(far[:, s_cell] + s_far, s_begin, axis=1)  # of each id
                reach[part.column("id").to_numpy()[:, None] == s_id[None, :]] = np.inf
                reach.sort(axis=1)
                theta = reach[:, k - 1] if reach.shape[1] >= k else np.full(len(x), np.inf)
                theta = theta + slack
                of = part.column("group").to_numpy()
                for g in np.unique(of):
                    mine = of == g
                    near = (far[mine] - theta[mine][:, None]).min(axis=0)
                    wide = (far[mine] + theta[mine][:, None]).max(axis=0)
                    if g == group:
                        low, high = np.minimum(low, near), np.maximum(high, wide)
                        continue
                    if group is not None:
                        yield found()
                    group, low, high = g, near, wide
        if group is not None:
            yield found()

    ranges = (queries.repartition("group").sortWithinPartitions("group")
              .mapInArrow(thetas, "group bigint, cell int, low double, high double")
              .groupBy("group", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high")))
    table = spark.createDataFrame(
        [(c, int(r["rows"]), float(s_far[s_cell == c].min())) for c, r in sizes.items()],
        "cell int, held bigint, least double")
    ranges = ranges.join(table, "cell").where("high >= least")
    ranges = ranges.withColumn("blocks", F.ceil(F.sum("held").over(Window.partitionBy("group")) / block_rows))
    ranges = spooled(ranges.drop("held", "least"), "ranges")

    blocks = ranges.groupBy("group").agg(F.max("blocks").alias("blocks"))
    left = (queries.join(blocks, "group")
            .select("group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "x"))
    right = (again(cells).join(ranges, "cell").where("far >= low and far <= high")
             .select("group", F.pmod(F.xxhash64("id", "x"), F.col("blocks")).alias("block"), "id", "x"))
    if observation is not None:
        right = right.observe(observation, F.count(F.lit(1)).alias("copies"))

    def solve(q: pa.Table, x: pa.Table) -> pa.Table:
        found = []
        if q.num_rows and x.num_rows:
            q_ids, q_vec = q.column("id").to_numpy(), _unpacked(q.column("x"), width)
            for s in range(0, x.num_rows, CHUNK_ROWS):
                part = x.slice(s, CHUNK_ROWS)
                ids = part.column("id").to_numpy()
                scores = _products(q_vec, _unpacked(part.column("x"), width))
                i, j = best_of(scores, q_ids, ids, k)
                found.append((q_ids[i], ids[j], scores[i, j]))
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})

    local = left.groupBy("group", "block").cogroup(right.groupBy("group", "block")).applyInArrow(
        solve, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))
