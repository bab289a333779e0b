"""Embedding near-duplicates over a robust-pruned flat graph.

1. Exact copies of a vector become one node, with their number.  Nodes have
   numbers of their own: an id may stand on several vectors.
2. Centres are fitted to a bounded sample; every vector goes to its
   ``OVERLAP`` nearest centres, so the shards overlap.  A shard above
   ``BLOCK`` vectors is dealt into blocks.
3. In each block a flat graph is built: every vector's nearest candidates are
   pruned robustly (a candidate goes if a chosen one is nearer to it, by a
   factor, than the vector is), and edges run both ways.
4. A vector's adjacency lists from all its blocks are united.
5. Every vector searches the blocks of its shards: a greedy beam search from
   the block's medoid (and from its own node, where it is one), then the
   search widens over everything found within the range until nothing new is
   in it.  Found pairs are verified by the cosine in double precision.
6. Pairs don't leave the task that finds them.  Each is counted in one place,
   the least shard that both vectors share; what is written are each vector's
   counts there and a spanning set of the pairs, at most one a vector.
7. Recall is audited on a sample of vectors against all others, which grows
   until enough of them have links; below ``LEAST_RECALL`` a linked vector the
   work is repeated with more overlap.  If that doesn't help either, or too
   few linked vectors are seen, all vectors are compared, block by block.  The
   log names the recall reached and that last resort.

Counts are summed and spanning pairs joined into components by shuffles.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import again, dropped, spooled
from hirelens.llm.components import components
from hirelens.llm.vectors import matrix, usable

LOG = logging.getLogger(__name__)

#: Cosine from which two vectors are linked.
RANGE = 0.95
#: Aimed size of a shard, most centres, and the sample they are fitted to.
SHARD, MOST_CENTRES, SAMPLE = 1_024, 2_048, 16_384
#: Shards of a vector; vectors of a block.
OVERLAP, BLOCK = 2, 4_096
#: Edges kept by pruning, candidates pruned from, and the pruning factor on distances.
DEGREE, CANDIDATES, ALPHA = 16, 40, 1.2
#: Beam of the greedy search, and neighbours of a node that it looks at (widening looks at all).
BEAM, FAN = 16, 32
#: Audited vectors at first and at most, linked ones among them that are enough, and the recall below which the
#: overlap grows.
AUDITED, MOST_AUDITED, ENOUGH, LEAST_RECALL = 256, 16_384, 32, 0.95
#: Links from which a vector belongs to a large group, which is audited apart.
MANY_LINKS = 128


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centres(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means on the sample's unit vectors."""
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)]
    for _ in range(rounds):
        near = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        norm = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(norm[:, None] > 1e-12, sums / np.maximum(norm, 1e-12)[:, None], centres)
    return centres


def pruned_graph(x: np.ndarray) -> list[np.ndarray]:
    """Adjacency lists of a block: robustly pruned nearest candidates, and
    the reverse edges."""
    m = len(x)
    c = min(CANDIDATES, m - 1)
    if c <= 0:
        return [np.zeros(0, np.int64) for _ in range(m)]
    heads, tails = [], []
    for at in range(0, m, 512):
        s = x[at:at + 512] @ x.T
        rows = np.arange(len(s))
        s[rows, at + rows] = -np.inf
        cand = np.argpartition(s, m - c, axis=1)[:, m - c:]
        near = np.take_along_axis(s, cand, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        cand, near = np.take_along_axis(cand, order, axis=1), np.take_along_axis(near, order, axis=1)
        v = x[cand]
        between = 1 - np.matmul(v, v.transpose(0, 2, 1))  # half the squared distances
        own = 1 - near
        alive = np.ones(cand.shape, bool)
        for _ in range(DEGREE):
            some = np.flatnonzero(alive.any(axis=1))
            if not len(some):
                break
            j = alive[some].argmax(axis=1)
            heads.append(at + some)
            tails.append(cand[some, j])
            alive[some, j] = False
            alive[some] &= ALPHA ** 2 * between[some, j] > own[some]
    head, tail = np.concatenate(heads), np.concatenate(tails)
    # Every edge also runs back, so that a vector which is nobody's nearest is still reached.
    pairs = np.unique(np.concatenate([head, tail]) * m + np.concatenate([tail, head]))
    return np.split(pairs % m, np.searchsorted(pairs // m, np.arange(1, m)))


def _padded(begin: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The first ``FAN`` neighbours of every node (the nearest), -1 behind the last."""
    size = np.diff(begin)
    at = begin[:-1, None] + np.arange(max(1, min(FAN, int(size.max(initial=0)))))
    ok = at < begin[1:, None]
    return np.where(ok, flat[np.minimum(at, max(len(flat) - 1, 0))] if len(flat) else -1, -1)


def by_nearness(x: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``at``, each row's neighbours, the nearest first; ``row`` is sorted."""
    near = np.empty(len(at), x.dtype)
    for s in range(0, len(at), 16_384):
        near[s:s + 16_384] = np.einsum("ij,ij->i", x[row[s:s + 16_384]], x[at[s:s + 16_384]])
    return at[np.lexsort((-near, row))]


def range_search(x: np.ndarray, begin: np.ndarray, flat: np.ndarray, medoid: int, queries: np.ndarray,
                 own: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) with a product of at least ``least``.  Node i's
    neighbours are ``flat[begin[i]:begin[i + 1]]``; ``own``: the query's node,
    -1 where it is none."""
    q, m, adjacent = len(queries), len(x), _padded(begin, flat)
    seen = np.zeros((q, m), bool)
    every = np.arange(q)
    beam = np.full((q, BEAM), -1, np.int64)
    sim = np.full((q, BEAM), -np.inf, x.dtype)
    done = np.ones((q, BEAM), bool)
    beam[:, 0], sim[:, 0], done[:, 0] = medoid, queries @ x[medoid], False
    seen[:, medoid] = True
    mine = np.flatnonzero((own >= 0) & (own != medoid))
    beam[mine, 1], sim[mine, 1], done[mine, 1] = own[mine], (queries[mine] * x[own[mine]]).sum(axis=1), False
    seen[mine, own[mine]] = True
    hit = (sim[:, :2] >= least) & (beam[:, :2] >= 0)
    i, j = np.nonzero(hit)
    found = [(i, beam[i, j])]
    while True:
        waiting = np.where(done, -np.inf, sim)
        best = waiting.argmax(axis=1)
        act = np.flatnonzero(waiting[every, best] > -np.inf)
        if not len(act):
            break
        done[act, best[act]] = True
        near = adjacent[beam[act, best[act]]]
        fresh = (near >= 0) & ~seen[act[:, None], near]
        i, j = np.nonzero(fresh)
        row, node = act[i], near[i, j]
        seen[row, node] = True
        s = np.full(near.shape, -np.inf, x.dtype)
        s[i, j] = np.einsum("ij,ij->i", x[node], queries[row])
        hits = s[i, j] >= least
        found.append((row[hits], node[hits]))
        all_sim = np.hstack([sim[act], s])
        keep = np.argpartition(-all_sim, BEAM - 1, axis=1)[:, :BEAM]
        sim[act] = np.take_along_axis(all_sim, keep, axis=1)
        beam[act] = np.take_along_axis(np.hstack([beam[act], near]), keep, axis=1)
        done[act] = np.take_along_axis(np.hstack([done[act], ~fresh]), keep, axis=1)
    row, node = (np.concatenate(c) for c in zip(*found))
    all_row, all_node = [row], [node]
    while len(row):  # widen over what is in range
        new_row, new_node = [], []
        for at in range(0, len(row), 1024):
            r, n = row[at:at + 1024], node[at:at + 1024]
            size = begin[n + 1] - begin[n]
            edge = np.arange(size.sum()) + np.repeat(begin[n] - (np.cumsum(size) - size), size)
            r, n = np.repeat(r, size), flat[edge]
            fresh = ~seen[r, n]
            key = np.unique(r[fresh] * m + n[fresh])
            r, n = key // m, key % m
            seen[r, n] = True
            hits = np.einsum("ij,ij->i", x[n], queries[r]) >= least
            new_row.append(r[hits])
            new_node.append(n[hits])
        row, node = np.concatenate(new_row), np.concatenate(new_node)
        all_row.append(row)
        all_node.append(node)
    return np.concatenate(all_row), np.concatenate(all_node)


#: What a task tells of the pairs it found: a vector's counts (``n``, and ``w`` with copies), or a spanning pair.
FOUND = "a bigint, b bigint, n bigint, w bigint"


def told(hits: np.ndarray, left: np.ndarray, right: np.ndarray, left_copies: np.ndarray, right_copies: np.ndarray,
         same: bool) -> pa.Table:
    """The pairs ``hits[i, j]`` of left[i] and right[j] as counts and spanning
    pairs.  ``same``: both sides are the same vectors, and hits symmetric."""
    ids, n, w = [left], [hits.sum(axis=1)], [hits @ right_copies]
    if not same:
        ids.append(right)
        n.append(hits.sum(axis=0))
        w.append(left_copies @ hits)
    # Every vector's row is looked at once; what it reaches anew it spans.
    a, b = [], []
    new_left, new_right = np.ones(len(left), bool), np.ones(len(right), bool)
    if same:
        new_right = new_left
    for root in range(len(left)):
        if not new_left[root] or not hits[root].any():
            continue
        new_left[root] = False
        waiting = [(True, root)]
        while waiting:
            on_left, at = waiting.pop()
            fresh = np.flatnonzero(hits[at] & new_right if on_left else hits[:, at] & new_left)
            (new_right if on_left else new_left)[fresh] = False
            a.append(np.full(len(fresh), left[at] if on_left else right[at]))
            b.append(right[fresh] if on_left else left[fresh])
            waiting += [(same or not on_left, x) for x in fresh.tolist()]
    ids, n, w = (np.concatenate(x) for x in (ids, n, w))
    some = n > 0
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    none, nothing = pa.nulls(int(some.sum()), pa.int64()), pa.nulls(len(a), pa.int64())
    return pa.concat_tables([
        pa.table({"a": ids[some], "b": none, "n": n[some].astype(np.int64), "w": w[some].astype(np.int64)}),
        pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "n": nothing, "w": nothing})])


def owned(hits: np.ndarray, left: np.ndarray, right: np.ndarray, shard: int) -> None:
    """Take away pairs that a lesser shard than this one shares, too; ``left``
    and ``right`` are the shards of the vectors."""
    for at in range(0, len(hits), 64):
        i, j = np.nonzero(hits[at:at + 64])
        i = i + at
        lesser = ((left[i][:, :, None] == right[j][:, None, :]) & (left[i][:, :, None] < shard)).any(axis=(1, 2))
        hits[i[lesser], j[lesser]] = False


def counts_of(links: DataFrame, reps: DataFrame) -> DataFrame:
    """(id, n, w) from what the tasks told, or from plain pairs (a, b)."""
    if "n" in links.columns:
        return (links.where("n is not null").groupBy(F.col("a").alias("id"))
                .agg(F.sum("n").alias("n"), F.sum("w").alias("w")))
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = reps.select(F.col("id").alias("b"), (F.col("copies") if "copies" in reps.columns else F.lit(1)).alias("c"))
    return ends.join(copies, "b").groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n"), F.sum("c").alias("w"))


def _links(reps: DataFrame, width: int, overlap: int, threshold: float, shard: int, block: int) -> DataFrame:
    """Counts and spanning pairs (a < b) of linked vectors, found through the graph."""
    n = reps.count()
    k = int(min(MOST_CENTRES, max(1, -(-n // shard))))
    sample = reps.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    at = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        at[i, :len(r["v"])] = r["v"]
    centres = fit_centres(unit(at), min(k, len(at)))
    wide = min(overlap, len(centres))

    def place(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                part = batch.slice(s, 2048)
                near = unit(matrix(part.column("v"), width)) @ centres.T
                best = np.argpartition(-near, wide - 1, axis=1)[:, :wide].astype(np.int32)
                row = np.repeat(np.arange(len(near)), wide)
                of = pa.FixedSizeListArray.from_arrays(pa.array(np.repeat(best, wide, axis=0).ravel()), wide)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best.ravel()), of.cast(pa.list_(pa.int32())),
                     *(part.column(c).take(pa.array(row)) for c in ("id", "copies", "v"))],
                    names=["shard", "of", "id", "copies", "v"])

    kind = reps.schema["v"].dataType.simpleString()
    placed = spooled(reps.select("id", "copies", "v").mapInArrow(
        place, f"shard int, of array<int>, id bigint, copies bigint, v {kind}"), "shards")
    # One row per centre: at most MOST_CENTRES.
    blocks = placed.groupBy("shard").count().select("shard", F.ceil(F.col("count") / block).alias("blocks"))
    blocks = spooled(blocks, "blocks")

    def members_of(rows: DataFrame) -> DataFrame:
        return rows.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")))

    members = members_of(placed)

    def build(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        lists = pruned_graph(unit(matrix(table.column("v").combine_chunks(), width)))
        return pa.table({"id": pa.array(ids), "near": pa.array([ids[a] for a in lists], pa.list_(pa.int64()))})

    lists = members.select("shard", "block", "id", "v").groupBy("shard", "block").applyInArrow(
        build, "id bigint, near array<bigint>")
    # At most OVERLAP blocks of a vector, each with a list of at most BLOCK.
    union = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    nodes = (members_of(again(placed)).join(union, "id").withColumn("other", F.explode(every))
             .select("shard", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "of", "id", "copies", "v", "near"))

    def search(table: pa.Table) -> pa.Table:
        shard, i, j = (table.column(c)[0].as_py() for c in ("shard", "i", "j"))
        block = table.column("block").to_numpy()
        sides = [_Side(table.filter(pa.array(block == b)), width) for b in ((i,) if i == j else (i, j))]
        left, right = sides[0], sides[-1]
        hits = np.zeros((len(left.ids), len(right.ids)), bool)
        if len(left.ids) and len(right.ids):
            for rows, columns in right.found_by(left, threshold):
                hits[rows, columns] = True
            if i == j:
                hits |= hits.T
                np.fill_diagonal(hits, False)
            else:
                for rows, columns in left.found_by(right, threshold):
                    hits[columns, rows] = True
            owned(hits, left.shards, right.shards, shard)
        return told(hits, left.ids, right.ids, left.copies, right.copies, i == j)

    links = spooled(nodes.groupBy("shard", "i", "j").applyInArrow(search, FOUND), "links")
    dropped(placed)
    dropped(blocks)
    return links


class _Side:
    """The vectors of one block with their graph."""

    def __init__(self, table: pa.Table, width: int):
        order = np.argsort(table.column("id").to_numpy())
        table = table.take(pa.array(order)).combine_chunks()
        self.ids, self.copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        self.x = unit(matrix(table.column("v").combine_chunks(), width)) if len(order) else np.zeros((0, width))
        of = table.column("of").combine_chunks()
        self.shards = of.flatten().to_numpy().reshape(len(order), -1) if len(order) else np.zeros((0, 1), np.int32)
        self.near = table.column("near").combine_chunks()

    def found_by(self, queries: _Side, threshold: float):
        """(query, node) places with a cosine of at least ``threshold``, some queries at a time."""
        size = np.asarray(self.near.value_lengths()).astype(np.int64)
        flat = self.near.flatten().to_numpy()
        at = np.minimum(np.searchsorted(self.ids, flat), len(self.ids) - 1)
        here = self.ids[at] == flat  # united lists also lead to other blocks
        row = np.repeat(np.arange(len(self.ids)), size)[here]
        begin = np.searchsorted(row, np.arange(len(self.ids) + 1))
        medoid = int((self.x @ self.x.mean(axis=0)).argmax())
        place = np.minimum(np.searchsorted(self.ids, queries.ids), len(self.ids) - 1)
        own = np.where(self.ids[place] == queries.ids, place, -1)
        x4, q4 = self.x.astype(np.float32), queries.x.astype(np.float32)
        flat = by_nearness(x4, row, at[here])
        for s in range(0, len(q4), 512):
            i, j = range_search(x4, begin, flat, medoid, q4[s:s + 512], own[s:s + 512], threshold - 1e-4)
            i = i + s
            for c in range(0, len(i), 65_536):
                p, q = i[c:c + 65_536], j[c:c + 65_536]
                sure = (queries.x[p] * self.x[q]).sum(axis=1) >= threshold
                yield p[sure], q[sure]


def audited_recall(reps: DataFrame, links: DataFrame, width: int, threshold: float) -> float | None:
    """Mean share of a vector's true links that the graph found, over audited
    vectors with links; the lesser of that in large groups and outside them.
    None if too few of ``MOST_AUDITED`` vectors have links to tell."""
    n, most = reps.count(), AUDITED
    while True:
        there, got = _audit(reps, links, width, threshold, most)
        large = there >= MANY_LINKS
        small = (there > 0) & ~large
        share = got / np.maximum(there, 1)
        if most >= n or small.sum() >= ENOUGH:
            return min((float(share[some].mean()) for some in (small, large) if some.any()), default=1.0)
        if most >= MOST_AUDITED:
            return None
        most = min(4 * most, MOST_AUDITED)


def _audit(reps: DataFrame, links: DataFrame, width: int, threshold: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """True and found links of ``most`` vectors, compared with every vector."""
    some = reps.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(most).select("id", "v").collect()
    ids = np.asarray([r["id"] for r in some], np.int64)
    at = np.zeros((len(some), width))
    for i, r in enumerate(some):
        at[i, :len(r["v"])] = r["v"]
    shared = reps.sparkSession.sparkContext.broadcast((ids, unit(at)))

    def compare(batches):
        ids, at = shared.value
        n = np.zeros(len(ids), np.int64)
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                near = unit(matrix(part.column("v"), width)) @ at.T >= threshold
                near &= part.column("id").to_numpy()[:, None] != ids[None, :]
                n += near.sum(axis=0)
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(n[hit])], names=["id", "n"])

    order = np.argsort(ids)
    sums = reps.select("id", "v").mapInArrow(compare, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    linked = spooled(sums, "audited")
    found = counts_of(links, reps).join(F.broadcast(again(linked).select("id")), "id").select("id", "n")
    out = []
    for rows in (linked, found):  # at most one row for an audited vector
        count = np.zeros(len(ids), np.int64)
        got = rows.collect()
        count[order[np.searchsorted(ids[order], [r["id"] for r in got])]] = [r["n"] for r in got]
        out.append(count)
    dropped(linked)
    return out[0], out[1]


def exact_links(reps: DataFrame, width: int, threshold: float, block: int) -> DataFrame:
    """Counts and spanning pairs (a < b), every block compared with every block."""
    blocks = max(1, -(-reps.count() // block))
    own = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    rows = (reps.select("id", "copies", "v", own.alias("own")).select("*", other.alias("other"))
            .select("id", "copies", "v", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))

    def compare(table: pa.Table) -> pa.Table:
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        ids, own, copies = (table.column(c).to_numpy() for c in ("id", "own", "copies"))
        x = unit(matrix(table.column("v").combine_chunks(), width))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        hits = np.zeros((len(left), len(right)), bool)
        for s in range(0, len(left), 512):
            hits[s:s + 512] = x[left[s:s + 512]] @ x[right].T >= threshold
        if i == j:
            hits |= hits.T
            np.fill_diagonal(hits, False)
        return told(hits, ids[left], ids[right], copies[left], copies[right], i == j)

    return spooled(rows.groupBy("i", "j").applyInArrow(compare, FOUND), "links")


def near_duplicates(df: DataFrame, threshold: float = RANGE, id_col: str = "vec_id", vec_col: str = "embedding",
                    shard: int = SHARD, block: int = BLOCK, overlap: int = OVERLAP) -> DataFrame:
    """(id, n_links, component_id, kept) per input row.

    Vectors that are null, zero or hold null or non-finite components, and
    rows with a null id, link with nothing: their component is their own id
    and they are kept.  Shorter vectors count as ending in zeros.  Copies of
    a vector link with each other; rows that share an id and a vector count
    as copies, rows with an id and different vectors are different vectors
    (each with its own links; equal ids link nothing).  An empty table gives no
    rows; other columns, whatever their names, are not read.
    """
    v = F.col(vec_col)
    nonzero = F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"),
                     (usable(v) & F.col(id_col).isNotNull() & F.coalesce(nonzero, F.lit(False))).alias("ok"),
                     F.xxhash64(v).alias("k1"), F.xxhash64(F.lit(1), v).alias("k2"))
    width = rows.where("ok").agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    # From here on ``id`` is the number of a node, ``least`` the smallest id of its rows.
    reps = spooled(rows.where("ok").groupBy("k1", "k2").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v"))
        .withColumn("id", F.monotonically_increasing_id()), "vectors")
    for wide in (overlap, 2 * overlap, 4 * overlap):
        links = _links(reps, width, wide, threshold, shard, block)
        recall = audited_recall(reps, links, width, threshold)
        LOG.info("overlap %d: audited recall %s", wide, recall)
        if recall is not None and recall >= LEAST_RECALL:
            break
        dropped(links)
        if recall is None or wide == 4 * overlap:  # not to be told, or not to be had by more overlap
            LOG.warning("audited recall %s: all vectors are compared, block by block", recall)
            links = exact_links(reps, width, threshold, block)
            break
    others = counts_of(links, reps).select(F.col("id").alias("l_id"), F.col("w").alias("others"))
    group = components(links.where("b is not null").select("a", "b")).select(
        F.col("id").alias("c_id"), F.col("component").alias("root"))
    of = (reps.select("k1", "k2", "id", "least", "copies").join(others, F.col("id") == F.col("l_id"), "left")
          .join(group, F.col("id") == F.col("c_id"), "left").withColumn("root", F.coalesce("root", "id")))
    of = spooled(of.select("k1", "k2", "least", "copies", "others", "root"), "counted")
    # A component is named by the smallest id of its rows.
    names = again(of).groupBy(F.col("root").alias("r_id")).agg(F.min("least").alias("component"))
    of = of.join(names, F.col("root") == F.col("r_id")).select(
        "k1", "k2", "component", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
        F.lit(True).alias("ok"))
    dropped(links)
    dropped(reps)
    return (rows.drop("v").join(of, ["k1", "k2", "ok"], "left")
            .select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"),
                    F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept")))
