"""N-gram Jaccard join with set-relation skipping.

A document's set is its distinct word shingles, as 64-bit hashes; documents
with equal sets are one node.  Two nodes link when their sets' Jaccard
similarity reaches the threshold.  Exact up to hash collisions.

Index.  Shingles have one global order: by a fixed-size count sketch of the
whole corpus (frequent ones last), then by hash.  A node's prefix in this
order, just long enough that similar sets must share a shingle of it, goes
into inverted lists, sorted by set size and position and cut into blocks.
Blocks whose sizes can't match are never paired, and within a pair of blocks
entries are skipped whose sizes or positions leave too little overlap.

Answers.  A list of near copies would give pairs by the square of its length.
Instead a few leaders of every list are compared with its entries first: those
where the shared shingle stands earliest, so with fewest rare shingles of
their own, which makes them the centres of a group of near copies.  The nodes
that link with the same leader are then connected already, and connected pairs
are skipped.  After two such rounds, with different leaders, what is left is compared pair by pair, except where a
node's answer follows from its most similar leader's: of the overlap of a and
b at most |L n b| lies in L and at most |a| - |L n a| outside.  So no link that
joins two components is lost, and only components are claimed: a pair inside
one isn't enumerated.

Sets of nodes in candidate pairs are made again from the text; a fixed-size
bit map of their ids keeps the others from being shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hirelens.llm import crf
from hirelens.llm.common import again, dropped, spooled, text_slices
from hirelens.llm.components import components

#: Words of a shingle and least similarity in per cent.
SHINGLE, PERCENT = 5, 80
#: log2 of the count sketch's buckets, and of the bit maps' bits.
SKETCH_BITS, MAP_BITS = 20, 24
#: Entries of a block of an inverted list, and leaders of a list in a round.
BLOCK, LEADERS = 4_096, 4
#: Sketch parts, and rows merged in one task.
_PARTS, _FAN_IN = 64, 64

#: Bytes that belong to words: all but the space and the controls from tab to carriage return.
_IN_WORD = np.array([c != 0x20 and not 0x09 <= c <= 0x0D for c in range(256)])
_PLACE = crf.mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """All texts' distinct shingles, sorted by (text, hash), and where each text's begin."""
    lower = raw + ((raw >= 0x41) & (raw <= 0x5A)).astype(np.uint8) * np.uint8(32)
    start, end = crf.word_bounds(_IN_WORD[raw], offsets)
    words = crf.hash_words(lower, start, end)
    n = len(offsets) - 1
    first = np.searchsorted(start, offsets)  # of each text's words
    count = np.diff(first)
    with np.errstate(over="ignore"):
        if len(words) >= size:
            m = len(words) - size + 1
            windows = sum((words[k:k + m] * _PLACE[k] for k in range(1, size)), words[:m] * _PLACE[0])
        else:
            windows = np.zeros(0, np.uint64)
        room = np.maximum(count - size + 1, 0)
        doc = np.repeat(np.arange(n), room)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(room) - room, room)
        value = crf.mixed(windows[first[doc] + at])
        short = np.flatnonzero((count > 0) & (count < size))
        if len(short):  # the whole sequence as one
            whole = np.zeros(len(short), np.uint64)
            for k in range(size - 1):
                here = count[short] > k
                whole[here] += words[first[short[here]] + k] * _PLACE[k]
            value = np.concatenate([value, crf.mixed(whole + count[short].astype(np.uint64) * _PLACE[63])])
            doc = np.concatenate([doc, short])
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(n + 1))


def nodes_of(value: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit name of every set: equal sets have equal names; 0 for the empty set."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(crf.mixed(value ^ _PLACE[62]))])
    size = np.diff(begin)
    with np.errstate(over="ignore"):
        name = crf.mixed(total[begin[1:]] - total[begin[:-1]] + size.astype(np.uint64) * _PLACE[61])
    return np.where(size > 0, name, 0).astype(np.uint64).view(np.int64)


def _bucket(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _measured(docs: DataFrame, size: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """One pass over all texts: (id, node, n) of every row, and the tasks'
    sketch counts, which leave a task as ``_PARTS`` rows however much it read."""

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["id", "node", "n", "part", "task", "counts"]
        types = [None, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            types[0] = batch.schema.field("id").type
            for part, raw, offsets in text_slices(batch):
                value, begin = shingle_sets(raw, offsets, size)
                counts += np.bincount(_bucket(value), minlength=len(counts))
                m = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(nodes_of(value, begin)), pa.array(np.diff(begin).astype(np.int64)),
                     *(pa.nulls(m, t) for t in types[3:])], names=names)
        if types[0] is not None:
            from pyspark import TaskContext

            task = TaskContext.get().partitionId() % _FAN_IN
            held = counts.astype(np.uint32).reshape(_PARTS, -1)
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(_PARTS, t) for t in types[:3]), pa.array(np.arange(_PARTS, dtype=np.int32)),
                 pa.array(np.full(_PARTS, task, np.int32)), pa.array([h.tobytes() for h in held], pa.binary())],
                names=names)

    out = spooled(docs.mapInArrow(
        run, f"id {kind}, node bigint, n bigint, part int, task int, counts binary"), "shingle-sets")
    return out.where("part is null").select("id", "node", "n"), out.where("part is not null").select(
        "part", "task", "counts")


def _sketch(counts: DataFrame) -> np.ndarray:
    """Counts of all tasks, summed in two steps: 2^SKETCH_BITS numbers."""

    def add(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part, task, held in zip(*(c.to_pylist() for c in batch.columns)):
                new = np.frombuffer(held, np.uint32)
                key = (part, task)
                total[key] = total[key] + new if key in total else new.astype(np.uint32)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()),
                 pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["part", "task", "counts"])

    schema = "part int, task int, counts binary"
    once = counts.repartition(_FAN_IN, "part", "task").mapInArrow(add, schema)
    twice = once.withColumn("task", F.lit(0)).repartition(_PARTS, "part").mapInArrow(add, schema)
    out = np.zeros((_PARTS, (1 << SKETCH_BITS) // _PARTS), np.uint32)
    for r in twice.collect():  # _PARTS rows
        out[r["part"]] += np.frombuffer(r["counts"], np.uint32)
    return out.ravel()


def bit_map(rows: DataFrame, column: str) -> bytes:
    """A map of 2^MAP_BITS bits, set at the hashes of a column's values."""
    at = F.pmod(F.xxhash64(column), F.lit(1 << MAP_BITS))
    got = (rows.select(F.shiftright(at, 15).alias("bucket"), F.pmod(at, F.lit(1 << 15)).alias("bit"))
           .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = bytearray(1 << (MAP_BITS - 3))
    for r in got:
        out[r["bucket"] * 4096:r["bucket"] * 4096 + len(r["bits"])] = r["bits"]
    return bytes(out)


def _on_map(rows: DataFrame, column: str, bits: bytes, wanted: bool = True) -> DataFrame:
    """Rows whose ``column`` is on the map: all that were put in, few others.
    Not ``wanted``: the rows that aren't on it (null is not)."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        held = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy()
            on = ((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1) & (at >= 0)
            yield batch.select(list(range(batch.num_columns - 1))).filter(pa.array(on == wanted))

    place = F.when(F.col(column).isNotNull(), F.pmod(F.xxhash64(column), F.lit(1 << MAP_BITS))).otherwise(-1)
    return rows.select("*", place.alias("_place_on_map")).mapInArrow(run, rows.schema)


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` whose (id, set of shingles) is not in ``gone``, a
    table (_id, _node); of rows that repeat id and set one stays, the least
    text (without words: that repeat id and text).  Rows with a null id stay.
    Only rows whose id may be in ``gone`` (by a bit map) or is repeated are
    shuffled."""
    again_ids = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).count().where("count > 1")
    again_ids = spooled(again_ids.select("_id"), "repeated-ids")
    bits = bit_map(gone.select("_id").unionByName(again_ids), "_id")
    sure = _on_map(docs, id_col, bits, wanted=False)

    def name(batches):
        for batch in batches:
            for part, raw, offsets in text_slices(batch, text_col):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(nodes_of(*shingle_sets(raw, offsets, size)))],
                    names=[*part.schema.names, "_node_of"])

    rest = _on_map(docs, id_col, bits)
    rest = rest.mapInArrow(name, StructType([*rest.schema.fields, StructField("_node_of", LongType())]))
    rest = rest.join(gone, (F.col(id_col) == F.col("_id")) & (F.col("_node_of") == F.col("_node")), "left_anti")
    if not again_ids.isEmpty():
        ids = again(again_ids)
        same = F.when(F.col("_node_of") == 0, F.col(text_col))
        one = (rest.join(ids, F.col(id_col) == F.col("_id"), "left_semi")
               .groupBy(F.col(id_col).alias("_id"), "_node_of", same.alias("_same"))
               .agg(F.min_by(F.struct(*docs.columns), F.coalesce(F.col(text_col), F.lit(""))).alias("_one"))
               .select("_one.*"))
        rest = rest.join(again(again_ids), F.col(id_col) == F.col("_id"), "left_anti").drop("_node_of").unionByName(one)
    else:
        rest = rest.drop("_node_of")
    return sure.unionByName(rest)


def _prefix_rows(docs: DataFrame, sketch: np.ndarray, size: int, percent: int) -> DataFrame:
    """(token, node, n, pos) of every node's prefix; a task gives a node once."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches):
        counts, given = shared.value, set()
        for batch in batches:
            for _, raw, offsets in text_slices(batch):
                value, begin = shingle_sets(raw, offsets, size)
                node, n = nodes_of(value, begin), np.diff(begin)
                fresh = n > 0
                for i in np.flatnonzero(fresh):
                    name = int(node[i])
                    fresh[i] = name not in given
                    given.add(name)
                doc = np.repeat(np.arange(len(n)), n)
                keep = fresh[doc]
                value, doc = value[keep], doc[keep]
                order = np.lexsort((value, counts[_bucket(value)], doc))
                value, doc = value[order], doc[order]
                pos = np.arange(len(doc)) - np.searchsorted(doc, doc)
                need = -(-n * percent // 100)
                keep = pos <= (n - need)[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[keep].view(np.int64)), pa.array(node[doc[keep]]),
                     pa.array(n[doc[keep]].astype(np.int32)), pa.array(pos[keep].astype(np.int32))],
                    names=["token", "node", "n", "pos"])

    return docs.mapInArrow(run, "token bigint, node bigint, n int, pos int")


def _lists(prefixes: DataFrame) -> DataFrame:
    """Inverted lists of at least two nodes: (token, block, node, n, pos),
    sorted by size and position.  Streams over sorted rows: a list of any
    length passes through a task without being held."""

    def run(batches):
        held, last, rank = None, None, 0  # the last row so far, its token, and its place in the list
        out_names = ["token", "block", "node", "n", "pos"]
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("token", "node", "n", "pos")])
            if held is not None:
                rows = np.concatenate([held[:, None], rows], axis=1)
            elif not rows.shape[1]:
                continue
            token, node = rows[0], rows[1]
            same = np.ones(len(token), bool)  # copies of a node come from different tasks
            same[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
            rows = rows[:, same]
            token = rows[0]
            new = np.ones(len(token), bool)
            new[1:] = token[1:] != token[:-1]
            begin = np.maximum.accumulate(np.where(new, np.arange(len(token)), 0))
            place = np.arange(len(token)) - begin + np.where(begin == 0, rank, 0)
            follows = np.zeros(len(token), bool)
            follows[:-1] = ~new[1:]
            emit = ((place > 0) | follows)
            emit[-1] = False  # it may yet be joined by the next batch
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0][emit]), pa.array((place[emit] // BLOCK).astype(np.int32)), pa.array(rows[1][emit]),
                 pa.array(rows[2][emit].astype(np.int32)), pa.array(rows[3][emit].astype(np.int32))], names=out_names)
            held, rank = rows[:, -1], int(place[-1])
            last = held
        if last is not None and rank > 0:
            yield pa.RecordBatch.from_arrays(
                [pa.array(last[:1]), pa.array([rank // BLOCK], pa.int32()), pa.array(last[1:2]),
                 pa.array(last[2:3].astype(np.int32)), pa.array(last[3:4].astype(np.int32))], names=out_names)

    return (prefixes.repartition("token").sortWithinPartitions("token", "n", "pos", "node")
            .mapInArrow(run, "token bigint, block int, node bigint, n int, pos int"))


def _block_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Every entry under the keys (token, i, j) of the block pairs it is in.
    Lists of one block have one key; of longer ones only the pairs of blocks
    whose sizes can match."""
    blocks = (again(lists).where("block > 0").select("token").distinct()
              .join(again(lists), "token").groupBy("token", "block")
              .agg(F.min("n").alias("least"), F.max("n").alias("most")))
    blocks = spooled(blocks, "list-blocks")
    one = blocks.select("token", F.col("block").alias("i"), F.col("most").alias("most_i"))
    two = again(blocks).select(F.col("token").alias("t2"), F.col("block").alias("j"), F.col("least").alias("least_j"))
    pairs = (one.join(two, (F.col("token") == F.col("t2")) & (F.col("i") <= F.col("j")))
             .where(F.col("least_j") * percent <= F.col("most_i") * 100).select("token", "i", "j"))
    keys = (pairs.select("token", "i", "j", F.col("i").alias("block"))
            .unionByName(pairs.where("i != j").select("token", "i", "j", F.col("j").alias("block"))))
    return (lists.join(keys, ["token", "block"], "left")
            .select("token", F.coalesce("i", F.lit(0)).alias("i"), F.coalesce("j", F.lit(0)).alias("j"), "block",
                    "node", "n", "pos"))


def _matching(n_a, pos_a, n_b, pos_b, percent: int) -> np.ndarray:
    """Whether a first common shingle at these positions leaves enough overlap."""
    most = 1 + np.minimum(n_a - pos_a, n_b - pos_b) - 1
    return (np.minimum(n_a, n_b) * 100 >= np.maximum(n_a, n_b) * percent) & (
        (100 + percent) * most >= percent * (n_a + n_b))


def _pairs(entries: DataFrame, percent: int, seed: int | None) -> DataFrame:
    """Candidate pairs (a < b) of nodes in different components: in round
    ``seed`` of each list's next leaders and its entries, without one all."""

    def pairs_of(rows: dict[str, np.ndarray], begin: np.ndarray, size: np.ndarray):
        group = np.repeat(np.arange(len(begin)), size)
        cols = [rows[c] for c in ("node", "n", "pos", "comp", "block")]
        split = (rows["i"] != rows["j"])

        def kept(x, y):
            node, n, pos, comp, block = cols
            ok = (comp[x] != comp[y]) & _matching(n[x], pos[x], n[y], pos[y], percent)
            ok &= ~split[x] | (block[x] != block[y])  # pairs inside a block belong to its own key
            a, b = node[x[ok]], node[y[ok]]
            return np.minimum(a, b), np.maximum(a, b)

        if seed is not None:
            with np.errstate(over="ignore"):
                rank = crf.mixed(rows["node"].view(np.uint64) + _PLACE[0])
            order = np.lexsort((rank, rows["pos"], group))
            for k in range((seed - 1) * LEADERS, seed * LEADERS):
                long = size > k + 1
                if not long.any():
                    break
                at = np.arange(len(group))
                ok = long[group] & (at - begin[group] > k)
                yield kept(order[begin[group[at[ok]]] + k], order[at[ok]])
        else:
            for step in range(1, int(size.max(initial=1))):
                at = np.arange(len(group) - step)
                at = at[(group[at] == group[at + step])]
                if not len(at):
                    break
                for s in range(0, len(at), 500_000):
                    yield kept(at[s:s + 500_000], at[s:s + 500_000] + step)

    def emitted(rows: dict[str, np.ndarray], new: np.ndarray):
        if not len(new):
            return
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(new)))
        held, n = [], 0
        for a, b in pairs_of(rows, begin, size):
            held.append(np.stack([a, b], axis=1))
            n += len(a)
            if n > 500_000:
                yield np.unique(np.concatenate(held), axis=0)
                held, n = [], 0
        if n:
            yield np.unique(np.concatenate(held), axis=0)

    def run(batches):
        names = ("token", "i", "j", "block", "node", "n", "pos", "comp")
        held: dict[str, np.ndarray] | None = None
        for batch in _then_none(batches):
            if batch is not None:
                rows = {c: batch.column(c).to_numpy().astype(np.int64) for c in names}
                if held is not None:
                    rows = {c: np.concatenate([held[c], rows[c]]) for c in names}
                held = rows
                if len(rows["token"]) < 200_000:
                    continue
            if held is None or not len(held["token"]):
                continue
            new = np.ones(len(held["token"]), bool)
            new[1:] = np.any([held[c][1:] != held[c][:-1] for c in ("token", "i", "j")], axis=0)
            cut = len(new) if batch is None else int(np.flatnonzero(new)[-1])  # the last list may go on
            for both in emitted({c: held[c][:cut] for c in names}, new[:cut]):
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])
            held = {c: held[c][cut:] for c in names}

    return (entries.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "pos", "node")
            .mapInArrow(run, "a bigint, b bigint").distinct())


def _then_none(items):
    yield from items
    yield None


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, common): the sizes of both sets and their intersection."""
    held = _on_map(sets, "node", bit_map(pairs.select(F.explode(F.array("a", "b")).alias("node")), "node"))
    held = spooled(held, "sets-of-pairs")
    left = again(held).select(F.col("node").alias("a"), F.col("members").alias("left"))
    right = again(held).select(F.col("node").alias("b"), F.col("members").alias("right"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = np.zeros((part.num_rows, 3), np.int64)
                for i, (x, y) in enumerate(zip(part.column("left"), part.column("right"))):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    found[i] = len(x), len(y), (y[place] == x).sum()
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), *(pa.array(c) for c in found.T)],
                    names=["a", "b", "n_a", "n_b", "common"])

    out = spooled(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        run, "a bigint, b bigint, n_a bigint, n_b bigint, common bigint").distinct(), "verified")
    dropped(held)
    return out


def _unanswered(pairs: DataFrame, known: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs that are not compared yet and whose answer doesn't follow from
    that of a similar set."""
    pairs = pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
    both = known.select("a", "b", "common").unionByName(
        known.select(F.col("b").alias("a"), F.col("a").alias("b"), "common"))
    likest = (both.groupBy("a").agg(F.max(F.struct("common", F.col("b").alias("leader"))).alias("one"))
              .select("a", F.col("one.leader").alias("leader"), F.col("one.common").alias("shared")))
    answers = both.select(F.col("a").alias("leader"), F.col("b").alias("b"), F.col("common").alias("answer"))
    n = sizes.select("node", "n")
    out = pairs.join(likest, "a", "left").join(answers, ["leader", "b"], "left")
    out = (out.join(n.withColumnsRenamed({"node": "a", "n": "n_a"}), "a")
           .join(n.withColumnsRenamed({"node": "b", "n": "n_b"}), "b"))
    most = F.col("answer") + F.col("n_a") - F.col("shared")
    enough = (100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))
    return out.where(F.coalesce(enough, F.lit(True))).select("a", "b")


def _linked(known: DataFrame, percent: int) -> DataFrame:
    return known.where((100 + percent) * F.col("common") >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
         percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) per input row.

    Words: A-Z lower-cased, runs of characters other than space and the
    controls from tab to carriage return.  A text of fewer words than a
    shingle has one shingle, all its words.  Null texts and texts without
    words have no shingles and link with nothing.  Rows that repeat an id
    are judged by their own texts.  A row with a null id is in the component
    of the rows with an equal set and an id, else in none (null).  Other
    columns are not read.
    """
    return _grouped(docs, id_col, text_col, size, percent).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))


def surplus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
            percent: int = PERCENT) -> DataFrame:
    """(_id, _node): every id with a set of shingles in a component, but the
    component's smallest id, and of its sets there the smallest node."""
    rows = _grouped(docs, id_col, text_col, size, percent).where("id is not null and n > 0")
    return (rows.where("id != least or node != kept")
            .select(F.col("id").alias("_id"), F.col("node").alias("_node")).distinct())


def _grouped(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(id, node, n, least, kept) per input row: its set's name and size, and
    of its component the smallest id and, of the sets under it, the smallest node."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    measured, counts = _measured(rows, size, kind)
    sketch = _sketch(counts)
    nodes = measured.where("n > 0").groupBy("node").agg(F.min("id").alias("first"), F.max("n").alias("n"))
    nodes = spooled(nodes, "nodes")

    lists = spooled(_lists(_prefix_rows(rows.where("id is not null").select("text"), sketch, size, percent)), "lists")
    entries = spooled(_block_pairs(lists, percent), "entries")
    made = spooled(_pairs(entries.withColumn("comp", F.col("node")), percent, seed=1), "pairs")
    used = [lists, entries, made]  # read no more when this returns
    known = links = None
    for step in (1, 2, None):
        if step != 1:
            if known is None:  # leaders named no pair, which says nothing of the others
                left = _pairs(again(entries).withColumn("comp", F.col("node")), percent, seed=step)
            else:
                group = components(links, rounds=3 if step else None)
                tagged = (again(entries).join(group.withColumnRenamed("id", "node"), "node", "left")
                          .withColumn("comp", F.coalesce("component", "node")).drop("component"))
                left = _unanswered(_pairs(tagged, percent, seed=step), known, nodes, percent)
            made = spooled(left, "pairs")
            used.append(made)
        elif entries.isEmpty():
            break
        else:
            bits = bit_map(_partnered(entries, made, percent).join(again(nodes), "node").select("first"), "first")
            sets = _sets(rows, bits, size)
            used.append(sets)
        if made.isEmpty():
            continue
        new = _verified(made, sets)
        used.append(new)
        if known is not None:
            new = spooled(known.unionByName(new), "verified")
            used.append(new)
        known = new
        links = _linked(known, percent)
    named = nodes.select("node", "first")
    if links is not None:
        group = components(links).withColumnRenamed("id", "node")
        named = named.join(group, "node", "left")
    else:
        named = named.withColumn("component", F.lit(None).cast("long"))
    for old in used:
        dropped(old)
    named = named.withColumn("root", F.coalesce("component", "node"))
    # A node's first is its smallest id, so the least pair is a row's.
    least = named.groupBy("root").agg(F.min(F.struct("first", "node")).alias("one"))
    named = named.join(least, "root").select(
        F.col("node").alias("of"), F.col("one.first").alias("least"), F.col("one.node").alias("kept"))
    return (measured.join(named, F.col("node") == F.col("of"), "left")
            .select("id", "node", "n", "least", "kept"))


def _partnered(entries: DataFrame, made: DataFrame, percent: int) -> DataFrame:
    """Nodes that a round can name: those of the first round's pairs, and of
    lists too long for its leaders those with a size near enough to the next
    smaller or larger one."""
    place = Window.partitionBy("token", "i", "j").orderBy("n")
    near = (F.lag("n").over(place) * 100 >= F.col("n") * percent) | (
        F.col("n") * 100 >= F.lead("n").over(place) * percent)
    held = F.count("*").over(Window.partitionBy("token", "i", "j"))
    far = (again(entries).withColumns({"near": near, "held": held}).where(f"near and held > {LEADERS + 1}")
           .select("node"))
    return far.unionByName(again(made).select(F.explode(F.array("a", "b")).alias("node"))).distinct()


def _sets(rows: DataFrame, bits: bytes, size: int) -> DataFrame:
    """(node, members) of the documents on the map."""

    def run(batches):
        for batch in batches:
            for part, raw, offsets in text_slices(batch):
                value, begin = shingle_sets(raw, offsets, size)
                node = nodes_of(value, begin)
                members = [value[a:b].tobytes() for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(members, pa.binary())],
                                                 names=["node", "members"])

    chosen = _on_map(rows.where("id is not null"), "id", bits)
    return spooled(chosen.mapInArrow(run, "node bigint, members binary").where("length(members) > 0"), "sets")
