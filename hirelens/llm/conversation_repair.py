"""Cheapest repair of conversations by a checkpointed dynamic program.

A conversation's rows, in the order of their turns, are kept (cost 0),
reroled to user or assistant (2) or deleted (3; blank rows and repetitions
must be), and rows with an empty text may be inserted (2), so that the role
initials read ``(s?(ua)+)?``; a truncated row that stays costs 1 more.  Of the
cheapest edits the ASCII-least string of initials (D, I, K, R) is taken.

The automaton of the wanted initials has four states, so what a row does to
the costs of the states is a 4 x 4 matrix over (min, +).  Backward state-cost
vectors are stored at checkpoints only, and the rows between two checkpoints
are computed anew while walking forward along the tight edits, the least
letter first (each letter leads to one state, so that is the least string).

There are two levels of checkpoints:

* rows are numbered along a range partitioning and cut into blocks of about
  the square root of all rows.  Each part of a conversation in a block gives
  its matrix; the matrices of a conversation, streamed from its end, give the
  vector at the end of each part; then each part is walked on its own;
* inside a part of m rows every sqrt(m)-th vector is stored.

So a conversation that holds a third of all rows is split over blocks, and no
task holds more than a block.  Up to there only (conversation, turn, digest of
role and text, flags) move, copies counted before they do.  The texts move
once, to be read in order beside the edits; a digest of a whole conversation
has to be taken by one task, which streams it.

Defined results: order is by turn (nulls first), then by the MD5 digest of
role and text; equal rows stand next to each other.  Two rows are the same if
that digest is.  A null role or text is one blank; an empty role, like any
other whose initial isn't s, u or a, fits nowhere.  A null conversation id is
an id; a conversation without rows has zeros and an empty audit.  Turn gaps
beyond 64 bits give null.  An empty table gives no rows, further columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from hirelens.llm.common import again, spooled
from hirelens.operators.keys import assign_keys

#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a user or assistant row leads that fits (inserted or reroled), and its role.
FITS = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
#: Where a kept row leads, by state and initial.
KEEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
NEVER = 1 << 60
#: Rows of a block, at least; the square root of all rows, if that is more.
LEAST_BLOCK = 1_024
#: Adjacent initials that may stand.
LEGAL = frozenset(("su", "ua", "au"))

INITIALS = "sua-"
#: A run's kind: its initial's place in ``INITIALS`` * 2 + truncated, or FORCED (has to be deleted).
FORCED = 2 * len(INITIALS)
WHITE = r"\x20\x09-\x0D"

Vector = tuple[int, int, int, int]


# -- the dynamic program -------------------------------------------------------------------------

def with_inserts(c: Vector) -> Vector:
    user = min(c[USER], INSERT + c[ASSISTANT])
    return (min(c[START], INSERT + user), min(c[SYSTEM], INSERT + user), user, min(c[ASSISTANT], INSERT + c[USER]))


END = with_inserts((0, NEVER, NEVER, 0))


def choices(kind: int, state: int, after: Vector) -> list[tuple[str, int, int]]:
    """(initial, state, cost from there on) of the edits that use up a row."""
    out = [("D", state, DELETE + after[state])]
    if kind != FORCED:
        cut_off = CUT_OFF * (kind % 2)
        kept = KEEPS[state].get(INITIALS[kind // 2])
        if kept is not None:
            out.append(("K", kept, cut_off + after[kept]))
        out.append(("R", FITS[state], REROLE + cut_off + after[FITS[state]]))
    return out


def before(kind: int, after: Vector) -> Vector:
    """Costs from before a row on, given those from behind it on."""
    return with_inserts(tuple(min(cost for _, _, cost in choices(kind, s, after)) for s in range(4)))


def matrix(kinds: bytes) -> list[int]:
    """16 costs: row s * 4 + t of a part leads from state s to state t (inserts behind the last row excluded)."""
    columns = []
    for t in range(4):
        costs = tuple(0 if s == t else NEVER for s in range(4))
        for kind in reversed(kinds):
            costs = before(kind, costs)
        columns.append(costs)
    return [min(columns[t][s], NEVER) for s in range(4) for t in range(4)]


def applied(parts: list[int], after: Vector) -> Vector:
    return tuple(min(parts[4 * s + t] + after[t] for t in range(4)) for s in range(4))


def walk(kinds: bytes, copies: list[int], end: Vector, state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least tight edits of a part from ``state``, and the state behind it."""
    step = isqrt(len(kinds)) + 1
    marks, costs = {}, end
    for i in range(len(kinds) - 1, -1, -1):
        if (i + 1) % step == 0:
            marks[i + 1] = costs
        costs = before(kinds[i], costs)
    edits = []
    for start in range(0, len(kinds), step):
        stop = min(start + step, len(kinds))
        vectors = [marks[stop] if stop in marks else end]
        for i in range(stop - 1, start - 1, -1):
            vectors.append(before(kinds[i], vectors[-1]))
        vectors.reverse()
        for i in range(start, stop):
            here, after = vectors[i - start], vectors[i - start + 1]
            used = False
            while not used:
                options = choices(kinds[i], state, after)
                options.insert(1, ("I", FITS[state], INSERT + here[FITS[state]]))
                letter, to = next((x, to) for x, to, cost in options if cost == here[state])
                edits.append(letter)
                state, used = to, letter != "I"
            edits.append("D" * (copies[i] - 1))  # further copies are repetitions
    while last and state not in (START, ASSISTANT):
        edits.append("I")
        state = FITS[state]
    return "".join(edits), state


# -- Spark -----------------------------------------------------------------------------------------

def damage(df: DataFrame) -> DataFrame:
    """Rows harmed by their id and turn: ``copies`` 0 (dropped), 1 or 2, texts
    emptied or without their stops, roles set to user; by crc32 modulo 20."""
    def name(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = name("text")
    return df.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(name("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def _read(rows: DataFrame) -> DataFrame:
    """Whole rows with their digest; ``copies`` is 1 unless the input has it."""
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)).alias("copies"),
    ).withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))))


def runs(rows: DataFrame) -> DataFrame:
    """One light row for each turn and digest of a conversation: copies, kind, faults."""
    initial = F.substring("role", 1, 1)
    flags = _read(rows).where(F.col("copies") > 0).select(
        "conv_id", "turn", "digest", "copies",
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        (~F.col("text").rlike(f"[^{WHITE}]")).alias("blank"),
        F.col("text").rlike(rf"[^.!?{WHITE}][{WHITE}]*\z").alias("cut_off"))
    counted = flags.groupBy("conv_id", "turn", "digest", "initial", "blank", "cut_off").agg(
        F.sum("copies").alias("copies"))
    # Of rows that stand in several turns the first is no repetition.
    first = (counted.groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"))
             .agg(F.min(F.struct("turn")).alias("_first"), F.count(F.lit(1)).alias("_turns"))
             .where("_turns > 1"))
    joined = counted.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")),
                          "left")
    again_ = F.col("_first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_first.turn"))
    forced = F.col("blank") | F.col("repeated")
    return joined.withColumn("repeated", again_).select(
        "conv_id", "turn", "digest", "copies", "initial", "blank",
        F.when(F.col("blank"), 0).otherwise(F.col("copies") - 1 + F.col("repeated").cast("long")).alias("duplicates"),
        (~forced & F.col("cut_off")).cast("long").alias("truncated"),
        F.when(forced, FORCED).otherwise(F.col("initial") * 2 + F.col("cut_off").cast("int")).alias("kind"))


def counts(found: DataFrame) -> DataFrame:
    """conv_id and four counts: gaps, blank, duplicate, truncated."""
    turns = found.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum("duplicates").alias("duplicate"), F.sum("truncated").alias("truncated"))
    span = (F.max("turn").cast("decimal(38,0)") - F.min("turn").cast("decimal(38,0)") + 1 - F.count("turn")).try_cast(
        "long")
    return turns.groupBy("conv_id").agg(
        F.when(F.count("turn") > 0, span).otherwise(0).alias("gaps"), F.sum("blank").alias("blank"),
        F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"))


def _parts(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with the same (block, conversation), one such part at a time."""
    at, got = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("block", "conv_id", *names))):
            if row[:2] != at:
                if got:
                    yield at, got
                at, got = row[:2], []
            got.append(row[2:])
    if got:
        yield at, got


def _table(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _mapped(df: DataFrame, rows, columns: str) -> DataFrame:
    """``mapInArrow`` of a function from batches to tuples."""
    kind = StructType.fromDDL(columns)
    schema = to_arrow_schema(kind)
    return df.mapInArrow(lambda batches: _table(rows(batches), schema), kind)


def numbered(found: DataFrame) -> DataFrame:
    """Runs with their place in the order of all, in blocks of the square root of their number."""
    block = max(LEAST_BLOCK, isqrt(found.count()))
    placed = assign_keys(again(found).select("conv_id", "turn", "digest", "copies", "initial", "kind"),
                         ["conv_id", "turn", "digest"], "place")
    return placed.select("conv_id", "place", "copies", "initial", "kind",
                         F.floor(F.col("place") / block).cast("long").alias("block"))


def matrices(placed: DataFrame) -> DataFrame:
    """One row for each part of a conversation in a block: its matrix, outer
    initials, illegal neighbours inside and the cost of further copies."""
    def run(batches):
        for (block, conv), rows in _parts(batches, ("copies", "initial", "kind")):
            initials = [INITIALS[i] for _, i, _ in rows]
            more = sum(n - 1 for n, _, _ in rows)
            illegal = more + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            yield conv, block, matrix(bytes(k for _, _, k in rows)), initials[0], initials[-1], illegal, DELETE * more

    kind = placed.schema["conv_id"].dataType.simpleString()
    return _mapped(placed.repartition("block").sortWithinPartitions("block", "conv_id", "place"), run,
                   f"conv_id {kind}, block long, matrix array<long>, opens string, closes string, illegal long, extra long")


def checkpoints(parts: DataFrame) -> DataFrame:
    """For each part the vector at its end and whether it is its conversation's
    last; the first part (``first``) also has the conversation's cost and
    illegal neighbours.  Matrices stream from a conversation's end."""
    def run(batches):
        held = None  # the part nearer the end, whose being the first is open
        for batch in batches:
            for conv, block, costs, opens, closes, illegal, extra in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or held[0] != conv:
                    if held is not None:
                        yield (*held[:4], True, held[4][START] + held[6], held[5])
                    end, last = END, True
                else:
                    yield (*held[:4], False, None, None)
                    end, last = held[4], False
                    extra += held[6]
                    illegal += held[5] + (closes + held[7] not in LEGAL)
                held = (conv, block, list(end), last, applied(costs, end), illegal, extra, opens)
        if held is not None:
            yield (*held[:4], True, held[4][START] + held[6], held[5])

    kind = parts.schema["conv_id"].dataType.simpleString()
    return _mapped(parts.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block")), run,
                   f"conv_id {kind}, block long, vector array<long>, last boolean, first boolean, cost long, illegal long")


def walks(placed: DataFrame, ends: DataFrame) -> DataFrame:
    """For each part its edits and final state, from each state it may start in."""
    def run(batches):
        for (block, conv), rows in _parts(batches, ("vector", "last", "first", "cost", "illegal", "copies", "kind")):
            vector, last, first, cost, illegal = rows[0][:5]
            kinds, copies = bytes(r[6] for r in rows[1:]), [r[5] for r in rows[1:]]
            ways = [walk(kinds, copies, tuple(vector), s, last) if s == START or not first else (None, None)
                    for s in range(4)]
            yield conv, block, [e for e, _ in ways], [s for _, s in ways], cost, illegal

    both = ends.withColumn("place", F.lit(-1).cast("long")).unionByName(placed.drop("initial"), allowMissingColumns=True)
    kind = placed.schema["conv_id"].dataType.simpleString()
    return _mapped(both.repartition("block").sortWithinPartitions("block", "conv_id", "place"), run,
                   f"conv_id {kind}, block long, edits array<string>, exits array<int>, cost long, illegal long")


def edits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The parts' edits, and the spooled runs they are of."""
    found = spooled(runs(rows), "runs")
    placed = numbered(found)
    return walks(placed, checkpoints(matrices(placed))), found


class _Conversation:
    """One conversation of the final stream: its counts, its edits part by part, then its rows."""

    def __init__(self, conv):
        self.conv, self.counts, self.cost, self.illegal = conv, (0, 0, 0, 0), 0, 0
        self.pieces: list[str] = []
        self.state = START

    def part(self, edits, exits, cost, illegal):
        self.pieces.append(edits[self.state])
        self.state = exits[self.state]
        if cost is not None:
            self.cost, self.illegal = cost, illegal

    def lines(self, rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of every row that the repaired conversation has."""
        self.audit = "".join(self.pieces)
        place, state = 0, START
        for role, text, copies in rows:
            for _ in range(copies):
                while self.audit[place] == "I":
                    yield "I", ROLE[state], ""
                    state, place = FITS[state], place + 1
                edit, place = self.audit[place], place + 1
                if edit == "K":
                    yield edit, role, text
                    state = KEEPS[state][role[0]]
                elif edit == "R":
                    yield edit, ROLE[state], text
                    state = FITS[state]
        for _ in self.audit[place:]:
            yield "I", ROLE[state], ""
            state = FITS[state]


COUNTS, PART, ROW = range(3)


def _beside_texts(rows: DataFrame) -> DataFrame:
    """Counts, edits and texts of each conversation in one place, in that order."""
    parts, found = edits(rows)
    read = _read(rows)
    named = read.select("conv_id").distinct().withColumn("tag", F.lit(COUNTS))
    counted = counts(again(found)).select(
        "conv_id", F.lit(COUNTS).alias("tag"), F.array("gaps", "blank", "duplicate", "truncated").alias("counts"))
    whole = read.where(F.col("copies") > 0).withColumn("tag", F.lit(ROW))
    union = (whole.unionByName(parts.withColumn("tag", F.lit(PART)), allowMissingColumns=True)
             .unionByName(counted, allowMissingColumns=True).unionByName(named, allowMissingColumns=True))
    return union.repartition("conv_id").sortWithinPartitions("conv_id", "tag", "block", "turn", "digest")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, Iterator[tuple[str, str, int]]]]:
    """Each conversation with an iterator over its rows, to be used up before the next one."""
    names = ("conv_id", "tag", "role", "text", "copies", "edits", "exits", "cost", "illegal", "counts")
    stream = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in names)))
    row = next(stream, None)

    def texts(conv):
        nonlocal row
        while row is not None and row[0] == conv:
            yield row[2], row[3], row[4]
            row = next(stream, None)

    while row is not None:
        found = _Conversation(row[0])
        while row is not None and row[0] == found.conv and row[1] != ROW:
            if row[1] == PART:
                found.part(*row[5:9])
            elif row[9] is not None:
                found.counts = row[9]
            row = next(stream, None)
        yield found, texts(found.conv)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text."""
    def run(batches):
        for found, texts in _conversations(batches):
            for place, (edit, role, text) in enumerate(found.lines(texts)):
                yield found.conv, place, edit, role, text

    kind = rows.schema["conv_id"].dataType.simpleString()
    return _mapped(_beside_texts(rows), run, f"conv_id {kind}, place long, edit string, role string, text string")


def report(rows: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, audit and the digest of the repaired ``role:text`` lines."""
    def run(batches):
        for found, texts in _conversations(batches):
            digest, first = hashlib.sha256(), True
            for _, role, text in found.lines(texts):
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            yield (found.conv, *found.counts, found.illegal, found.cost, found.audit, digest.hexdigest())

    kind = rows.schema["conv_id"].dataType.simpleString()
    return _mapped(_beside_texts(rows), run,
                   f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                   "audit string, repaired_sha256 string")
