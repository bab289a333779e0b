"""Conversation repair against an exhaustive search, in small blocks and in large ones."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from hirelens.llm import conversation_repair as repair

LEGAL = re.compile("(s?(ua)+)?")


def plain_rows(rows):
    """The damaged rows of (conv_id, turn, role, text), by conversation in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    return out


def search(rows):
    """The least (cost, audit, output) of all edits with at most two inserts in one place."""
    @cache
    def rest(i, initials, inserted):
        ways = [(0, "", ())] if i == len(rows) and LEGAL.fullmatch(initials) else []

        def edited(letter, cost, line, to, inserted=0):
            later = rest(to, initials + "".join(r[:1] or "?" for r, _ in line), inserted)
            if later is not None:
                ways.append((later[0] + cost, letter + later[1], line + later[2]))

        if inserted < 2:
            for role in ("user", "assistant"):
                edited("I", 2, ((role, ""),), i, inserted + 1)
        if i < len(rows):
            role, text, must_go, cut_off = rows[i]
            edited("D", 3, (), i + 1)
            if not must_go:
                edited("K", cut_off, ((role, text),), i + 1)
                for new in ("user", "assistant"):
                    edited("R", 2 + cut_off, ((new, text),), i + 1)
        return min(ways, default=None)

    return rest(0, "", 0)


def plain(rows):
    found = set()
    for conv, kept in plain_rows(rows).items():
        seen, judged, n = set(), [], [0, 0, 0]
        for _, role, text in kept:
            body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            blank, again, cut_off = not body, (role, text) in seen, body[-1:] not in tuple(".!?")
            seen.add((role, text))
            n[0] += blank
            n[1] += again and not blank
            n[2] += cut_off and not blank and not again
            judged.append((role, text, blank or again, int(cut_off)))
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, out = search(judged)
        text = "\n".join(f"{r}:{t}" for r, t in out)
        found.add((conv, gaps, *n, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return found


def conversations(seed, count=40, most=4):
    rng = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(rng.randrange(1, most + 1)):
            rows.append((conv, rng.choice([turn, turn, turn * 3, None]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None]),
                         rng.choice(["Hi.", "Why?", "Because", "Done!  \n", "", " \t", None, "x. y", " ", "é"])))
    return rows + [(None, 1, "user", "Who?"), (None, 2, "assistant", "Me."), (None, 2, "assistant", "Me.")]


@pytest.mark.parametrize("seed,block", [(1, 1_024), (2, 2), (3, 3)])
def test_report_equals_the_exhaustive_search(spark, monkeypatch, seed, block):
    monkeypatch.setattr(repair, "LEAST_BLOCK", block)
    monkeypatch.setattr(repair, "isqrt", lambda n: min(block, 3))  # blocks and checkpoints every few rows
    rows = conversations(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "block", F.lit("x")).withColumn("digest", F.lit(1)).repartition(4)
    got = {tuple(r) for r in repair.report(repair.damage(df)).collect()}
    assert got == plain(rows)


def forward(kinds):
    """The least (cost, audit) by a plain forward search over all rows."""
    best = {repair.START: (0, "")}

    def inserts(best):
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                to = repair.FITS[s]
                best[to] = min(best.get(to, (repair.NEVER, "")), (c + 2, a + "I"))
        return best

    best = inserts(best)
    for kind in kinds:
        after = {}
        for s, (c, a) in best.items():
            for letter, to, cost in repair.choices(kind, s, (0, 0, 0, 0)):
                after[to] = min(after.get(to, (repair.NEVER, "")), (c + cost, a + letter))
        best = inserts(after)
    return min(best.get(repair.START, (repair.NEVER, "")), best.get(repair.ASSISTANT, (repair.NEVER, "")))


def test_parts_put_together_equal_the_whole():
    rng = random.Random(7)
    for _ in range(200):
        kinds = bytes(rng.randrange(9) for _ in range(rng.randrange(1, 40)))
        cut = sorted(rng.sample(range(1, len(kinds)), min(3, len(kinds) - 1)))
        parts = [kinds[a:b] for a, b in zip([0, *cut], [*cut, len(kinds)])]
        ends = [repair.END]
        for part in reversed(parts[1:]):
            ends.append(repair.applied(repair.matrix(part), ends[-1]))
        audit, state = "", repair.START
        for part, end in zip(parts, reversed(ends)):
            text, state = repair.walk(part, [1] * len(part), end, state, end is ends[0])
            audit += text
        cost = repair.applied(repair.matrix(parts[0]), ends[-1])[repair.START]
        assert (cost, audit) == forward(kinds)


def test_one_long_conversation_is_spread_over_blocks(spark):
    roles = ["user", "assistant", "user", "system", "assistant"]
    df = spark.range(6_000).select(
        F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.element_at(F.array(*map(F.lit, roles)), (F.col("id") % 5 + 1).cast("int")).alias("role"),
        F.concat(F.lit("line "), F.col("id") % 4_000, F.when(F.col("id") % 3 == 0, ".").otherwise("")).alias("text"))
    found = repair.spooled(repair.runs(df), "test-runs")
    blocks = repair.numbered(found).groupBy("block").count().collect()
    assert len(blocks) == 6 and max(r["count"] for r in blocks) == repair.LEAST_BLOCK
    row = repair.report(df).first()
    kinds = [repair.FORCED if r["kind"] == repair.FORCED else r["kind"]
             for r in repair.numbered(found).orderBy("place").collect()]
    assert (row["cost"], row["audit"]) == forward(kinds)
    lines = repair.repaired(df).orderBy("place").collect()
    text = "\n".join(f"{r['role']}:{r['text']}" for r in lines)
    assert hashlib.sha256(text.encode()).hexdigest() == row["repaired_sha256"]
    assert LEGAL.fullmatch("".join(r["role"][0] for r in lines))


def test_copies_extremes_and_empty(spark):
    rows = [(1, 1, "user", "Same.")] * 500 + [(2, -2**63, "user", "a."), (2, 2**63 - 1, "assistant", "b.")] + [
        (3, 1, "user", "long. " * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in repair.report(df).collect()}
    assert (got[1]["cost"], got[1]["duplicate"], got[1]["audit"]) == (3 * 499 + 2, 499, "K" + "D" * 499 + "I")
    assert got[2]["gaps"] is None and got[2]["audit"] == "KK"
    assert got[3]["audit"] == "KI"
    assert repair.report(repair.damage(df.limit(0))).count() == 0
    gone = repair.report(df.select("*", F.lit(0).alias("copies")).where("conv_id = 2")).first()
    assert tuple(gone) == (2, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
