"""Phrase mining against a brute-force version."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import phrase_mining


def plain(rows, least, cover, top):
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i:i + n])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang, p] = (score, a, f[lang, p[:k]], f[lang, p[k:]])
    kept = {}
    for (lang, p), v in found.items():
        inside = any(lang == other and len(q) > len(p) and 100 * b[1] >= cover * v[1]
                     and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (other, q), b in found.items())
        if not inside:
            kept.setdefault(lang, []).append((-v[0], -v[1], " ".join(p).encode(), v))
    return {(lang, rank, x[2].decode(), x[3][1], x[3][2], x[3][3], total[lang], x[3][0])
            for lang, xs in kept.items() for rank, x in enumerate(sorted(xs)[:top], start=1)}


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "Old", "mill", "é", "a", "x y", "ab", "ba", "7", "-", "\x0e"]
    rows = []
    for _ in range(80):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"])
                       for _ in range(rng.randrange(0, 60)))
        rows.append((rng.choice(["en", "de", None, "und", ""]), text))
    rows += [("en", "once upon a time there was a Mill by the old river and nobody knew who had built it there")] * 9
    rows += [("en", "he said once upon a time there was a mill by the old river and left")] * 5
    rows += [("en", None), (None, ""), ("de", " . , "), ("fr", "word " * 500), ("fr", "one")]
    return rows


@pytest.mark.parametrize("seed,least,cover,period", [(1, 3, 100, 3), (2, 5, 100, 1), (3, 4, 60, 16)])
def test_mine_equals_brute_force(spark, monkeypatch, seed, least, cover, period):
    monkeypatch.setattr(phrase_mining, "SLICE_BYTES", 700)
    monkeypatch.setattr(phrase_mining, "BLOCK_BYTES", 900)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("chunk", F.lit(1)).withColumn("n", F.lit("x"))
    got = phrase_mining.mine(df.repartition(5), least=least, cover=cover, top=40, period=period)
    assert {tuple(r) for r in got.collect()} == plain(rows, least, cover, 40)


def test_full_bitmap_prunes_less_and_never_wrongly(spark, monkeypatch):
    monkeypatch.setattr(phrase_mining, "MOST_BITS", 6)
    rows = corpus(4)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert {tuple(r) for r in phrase_mining.mine(df, least=3).collect()} == plain(rows, 3, 100, 2000)


def test_products_beyond_64_bits(spark):
    from hirelens.llm.common import spooled

    big = 3 * 10**12
    frequent = spooled(spark.createDataFrame(
        [("en", "a", 1, big + 1), ("en", "b", 1, big + 7), ("en", "a b", 2, big)],
        "lang string, phrase string, words int, f bigint"), "test-phrases")
    total = spark.createDataFrame([("en", 5 * 10**15)], "lang string, n bigint")
    row = phrase_mining.scored(frequent, total).first()
    assert row["score"] == 1000 * big * 5 * 10**15 // ((big + 1) * (big + 7))


def test_chunks_of_the_dictionary_hold_each_word_once(spark):
    rows = [("en", " ".join(f"w{i * i % 37}" for i in range(400)) + f". tail {j % 3}") for j in range(20)]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = phrase_mining.dictionary(df, period=4).collect()
    assert sum(r["core"] * r["n"] for r in got) == 20 * 402
    assert max(r["n"] for r in got) >= 20
    assert all(len(r["chunk"].split(" ")) - r["core"] in (0, 4) for r in got)


def test_without_words(spark):
    df = spark.createDataFrame([("en", None), (None, " . ")], "lang string, text string")
    assert phrase_mining.mine(df).count() == 0
    assert phrase_mining.mine(df.limit(0)).count() == 0


def test_a_words_hash_is_its_own_wherever_it_stands():
    data = np.frombuffer(b"mill " * 3_000 + b"by " + b"x" * 5_000 + b" mill", np.uint8)
    starts = np.append(0, np.flatnonzero(data == 0x20) + 1)
    got = phrase_mining.hashes(data, starts)
    assert len(set(got.tolist())) == 3 and (got[:3_000] == got[-1]).all()
    assert got[0] == phrase_mining.hashes(data[:4], starts[:1])[0]
    plain = sum((b + 1) * int(phrase_mining.BASE) ** (i + 1) for i, b in enumerate(b"mill")) % 2**64
    assert got[0] == phrase_mining.mixed(np.asarray([plain], np.uint64))[0]
    assert phrase_mining.powers(phrase_mining.BASE, 5_000)[-1] == pow(int(phrase_mining.BASE), 4_999, 2**64)
