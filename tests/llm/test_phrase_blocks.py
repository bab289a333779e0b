"""Phrase mining: wide rows, sums by array operations, and their edges."""

from collections import Counter

import numpy as np
import pytest

from hirelens.llm import phrase_mining
from tests.llm.test_phrases import corpus, plain


def test_the_dictionary_and_what_is_counted_are_few_wide_rows(spark, monkeypatch):
    rows = [("en", " ".join(f"w{(i * i + j) % 997}" for i in range(300)) + ". the old mill") for j in range(200)]
    written = {}

    def spooled(df, name, real=phrase_mining.spooled):
        out = real(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(phrase_mining, "spooled", spooled)
    df = spark.createDataFrame(rows, "lang string, text string")
    got = {tuple(r) for r in phrase_mining.mine(df.repartition(4)).collect()}
    assert got == plain(rows, 100, 100, 2000)
    chunks = phrase_mining.dictionary(df).count()
    assert chunks > 500 and written["chunks"] < chunks / 20


def test_rows_and_blocks_cut_anywhere_give_the_same(spark, monkeypatch):
    rows = corpus(7) + [(f"l{i % 60}", "a b a b c " * 4) for i in range(240)] + [("en", "über  \U0001f600 x")] * 5
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for size in (1, 200, 10**9):
        for name in ("ROW_BYTES", "BLOCK_BYTES", "CHUNK_BYTES", "SUM_ROWS"):
            monkeypatch.setattr(phrase_mining, name, size)
        assert {tuple(r) for r in phrase_mining.mine(df, least=4, period=3).collect()} == plain(rows, 4, 100, 2000)


@pytest.mark.parametrize("weight", [1, 65_535, 65_536, 10**7 + 3])
def test_weights_beyond_their_bits(weight):
    keys = phrase_mining.mixed(np.arange(50, dtype=np.uint64)) & ~np.uint64(phrase_mining.MOST_WEIGHT)
    keys, weights = np.tile(keys, 3), np.tile(np.arange(50) * 7 + weight, 3)
    key, total = phrase_mining.summed(phrase_mining.weighted(keys, weights))
    want = Counter()
    for k, w in zip(keys.tolist(), weights.tolist()):
        want[k] += w
    assert dict(zip(key.tolist(), total.tolist())) == want and sorted(want) == key.tolist()


def words_of(chunks):
    """A block of chunks of one language with their frequencies."""
    data = np.frombuffer(b"".join(c.encode() + bytes([phrase_mining.STOPS]) for c, _ in chunks), np.uint8)
    offsets = np.append(0, np.flatnonzero(data == phrase_mining.STOPS) + 1)
    batch = phrase_mining.row([("en", data, offsets, np.asarray([n for _, n in chunks]))])
    return phrase_mining.Words(batch.to_pylist(), True)


def test_phrases_of_one_hash_stay_apart(monkeypatch):
    words = words_of([("a b a c a b b", 3), ("b a", 70_000), ("c", 1)])

    class Full:
        value = b"\xff" * 8

    def levels(self, maps):
        for n in range(1, 3):
            yield np.arange(len(self.codes)), np.full(len(self.codes), n << 60, np.uint64)

    monkeypatch.setattr(phrase_mining.Words, "levels", levels)
    got = Counter()
    for batch in phrase_mining.found_phrases(words, [Full, Full]):
        for r in batch.to_pylist():
            for phrase, f in zip(r["phrases"].decode().split("\n"), np.frombuffer(r["f"], np.int64).tolist()):
                got[phrase] += f
    assert got == {"a": 70_009, "b": 70_009, "c": 4, "a b": 6, "b a": 70_003, "a c": 3, "c a": 3, "b b": 3}


def test_the_session_is_as_before(spark):
    keys = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(k) for k in keys]
    phrase_mining.mine(spark.createDataFrame([("en", "a b")], "lang string, text string"), least=1).count()
    assert [spark.conf.get(k) for k in keys] == before
