"""The key table beside an append target, against a plain set."""

import random
import tempfile

import pytest

from hirelens.sources import history as H
from hirelens.sources import io
from hirelens.sources.manifest import Manifest


def rows(spark, ids):
    return spark.createDataFrame([(f"/job/{i}", f"t{i}") for i in ids], "url string, title string")


def titles(spark, path):
    return sorted(r["title"] for r in spark.read.parquet(path).collect())


def test_batches_against_a_plain_set(spark, monkeypatch):
    """Small buckets and few batches per generation: every kind of file comes up."""
    monkeypatch.setattr(H, "KEYS_PER_BUCKET", 40)
    monkeypatch.setattr(H, "MOST_BATCHES", 3)
    rng, path, seen, want = random.Random(1), tempfile.mkdtemp() + "/t", set(), []
    for _ in range(9):
        ids = [rng.randrange(900) for _ in range(rng.randrange(0, 150))]
        added = [i for i in ids if i not in seen]
        assert io.append_new(rows(spark, ids), path) == len(added)
        seen.update(ids)
        want += [f"t{i}" for i in added]
    assert titles(spark, path) == sorted(want)
    state = Manifest(spark, f"{path}/_keys").read()
    assert state["generation"] >= 2 and state["buckets"] > 4 and state["last"] == 8


def test_no_stored_key_is_missed_and_few_are_read(spark, monkeypatch):
    monkeypatch.setattr(H, "KEYS_PER_BUCKET", 500)
    path, read = tempfile.mkdtemp() + "/t", []
    io.append_new(rows(spark, range(20_000)), path)
    asked = H.History._keys

    def counted(self, buckets, before):
        found = asked(self, buckets, before)
        if buckets is not None:
            read.append((len(buckets), found.count()))
        return found

    monkeypatch.setattr(H.History, "_keys", counted)
    assert io.append_new(rows(spark, range(19_000, 20_000)), path) == 0     # all known: every one is found
    state = Manifest(spark, f"{path}/_keys").read()
    assert state["buckets"] >= 32
    read.clear()
    assert io.append_new(rows(spark, range(30_000, 30_200)), path) == 200   # none known
    assert sum(n for _, n in read) < 4_000                                  # filter errors only
    read.clear()
    assert io.append_new(rows(spark, [5, 6, 40_000]), path) == 1            # two known
    assert read[0][0] <= 3 and read[0][1] < 3 * 1_500


def test_what_a_broken_append_left_goes_with_the_next(spark, monkeypatch):
    path = tempfile.mkdtemp() + "/t"
    io.append_new(rows(spark, [1, 2]), path)
    ended = H.History.end_batch

    def broken(self, number, count):
        self._add(spark.createDataFrame([("x", number)], f"{io.MATCH} string, _batch long"))
        raise RuntimeError("lost")

    monkeypatch.setattr(H.History, "end_batch", broken)
    with pytest.raises(RuntimeError):
        io.append_new(rows(spark, [2, 3, 4]), path)
    monkeypatch.setattr(H.History, "end_batch", ended)
    assert io.append_new(rows(spark, [3, 5]), path) == 2
    assert titles(spark, path) == ["t1", "t2", "t3", "t5"]


def test_a_table_stored_without_keys_gets_them(spark):
    path = tempfile.mkdtemp() + "/t"
    io.with_match(rows(spark, range(50)), "url").write.parquet(f"{path}/_batch=0")
    assert io.append_new(rows(spark, range(40, 60)), path) == 10
    assert len(titles(spark, path)) == 60


def test_manifest_versions(spark):
    manifest = Manifest(spark, tempfile.mkdtemp())
    assert manifest.read() == {}
    for i in range(30):
        manifest.publish({"i": i})
    assert manifest.read() == {"i": 29}
    assert len(manifest._versions()) <= 21
