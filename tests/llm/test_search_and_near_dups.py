"""Exact search, flat-graph and Jaccard joins against brute force."""

import numpy as np
import pytest

from hirelens.llm import crf, flat_graph, ngram_jaccard, voronoi_knn
from hirelens.llm.components import components
from pyspark.sql import Observation
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>"


def clustered(n, seed, dim=8, centres=6, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    return [(int(i), [float(x) for x in (middle[i % centres] + spread * rng.normal(size=dim)).astype(np.float32)])
            for i in range(n)]


def brute_top(rows, k=5, every=7):
    vec = {i: np.floor(256 * np.asarray(v, np.float64)) for i, v in rows}
    out = set()
    for q in vec:
        if q % every == 0:
            best = sorted(((-int(vec[q] @ vec[x]), x) for x in vec if x != q))[:k]
            out |= {(q, r + 1, x, -s) for r, (s, x) in enumerate(best)}
    return out


@pytest.mark.parametrize("group,block", [(3, 17), (1000, 1000)])
def test_top_k_equals_brute_force(spark, group, block):
    rows = clustered(180, 1) + [(500 + i, [1.0] * 8) for i in range(9)]  # ties
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("extra"))
    got = voronoi_knn.top_k(df, F.col("vec_id") % 7 == 0, n_pivots=12, group_queries=group, block_rows=block)
    assert {tuple(r) for r in got.collect()} == brute_top(rows)


@pytest.mark.parametrize("pivots", [8, 300])
def test_top_k_of_a_query_id_that_stands_on_many_rows(spark, pivots):
    """Rows with the query's own id, however near, are none of its neighbours."""
    near = [30.0] + [0.0] * 7
    foreign = clustered(180, 1) + [(700 + i, [28.0 - i] + [1.0] * 7) for i in range(4)]
    rows = foreign + [(777, near)] * 90
    df = spark.createDataFrame(rows, SCHEMA)
    got = voronoi_knn.top_k(df, F.col("vec_id") == 777, n_pivots=pivots, group_queries=4).collect()
    want = sorted((-int(np.floor(256 * np.asarray(near)) @ np.floor(256 * np.asarray(v, np.float64))), i)
                  for i, v in foreign)[:5]
    assert {tuple(r) for r in got} == {(777, n + 1, i, -s) for n, (s, i) in enumerate(want)}


def test_top_k_edges(spark):
    bad = [(0, None), (7, [1.0, None]), (14, [float("nan"), 1.0]), (21, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    good = [(28, [1.0, 1.0]), (29, [2.0, 0.0]), (30, [0.5, 0.5])]
    q = F.col("vec_id") % 7 == 0
    got = voronoi_knn.top_k(spark.createDataFrame(bad + good, SCHEMA), q).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(28, 1, 29, 256 * 512), (28, 2, 30, 2 * 256 * 128)]
    assert voronoi_knn.top_k(spark.createDataFrame([], SCHEMA), q).count() == 0
    assert voronoi_knn.top_k(spark.createDataFrame(good[1:], SCHEMA), q).count() == 0
    twice = spark.createDataFrame([good[0], good[0], good[1]], SCHEMA)
    assert [tuple(r) for r in voronoi_knn.top_k(twice, q).collect()] == [(28, 1, 29, 256 * 512)]
    short = spark.createDataFrame([(28, [1.0, 1.0]), (29, [1.0])], SCHEMA)
    assert voronoi_knn.top_k(short, q).first()["score"] == 256 * 256


def test_more_pivots_replicate_fewer_rows(spark):
    df = spark.createDataFrame(clustered(900, 3, centres=30, spread=0.01), SCHEMA).cache()
    copies, results = [], []
    for pivots in (2, 60):
        sent = Observation()
        got = voronoi_knn.top_k(df, F.col("vec_id") % 3 == 0, n_pivots=pivots, group_queries=20, observation=sent)
        results.append({tuple(r) for r in got.collect()})
        copies.append(sent.get["copies"])
    assert results[0] == results[1] and copies[1] < copies[0] / 2


def test_pivots_grow_with_the_table_within_bounds():
    assert [voronoi_knn.pivots_for(n, 64) for n in (0, 4_096, 1_000_000, 10 ** 10)] == [64, 64, 1_000, 4_096]
    assert voronoi_knn.pivots_for(10 ** 10, 4_096) == 256 and voronoi_knn.pivots_for(10, 10 ** 7) == 1


def test_large_components_stay_whole_numbers():
    q, x = np.array([[2.0 ** 30, 1.0]]), np.array([[2.0 ** 30, 3.0], [-2.0 ** 40, 0.0]])
    assert voronoi_knn._products(q, x).tolist() == [[2 ** 60 + 3, -(1 << 63)]]


def brute_links(rows, least=0.95):
    ok = [(i, np.asarray(v, np.float64)) for i, v in rows
          if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: set() for i, _ in rows}
    for a, x in ok:
        for b, y in ok:
            if a != b and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[a].add(b)
    return links


def smallest(links):
    comp = {}
    for i in sorted(links, key=lambda x: (x is None, x)):
        stack = [i]
        while stack:
            x = stack.pop()
            if x not in comp:
                comp[x] = i
                stack += links[x]
    return comp


@pytest.mark.parametrize("shard,block", [(40, 30), (1024, 4096)])
def test_flat_graph_equals_brute_force(spark, shard, block):
    rows = clustered(150, 3, dim=16, centres=30, spread=0.12) + [(1000 + i, [1.0] * 16) for i in range(20)]
    links = brute_links(rows)
    comp = smallest(links)
    got = flat_graph.near_duplicates(spark.createDataFrame(rows, SCHEMA), shard=shard, block=block).collect()
    want = {(i, len(links[i]), comp[i], comp[i] == i) for i in links}
    found, true = sum(r["n_links"] for r in got), sum(len(x) for x in links.values())
    assert all(r["n_links"] <= len(links[r["vec_id"]]) for r in got) and found >= 0.95 * true
    if shard == 1024:
        assert {tuple(r) for r in got} == want


def test_flat_graph_edges(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (None, [1.0, 0.0]),
            (5, [1.0, 0.0]), (6, [2.0, 0.0]), (7, [1.0, 0.0]), (8, [0.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit(1)).withColumn("component_id", F.lit("x"))
    got = {r["vec_id"]: tuple(r)[1:] for r in flat_graph.near_duplicates(df).collect()}
    assert got == {1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (0, 4, True), None: (0, None, True),
                   5: (2, 5, True), 6: (2, 5, False), 7: (2, 5, False), 8: (0, 8, True)}
    assert flat_graph.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    one = flat_graph.near_duplicates(spark.createDataFrame([(9, [1.0])], SCHEMA)).collect()
    assert [tuple(r) for r in one] == [(9, 0, 9, True)]


def _reps(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id as id", "embedding as v")


def test_flat_graph_that_finds_nothing_is_made_good(spark, monkeypatch):
    """Whatever the graph misses at every overlap is compared exactly."""
    from hirelens.llm.common import spooled

    def blind(reps, *_):
        return spooled(reps.selectExpr("id as a", "id as b").limit(0), "links")

    monkeypatch.setattr(flat_graph, "_links", blind)
    rows = clustered(150, 3, dim=16, centres=30, spread=0.12)
    links = brute_links(rows)
    comp = smallest(links)
    got = flat_graph.near_duplicates(spark.createDataFrame(rows, SCHEMA), block=40).collect()
    assert {tuple(r) for r in got} == {(i, len(links[i]), comp[i], comp[i] == i) for i in links}


def test_audit_sees_small_groups_beside_a_large_one(spark, monkeypatch):
    rng = np.random.default_rng(2)
    hot = [1.0] * 16 + rng.normal(size=(300, 16)) * 0.02
    small = np.repeat(rng.normal(size=(30, 16)), 2, axis=0) + rng.normal(size=(60, 16)) * 0.01
    alone = rng.normal(size=(540, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([hot, small, alone]))]
    links = brute_links(rows)
    every = [(a, b) for a in links for b in links[a] if a < b]
    kind = "a long, b long"
    reps = _reps(spark, rows)
    assert flat_graph.audited_recall(reps, spark.createDataFrame(every, kind), 16, 0.95) == 1
    only_hot = spark.createDataFrame([p for p in every if p[1] < 300], kind)
    assert flat_graph.audited_recall(reps, only_hot, 16, 0.95) < 0.5
    # Where hardly any vector is linked, a sample can't tell.
    monkeypatch.setattr(flat_graph, "MOST_AUDITED", 256)
    assert flat_graph.audited_recall(_reps(spark, rows[360:]), only_hot, 16, 0.95) is None


def test_neighbours_come_nearest_first():
    x = flat_graph.unit(np.random.default_rng(1).normal(size=(50, 4)))
    row, at = np.repeat(np.arange(50), 49), np.concatenate([np.delete(np.arange(50), i) for i in range(50)])
    got = flat_graph.by_nearness(x, row, at).reshape(50, 49)
    assert all((np.diff(x[i] @ x[got[i]].T) <= 0).all() for i in range(50))


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    links = {x: set() for e in edges for x in e}
    for a, b in edges:
        links[a].add(b)
        links[b].add(a)
    got = components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"))
    assert dict(got.collect()) == smallest(links)


def shingles(text, n=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_jaccard(rows, percent=80):
    sets = {i: shingles(t) for i, t in rows}
    links = {i: set() for i in sets}
    for a in sets:
        for b in sets:
            if a != b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links[a].add(b)
    comp = smallest(links)
    return {(i, len(sets[i]), comp[i]) for i in sets}


def copies(seed, groups=12, each=9, words=60):
    """Groups of near copies around the threshold, with a passage that all share."""
    rng = np.random.default_rng(seed)
    shared = " ".join(f"s{i}" for i in range(12))
    rows = []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in rng.integers(0, 500, int(words * (1 + g % 3)))]
        for _ in range(each):
            text = list(base)
            for at in rng.integers(0, len(text), rng.integers(0, 4)):
                text[at] = f"x{rng.integers(0, 9)}"
            rows.append((len(rows), " ".join(text) + "\n" + shared))
    return rows


@pytest.mark.parametrize("block,leaders", [(4096, 4), (3, 1)])
def test_jaccard_equals_brute_force(spark, monkeypatch, block, leaders):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", block)
    monkeypatch.setattr(ngram_jaccard, "LEADERS", leaders)
    rows = copies(7)
    rows += [(len(rows) + i, t) for i, t in enumerate(
        ["a b", "A  b", "a b c", None, "", " \n\t", "Ünï cöde wörds hëre nöw", "ünï cöde wörds hëre nöw", "a b"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(3)).repartition(5)
    got = {tuple(r) for r in ngram_jaccard.join(df).collect()}
    assert got == brute_jaccard(rows)


def test_pairs_after_a_first_round_without_any(spark, monkeypatch):
    """Leaders that match nobody say nothing of the pairs among the others."""
    pairs = ngram_jaccard._pairs

    def blind(entries, percent, seed):
        out = pairs(entries, percent, seed)
        return out.limit(0) if seed else out

    monkeypatch.setattr(ngram_jaccard, "_pairs", blind)
    monkeypatch.setattr(ngram_jaccard, "LEADERS", 0)  # every list is too long for the leaders
    rows = copies(3, groups=3, each=4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in ngram_jaccard.join(df).collect()} == brute_jaccard(rows)


def test_jaccard_edges(spark):
    schema = "doc_id long, text string"
    assert ngram_jaccard.join(spark.createDataFrame([], schema)).count() == 0
    got = ngram_jaccard.join(spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, "z")], schema))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(None, 1, 4), (4, 1, 4), (4, 1, 4), (None, 1, None)], key=str)
    long = " ".join(f"w{i}" for i in range(40_000))
    got = ngram_jaccard.join(spark.createDataFrame([(1, long), (2, long + " end"), (3, "w1 " * 30)], schema))
    assert {tuple(r) for r in got.collect()} == {(1, 39_996, 1), (2, 39_997, 1), (3, 1, 3)}


def test_bit_map_keeps_what_was_put_in(spark):
    ids = spark.range(0, 5000, 7)
    bits = ngram_jaccard.bit_map(ids, "id")
    rows = spark.range(0, 5000).withColumn("x", F.lit("y"))
    on = {r["id"] for r in ngram_jaccard._on_map(rows, "id", bits).collect()}
    off = {r["id"] for r in ngram_jaccard._on_map(rows, "id", bits, wanted=False).collect()}
    assert set(range(0, 5000, 7)) <= on and len(on) < 800 and on | off == set(range(5000)) and not on & off


def test_word_hashes_depend_on_the_word_alone():
    data = b"aa bb aa cc\xc3\x89 bb aa"
    raw, member = np.frombuffer(data, np.uint8), None
    member = ngram_jaccard._IN_WORD[raw]
    start, end = crf.word_bounds(member, np.array([0, len(data)]))
    words = [data[a:b] for a, b in zip(start, end)]
    hashes = crf.hash_words(raw, start, end)
    assert words == data.split() and len(set(hashes.tolist())) == len(set(words))
    assert all((hashes[i] == hashes[j]) == (words[i] == words[j]) for i in range(6) for j in range(6))


def brute_rows(rows, least=0.95):
    """(id, n_links, component_id) of every row: rows with usable vectors are
    nodes, and link whatever their ids; equal vectors do, too."""
    x = np.asarray([v for _, v in rows], np.float64)
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, stack = {i}, [i]
        while stack:
            for j in np.flatnonzero(near[stack.pop()]).tolist():
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        out.append((vec_id, int(near[i].sum()), min(rows[j][0] for j in seen)))
    return sorted(out)


@pytest.mark.parametrize("shard,block", [(1024, 4096), (60, 25)])
def test_an_id_on_several_vectors(spark, shard, block):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(5, a), (5, b), (6, [1.0, 0.1, 0.0]), (7, [0.1, 1.0, 0.0]), (8, [0.0, 1.0, 0.1])]
    got = flat_graph.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r)[:3] for r in got) == brute_rows(rows)
    assert [r[1] for r in brute_rows(rows)] == [1, 2, 1, 2, 2]
    rows = [(i % 40, v) for i, v in clustered(160, 5, dim=8, centres=25, spread=0.05)] * 2
    got = flat_graph.near_duplicates(spark.createDataFrame(rows, SCHEMA), shard=shard, block=block).collect()
    assert sorted(tuple(r)[:3] for r in got) == brute_rows(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("same", [True, False])
def test_what_is_told_of_pairs(same):
    rng = np.random.default_rng(4)
    for _ in range(50):
        m, n = rng.integers(1, 12, 2)
        n = m if same else n
        hits = rng.random((m, n)) < 0.15
        if same:
            hits |= hits.T
            np.fill_diagonal(hits, False)
        left = rng.permutation(100)[:m]
        right = left if same else 100 + rng.permutation(100)[:n]
        lc = rng.integers(1, 5, m)
        rc = lc if same else rng.integers(1, 5, n)
        out = flat_graph.told(hits.copy(), left, right, lc, rc, same).to_pylist()
        pairs = {(min(x, y), max(x, y)) for x, y in ((left[i], right[j]) for i, j in zip(*np.nonzero(hits)))}
        links = {}
        for x, y in pairs:
            links.setdefault(x, set()).add(y)
            links.setdefault(y, set()).add(x)
        copies = dict(zip(left.tolist(), lc.tolist())) | dict(zip(right.tolist(), rc.tolist()))
        assert {(r["a"], r["n"], r["w"]) for r in out if r["b"] is None} == {
            (x, len(y), sum(copies[z] for z in y)) for x, y in links.items()}
        spanning = [(r["a"], r["b"]) for r in out if r["b"] is not None]
        assert set(spanning) <= pairs and len(spanning) < max(1, len(links))
        tree = {x: set() for x in links}
        for x, y in spanning:
            tree[x].add(y)
            tree[y].add(x)
        assert smallest(tree) == smallest(links)


def test_a_group_of_near_copies_is_told_by_few_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in [1.0] * 16 + rng.normal(size=16) * 0.02]) for i in range(900)]
    reps = spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id as id", "embedding as v", "1L as copies")
    links = flat_graph._links(reps, 16, 2, 0.95, 300, 400)
    counts = {r["id"]: r["n"] for r in flat_graph.counts_of(links, reps).collect()}
    assert np.mean([counts.get(i, 0) for i in range(900)]) > 0.95 * 899 and max(counts.values()) <= 899
    assert links.count() < 40 * 900
