"""CRF against enumeration, held-out accuracy, and the pipeline's stages."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirelens.llm import crf, language_id, toxicity
from hirelens.llm.common import table
from hirelens.llm.queries import LLM_ORACLES, LLM_QUERIES

from .test_search_and_near_dups import brute_jaccard

SF = "/root/testdata/sf0.01"
LABELLED = "/root/testdata/sf0.1"  # enough toxic documents to learn from
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    emission, move = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    chains = crf.chains_of(np.array([0, 0, 0, 0, 1, 2, 2, 2, 2]))
    got, both, log_z = crf.forward_backward(emission, chains, move, pairs=True)
    at, total_both, total_z = 0, np.zeros((3, 3)), 0.0
    for size in (4, 1, 4):
        e = emission[at:at + size]
        weight, marginal, pair = 0.0, np.zeros((size, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=size):
            w = np.exp(sum(e[i, y] for i, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            weight += w
            for i, y in enumerate(path):
                marginal[i, y] += w
            for a, b in zip(path, path[1:]):
                pair[a, b] += w
        assert np.allclose(got[at:at + size], marginal / weight)
        total_both += pair / weight
        total_z += np.log(weight / 3)
        at += size
    assert np.allclose(both, total_both) and np.isclose(log_z, total_z)


def test_words_end_with_their_text_and_fold_case():
    data = [b"Ab", b"ab \xc3\x89t\xc3\xa9", b"", b"12!"]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    words = crf.words_in(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert words.doc.tolist() == [0, 1, 1] and words.which[0] == words.which[1] and len(words.hashes) == 2
    other = crf.words_in(np.frombuffer("éTÉ".encode(), np.uint8), np.array([0, 5]))
    assert other.hashes[0] in words.hashes


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    got = LLM_QUERIES["op10_language_id"](spark, SF).withColumnRenamed("doc_id", "id")
    rows = docs.join(got, F.col("doc_id") == F.col("id")).select("id", "lang", "held_out", "lang_pred", "score").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)
    held = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert np.mean(held) >= 0.97 and all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    rows = [(i, "the word and of it", "en", "s", 1) for i in range(6)] + [
        (6, None, "en", "s", 1), (7, "", None, "s", 1), (8, "12 34 —…", "de", "s", 1), (None, "the word", "en", "s", 1),
        (9, "字", None, "s", 1)]
    docs = spark.createDataFrame(rows, DOC).withColumn("lang_pred", F.lit(1)).withColumn("score", F.lit("x"))
    model = language_id.train(docs, language_id.training_rows())
    got = [tuple(r) for r in language_id.identify(docs, model).collect()]
    by = {r[0]: r for r in got}
    assert by[6][2:] == by[7][2:] == by[8][2:] == ("und", 0.0) and by[0][2] == "en" and by[9][2] != "und"
    assert by[None][1] is False and by[None][2] == "en"
    assert language_id.train(docs.limit(0), language_id.training_rows()) is None
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0
    kept = language_id.keep_identified(docs, model, 0.35)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {0, 1, 2, 3, 4, 5, 9, None}


def test_every_labelled_language_is_learned(spark):
    """Forty languages with words of their own, one of them with most of the rows."""
    rng = np.random.default_rng(4)
    words = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for _ in range(40)]
    which = [k for k in range(40) for _ in range(14)] + [0] * 200
    rows = [(i, " ".join(rng.choice(words[k], 9)), f"l{k:02}", "s", 1) for i, k in enumerate(which)]
    docs = spark.createDataFrame(rows, DOC)
    model = language_id.train(docs, language_id.training_rows())
    assert model.labels == [f"l{k:02}" for k in range(40)]
    got = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang, _, _ in rows if got[i]["held_out"]]) == 1


def test_an_even_mix_of_languages_is_kept(spark):
    """No language has a large share of such a text, but each of its words has one."""
    words = {lang: [f"{stem}{end}" for stem in stems for end in ends] for lang, stems, ends in (
        ("xa", ["bor", "kel", "tum"], ["ano", "elo", "ino"]), ("xb", ["schr", "wiz", "pfl"], ["ung", "eit", "acht"]),
        ("xc", ["thu", "gwy", "llan"], ["dd", "wyn", "och"]), ("xd", ["ouv", "beau", "ciel"], ["eux", "oir", "ette"]))}
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(words[lang], 40)), lang, "s", 1) for i, lang in enumerate(list(words) * 60)]
    docs = spark.createDataFrame(rows, DOC)
    model = language_id.train(docs, language_id.training_rows())
    mixed = [(900 + k, " ".join(rng.permutation(np.concatenate([rng.choice(words[x], 20) for x in langs]))), None, "s", 1)
             for k, langs in enumerate((("xa", "xb", "xc"), ("xb", "xc", "xd"), ("xa", "xb", "xc", "xd")))]
    some = spark.createDataFrame(mixed + [(990, "12 34 !", None, "s", 1), (991, None, None, "s", 1)], DOC)
    scores = [r["score"] for r in language_id.identify(some, model).where("doc_id < 950").collect()]
    assert min(scores) < 0.35
    import corpus_pipeline
    kept = language_id.keep_identified(some, model, corpus_pipeline.MIN_LANGUAGE)
    assert sorted(r["doc_id"] for r in kept.collect()) == [900, 901, 902]


def test_toxicity_held_out_and_blind_to_other_columns(spark):
    docs, labels = table(spark, LABELLED, "documents"), table(spark, LABELLED, "labels")
    model = toxicity.train(docs, labels, toxicity.training_rows())
    scored = toxicity.score(docs, model).cache()
    rows = scored.join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) >= 0.95
    assert np.mean([r["predicted"] for r in held if r["toxic"]]) >= 0.8
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) for r in rows)
    # A score depends on the text alone.
    other = docs.select((F.col("doc_id") + 10 ** 9).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    again = toxicity.score(other, model).select((F.col("doc_id") - 10 ** 9).alias("doc_id"), "score")
    assert again.exceptAll(scored.select("doc_id", "score")).count() == 0
    worst = scored.where("predicted = 1").join(docs, "doc_id").first()
    assert worst["spans"] and all(worst["text"][s["start"]:s["end"]].isalpha() for s in worst["spans"])


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 1), (2, "", "en", "s", 1), (None, "x", "en", "s", 1)], DOC)
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, labels, toxicity.training_rows()) is None
    assert toxicity.train(docs.limit(0), labels.limit(0), toxicity.training_rows()) is None
    assert [r["score"] for r in toxicity.score(docs, None).collect()] == [0.0] * 3
    text = [(i, f"some plain words here {'vile' if i % 2 else 'nice'} number{i % 7}x", "en", "s", 1) for i in range(80)]
    data = spark.createDataFrame(text + [(200, None, "en", "s", 1), (201, "", "en", "s", 1)], DOC)
    flags = spark.createDataFrame([(i, 1, i % 2) for i in range(80)] + [(3, 1, 0)], labels.schema)
    model = toxicity.train(data, flags, toxicity.training_rows())
    got = {r["doc_id"]: r for r in toxicity.score(data, model).collect()}
    assert all(got[i]["predicted"] == i % 2 for i in range(80)) and got[200]["predicted"] == got[201]["predicted"] == 0
    assert {r["doc_id"] for r in toxicity.keep_clean(data, model).collect()} == {*range(0, 80, 2), 200, 201}


def test_toxicity_is_learned_from_long_texts(spark):
    """All labelled texts are long; the toxic word stands somewhere in them, in few of their windows."""
    rng = np.random.default_rng(8)
    plain = ["river", "stone", "walking", "evening", "market", "garden", "winter", "letter", "window", "music"]

    def text(i, toxic):
        words = [plain[k] for k in rng.integers(0, 10, 1_800)]
        for at in rng.integers(0, 1_800, 3) if toxic else ():
            words[at] = "vilest"
        return " ".join(words)

    rows = [(i, text(i, i % 2), "en", "s", 1) for i in range(119)]
    assert min(len(r[1]) for r in rows) > toxicity.SAMPLE_CHARS
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(119)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, toxicity.training_rows())
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model, spans=False).collect()}
    assert np.mean([got[i] == i % 2 for i in range(119)]) >= 0.97


def test_excerpts_are_windows_from_all_over_the_text():
    text = " ".join(f"word{i}" for i in range(5_000)) + " strangest"
    some = toxicity.excerpt(text, None)
    assert len(some) <= toxicity.SAMPLE_CHARS + 10 and some.startswith("word0 ") and some.endswith("strangest")
    known = np.unique(toxicity._words([text[:-10]]).hashes)
    assert "strangest" in toxicity.excerpt(text + " word1" * 3_000, known)
    assert toxicity.excerpt("short", known) == "short" and len(toxicity.excerpt("x" * 50_000, None)) > 5_000


def test_features_are_counted_over_all_labelled_rows(spark):
    rows = [(i, f"common words of {'evil' if i % 3 == 0 else 'good'} people" + " x" * (i % 5)) for i in range(90)]
    texts = spark.createDataFrame(rows + [(0, "evil evil")], "id long, text string").repartition(4)
    known = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(80)], "id long, toxic int")
    words = toxicity._words(["evil", "common", "nowhere"])
    names = np.sort(words.hashes)
    bad, good, n_bad, n_good = toxicity._counted(texts, known, names)
    at = {w: int(np.searchsorted(names, toxicity._words([w]).hashes[0])) for w in ("evil", "common", "nowhere")}
    assert (n_bad, n_good) == (28, 53)
    assert [(int(bad[at[w]]), int(good[at[w]])) for w in at] == [(28, 0), (27, 53), (0, 0)]


def test_pipeline_stages(spark):
    """Each stage against what its operator says of its own input, the near-duplicate stage against brute force."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "ngram_jaccard", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name == "best_fit_packing":
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()}
            break
        assert out.columns == docs.columns
        rows, kept = {r["doc_id"]: r for r in docs.collect()}, {r["doc_id"]: r for r in out.collect()}
        assert all(rows[i] == kept[i] for i in kept)
        if name == "language_id":
            assert len(kept) == len(rows)
        if name == "ngram_jaccard":
            assert set(kept) == {c for _, _, c in brute_jaccard([(i, r["text"]) for i, r in rows.items()])}
            assert len(kept) < len(rows)
        docs = spark.createDataFrame(list(kept.values()), docs.schema)


def test_pipeline_stages_on_odd_rows(spark):
    long = "the word and of it " * 9 + "end"
    rows = [(1, long, "en", "s", 1), (1, long, "en", "s", 1), (2, long + " more", "en", "s", 1), (None, long, "en", "s", 1),
            (4, None, "en", "s", 1), (5, "", "en", "s", 1), (6, "to be or not", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOC).withColumn("node", F.lit("extra"))
    for data in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, data, SF)
            ids = [r["doc_id"] for r in out.collect()]
            if data is docs and name == "ngram_jaccard":
                assert sorted(ids, key=str) == [1, 4, 5, 6, None]
            if data is docs and name == "language_id":
                assert 4 not in ids and 5 not in ids and 6 in ids


def test_near_copies_go_by_text_not_by_id(spark):
    """Ids on several rows: other texts under the id of a copy stay, copies under one id go."""
    base = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    rows = [(1, base[0], "en", "s", 1),
            (2, base[0] + " more", "en", "s", 1), (2, base[1], "en", "s", 1), (2, base[1].upper(), "en", "s", 1),
            (3, base[2], "en", "s", 1), (3, base[2] + " end", "en", "s", 1), (3, "", "en", "s", 1),
            (3, None, "en", "s", 1), (3, None, "en", "s", 1), (None, base[0], "en", "s", 1), (4, base[3], "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOC)
    got = corpus_pipeline.distinct_texts(spark, docs, SF)
    assert got.columns == docs.columns
    kept = [(r["doc_id"], ("x" if r["text"] is None else r["text"])[:2].lower()) for r in got.collect()]
    assert sorted(kept, key=str) == sorted(
        [(1, "a0"), (2, "b0"), (3, "c0"), (3, ""), (3, "x"), (None, "a0"), (4, "d0")], key=str)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_oracle(spark, duck, name):
    from hirelens.checking import same_result

    df = LLM_QUERIES[name](spark, "/root/testdata/sf0.001")
    cur = duck("/root/testdata/sf0.001").execute(LLM_ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert same_result([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), cols)


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
