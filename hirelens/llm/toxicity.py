"""Toxic spans and document scores from a linear-chain CRF.

Labels are per document, the CRF needs them per word.  Words of toxic
training documents are labelled by their features: a word or 5-gram that
occurs in enough distinct toxic documents of the sample and in (almost) no
clean one marks its words as toxic; near copies count once, so that what
merely fills a copied document marks nothing.  The sample proposes such
features; whether they keep to toxic documents is counted in Spark over the
whole texts of all labelled training rows.  What marks are missing is
found by coverage: while toxic documents have no marked word, the feature
that most of them share is added.  The CRF then learns affix, n-gram and
word weights and transitions from these labelled words.

A document's score comes from its words' forward-backward marginals: a
logistic curve of the largest marginal's log-odds and all words' joint
evidence, fitted to the sampled documents' whole texts.
Words whose marginal is at least one half are the offending spans.

The sample is bounded: ``TOXIC_ROWS`` and ``CLEAN_ROWS`` rows.  Of a text above
``SAMPLE_CHARS`` characters it has windows from all over the text, so many as
come to that length, of toxic texts those with the most words that the clean
sample doesn't have.  Scoring reads every whole text in place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm import crf
from hirelens.llm.common import CLASSIFIED_BYTES, sampled, text_slices

#: Bounds of the training sample: rows of either label, characters of a text, and of a window of a longer one.
TOXIC_ROWS, CLEAN_ROWS, SAMPLE_CHARS, WINDOW_CHARS = 1_000, 1_800, 6_000, 1_000
#: Chains that the CRF is fitted to: of each toxic document with marked words, and of each clean one (with
#: marked words first, so that words which are only mostly toxic are learned as such).
TOXIC_CHAINS, CLEAN_CHAINS = 3, 2
#: A marking feature: least toxic documents (number, share), and its share of clean ones against that of toxic ones.
MIN_TOXIC, MIN_SHARE, MAX_CLEAN = 4, 0.02, 0.01
#: Least documents that a feature added for coverage has to explain.
MIN_COVERED = 3


def training_rows(id_col: str = "doc_id") -> Column:
    """Rows to learn from: crc32 of the id as text modulo 5 is not 0."""
    return F.crc32(F.col(id_col).cast("string")) % 5 != 0


def _originals(words: crf.Words, n: int) -> np.ndarray:
    """Documents that are no near copies of earlier ones: those that share
    none of four least hashes of three consecutive words with one."""
    out = np.ones(n, bool)
    if len(words.doc) < 3:
        return out
    h = words.hashes[words.which]
    three = crf.mixed(h[:-2] + crf.mixed(h[1:-1] + crf.mixed(h[2:])))
    inside = words.doc[:-2] == words.doc[2:]
    three, doc = three[inside], words.doc[:-2][inside]
    has = np.unique(doc)
    first = np.searchsorted(doc, has)
    for seed in range(1, 5):
        least = np.minimum.reduceat(crf.mixed(three + np.uint64(seed)), first) if len(has) else first
        new = np.zeros(len(has), bool)
        new[np.unique(least, return_index=True)[1]] = True
        out[has[~new]] = False
    return out


def _word_features(words: crf.Words) -> tuple[np.ndarray, np.ndarray]:
    """(distinct word, feature hash): each word itself and its 5-grams."""
    owner, feature = [np.arange(len(words.hashes))], [words.hashes]
    for w, h in crf.grams(words.lower, words.w_start, words.w_end, (5,)):
        owner.append(w)
        feature.append(h)
    return np.concatenate(owner), np.concatenate(feature)


def _marks(words: crf.Words, toxic: np.ndarray, count) -> np.ndarray:
    """Which distinct words are toxic, from the documents' labels.  ``count``
    tells of some features in how many labelled rows of either label they
    stand, and how many such rows there are."""
    n_words = len(words.hashes)
    pair = np.unique(words.doc.astype(np.int64) * n_words + words.which)
    doc, word = pair // n_words, pair % n_words
    one = _originals(words, len(toxic))
    keep = one[doc]
    doc, word = doc[keep], word[keep]

    owner, feature = _word_features(words)
    names, feature = np.unique(feature, return_inverse=True)
    order = np.argsort(owner, kind="stable")
    owner, feature = owner[order], feature[order]
    begin = np.searchsorted(owner, np.arange(n_words + 1))

    def pairs():
        """(document, feature) pairs, some documents at a time."""
        edge = np.searchsorted(doc, np.arange(0, len(toxic) + 256, 256))
        for lo, hi in zip(edge[:-1], edge[1:]):
            d, w = doc[lo:hi], word[lo:hi]
            size = begin[w + 1] - begin[w]
            at = np.repeat(begin[w] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            both = np.unique(np.repeat(d, size) * len(names) + feature[at])
            yield both // len(names), both % len(names)

    # In how many documents of each label a feature stands.
    bad, good = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    for p_doc, p_feature in pairs():
        bad += np.bincount(p_feature[toxic[p_doc]], minlength=len(names))
        good += np.bincount(p_feature[~toxic[p_doc]], minlength=len(names))
    n_bad, n_good = int((toxic & one).sum()), int((~toxic & one).sum())
    clean = good / max(n_good, 1) <= MAX_CLEAN * bad / max(n_bad, 1)
    asked = np.flatnonzero(clean & (bad >= MIN_COVERED))
    all_bad, all_good, rows_bad, rows_good = count(names[asked])
    clean[asked] = all_good / max(rows_good, 1) <= MAX_CLEAN * all_bad / max(rows_bad, 1)
    marked = clean & (bad >= max(MIN_TOXIC, MIN_SHARE * n_bad))

    # Coverage of the toxic documents that have no marked feature yet.
    held = []
    for p_doc, p_feature in pairs():
        use = clean[p_feature] & toxic[p_doc] & (bad[p_feature] >= MIN_COVERED)
        held.append((p_doc[use], p_feature[use]))
    p_doc, p_feature = (np.concatenate(c) for c in zip(*held))
    while True:
        covered = np.zeros(len(toxic), bool)
        covered[p_doc[marked[p_feature]]] = True
        left = ~covered[p_doc]
        if not left.any():
            break
        gain = np.bincount(p_feature[left], minlength=len(names))
        best = int(gain.argmax())
        if gain[best] < MIN_COVERED:
            break
        marked[best] = True
    return np.bincount(owner[marked[feature]], minlength=n_words) > 0


def _words(texts: list[str]) -> crf.Words:
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    return crf.words_in(np.frombuffer(b"".join(data), np.uint8), offsets)


def _chosen_chains(words: crf.Words, toxic: np.ndarray, marked_word: np.ndarray) -> np.ndarray:
    """Words of the chains to fit to: of toxic documents chains with marked
    words, of clean ones evenly spaced chains."""
    row = crf.chains_of(words.doc).row
    doc = words.doc[np.unique(row, return_index=True)[1]]  # of each chain
    marked = np.bincount(row, marked_word, len(doc)) > 0
    some = np.zeros(len(toxic), bool)
    some[doc[marked]] = True
    at = np.flatnonzero(np.where(toxic[doc] | some[doc], marked, True))
    first = np.ones(len(at), bool)
    first[1:] = doc[at][1:] != doc[at][:-1]
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, len(at)))
    place = np.arange(len(at)) - np.repeat(begin, size)
    most = np.where(toxic[doc[at]], TOXIC_CHAINS, CLEAN_CHAINS)
    stride = np.maximum(1, -(-np.repeat(size, size) // most))
    keep = np.zeros(len(doc), bool)
    keep[at[place % stride == 0]] = True
    return np.flatnonzero(keep[row])


def _evidence(marginal: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per document the log-odds of its largest toxic marginal, and the log of
    all its words' joint evidence; without words the least of both."""
    worst = np.full(n, 1e-7)
    np.maximum.at(worst, doc, marginal)
    worst = np.minimum(worst, 1 - 1e-7)
    joint = np.bincount(doc, -np.log1p(-np.minimum(marginal, 1 - 1e-7)), n)
    return np.stack([np.log(worst / (1 - worst)), np.log(joint + 1e-7)], axis=1)


def _curve(evidence: np.ndarray, weights: tuple) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(evidence @ np.asarray(weights[:-1]) + weights[-1], -30, 30)))


def _fitted_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the evidence and a constant, by Newton steps that lower the
    logistic loss, with a weak pull to the start."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    start = np.array([0.5, 0.5, 0.0])

    def loss(w):
        z = x1 @ w
        return float((np.logaddexp(0, z) - y * z).sum() + ((w - start) ** 2).sum() / 2)

    w = start
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + np.eye(3), x1.T @ (p - y) + w - start)
        size = next((s for s in 0.5 ** np.arange(12) if loss(w - s * step) < loss(w)), 0.0)
        if not size:
            break
        w = w - size * step
    return w


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> crf.Model | None:
    """A model from the rows where ``learn`` holds that have a label, or None
    if either label is missing.  Several labels of one id: the largest."""
    flags = (labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic")))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = flags.where("toxic in (0, 1)").join(texts.select("id").distinct(), "id", "left_semi")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    ids = {label: [r["id"] for r in sampled(known.where(F.col("toxic") == label), "id", counts[label], most).collect()]
           for label, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))}
    clean = _excerpts(texts, ids[0], None)
    got = sorted({(t, False) for t in clean} | {(t, True) for t in _excerpts(
        texts, ids[1], np.unique(_words(clean).hashes))})
    toxic = np.asarray([t for _, t in got])
    words = _words([t for t, _ in got])
    if not len(words.start):
        return None
    marked = _marks(words, toxic, lambda names: _counted(texts, known, names))[words.which]
    target = (marked & toxic[words.doc]).astype(np.int64)
    chosen = _chosen_chains(words, toxic, marked)
    part = replace(words, start=words.start[chosen], end=words.end[chosen], which=words.which[chosen],
                   doc=crf.chains_of(words.doc).row[chosen])
    model = crf.fit(["clean", "toxic"], part, target[chosen])

    x, y = _sample_evidence(texts, ids, model)
    model.extra = tuple(float(v) for v in _fitted_curve(x, y))
    return model


def _whole(texts: DataFrame, ids: list) -> DataFrame:
    """One text of each id (a bounded list): the least, where an id has several."""
    return texts.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("text").alias("text"))


def excerpt(text: str, known: np.ndarray | None) -> str:
    """A text of at most ``SAMPLE_CHARS`` characters, or windows of it that
    come to that: evenly spaced, or those with most words beside ``known``."""
    if len(text) <= SAMPLE_CHARS:
        return text
    cuts = [0]
    while cuts[-1] < len(text):  # at the last blank of a window's length, if it has one
        end = cuts[-1] + WINDOW_CHARS
        blank = max(text.rfind(" ", cuts[-1], end), text.rfind("\n", cuts[-1], end)) + 1
        cuts.append(min(len(text), blank or end) if end < len(text) else len(text))
    windows = [text[a:b] for a, b in zip(cuts, cuts[1:])]
    most = SAMPLE_CHARS // WINDOW_CHARS
    order = np.linspace(0, len(windows) - 1, most).astype(int)
    if known is not None:
        words = _words(windows)
        strange = np.bincount(words.doc, ~np.isin(words.hashes, known)[words.which], len(windows))
        order = np.argsort(-strange, kind="stable")[:most]
    return "\n".join(windows[i] for i in np.unique(order))


def _excerpts(texts: DataFrame, ids: list, known: np.ndarray | None) -> list[str]:
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            got = [excerpt(t, shared.value) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.string())], names=["text"])

    return sorted({r["text"] for r in _whole(texts, ids).mapInArrow(run, "text string").collect()})


def _counted(texts: DataFrame, known: DataFrame, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Toxic and clean labelled rows that each feature (of sorted ``names``,
    which the bounded sample proposed) stands in, and all such rows.  Texts are
    read where they are; only (id, feature) pairs meet the labels."""
    kind = texts.schema["id"].dataType.simpleString()
    sums = [F.sum("toxic").cast("long").alias("bad"), F.sum(1 - F.col("toxic")).cast("long").alias("good")]
    rows = texts.select("id").join(known, "id").agg(*sums).first()
    if not len(names):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), rows["bad"] or 0, rows["good"] or 0
    shared = texts.sparkSession.sparkContext.broadcast(names)

    def run(batches):
        names = shared.value
        for batch in batches:
            for part, raw, offsets in text_slices(batch, most=CLASSIFIED_BYTES):
                words = crf.words_in(raw, offsets)
                owner, feature = _word_features(words)
                at = np.minimum(np.searchsorted(names, feature), len(names) - 1)
                here = names[at] == feature
                order = np.argsort(owner[here], kind="stable")
                owner, at = owner[here][order], at[here][order]
                begin = np.searchsorted(owner, np.arange(len(words.hashes) + 1))
                size = np.diff(begin)
                of = np.flatnonzero(size[words.which])  # words with a feature that is asked for
                doc, word = words.doc[of], words.which[of]
                n = size[word]
                place = np.repeat(begin[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.unique(np.repeat(doc.astype(np.int64), n) * len(names) + at[place])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(both // len(names))), pa.array(both % len(names))],
                    names=["id", "name"])

    found = texts.mapInArrow(run, f"id {kind}, name bigint").join(known, "id").groupBy("name").agg(*sums)
    bad, good = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    for r in found.collect():  # a row for each name asked for, at most
        bad[r["name"]], good[r["name"]] = r["bad"], r["good"]
    return bad, good, rows["bad"] or 0, rows["good"] or 0


def _sample_evidence(texts: DataFrame, ids: dict[int, list], model: crf.Model) -> tuple[np.ndarray, np.ndarray]:
    """Evidence of the sampled documents' whole texts, and their labels."""
    shared = texts.sparkSession.sparkContext.broadcast(model.state())
    toxic = set(ids[1])

    def run(batches):
        model = crf.Model.of(shared.value)
        for batch in batches:
            for part, raw, offsets in text_slices(batch, most=CLASSIFIED_BYTES):
                words = crf.words_in(raw, offsets)
                x = _evidence(model.marginals(words)[:, 1], words.doc, part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(x[:, 0]), pa.array(x[:, 1])],
                                                 names=["id", "worst", "joint"])

    whole = _whole(texts, ids[0] + ids[1])
    got = whole.mapInArrow(run, f"id {whole.schema['id'].dataType.simpleString()}, worst double, joint double").collect()
    got = sorted(got, key=lambda r: str(r["id"]))
    return (np.asarray([(r["worst"], r["joint"]) for r in got]), np.asarray([float(r["id"] in toxic) for r in got]))


def tag(model: crf.Model | None, raw: np.ndarray, offsets: np.ndarray, spans: bool = False):
    """Score of each text of a slice, and with ``spans`` its toxic words as
    (start, end) in code points."""
    n = len(offsets) - 1
    if model is None:
        return np.zeros(n), [[] for _ in range(n)] if spans else None
    words = crf.words_in(raw, offsets)
    marginal = model.marginals(words)[:, 1]
    score = _curve(_evidence(marginal, words.doc, n), model.extra)
    if not spans:
        return score, None
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    found: list[list[dict[str, int]]] = [[] for _ in range(n)]
    for i in np.flatnonzero(marginal >= 0.5):
        d = words.doc[i]
        zero = points[offsets[d]]
        found[d].append({"start": int(points[words.start[i]] - zero), "end": int(points[words.end[i]] - zero)})
    return score, found


def score(docs: DataFrame, model: crf.Model | None, id_col: str = "doc_id", text_col: str = "text",
          spans: bool = True) -> DataFrame:
    """(id, held_out, score, predicted and, if asked for, spans) per input row.

    Null and empty texts have the least score and no spans; without a model
    every score is 0.  Rows may repeat; a null id isn't held out (it has no
    remainder, nor a label).  An empty table gives no rows; other columns,
    whatever their names, are not read.  A score of exactly one half is toxic.
    """
    rows = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model and model.state())
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        model = crf.Model.of(shared.value)
        for batch in batches:
            for part, raw, offsets in text_slices(batch, most=CLASSIFIED_BYTES):
                value, found = tag(model, raw, offsets, spans)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(value), pa.array((value >= 0.5).astype(np.int32)),
                     *([pa.array(found, span)] if spans else ())], names=[id_col, "score", "predicted", *more])

    more = ["spans"] if spans else []
    tagged = rows.mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int"
                             + (", spans array<struct<start:bigint,end:bigint>>" if spans else ""))
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))
    return tagged.select(id_col, held.alias("held_out"), "score", "predicted", *more)


def keep_clean(docs: DataFrame, model: crf.Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model and model.state())

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = crf.Model.of(shared.value)
        for batch in batches:
            for part, raw, offsets in text_slices(batch, text_col, CLASSIFIED_BYTES):
                yield part.filter(pa.array(tag(model, raw, offsets)[0] < 0.5))

    return docs.mapInArrow(run, docs.schema)
