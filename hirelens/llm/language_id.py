"""Language identification by word labels from a linear-chain CRF.

Every word of a text gets marginals over the learned languages; a text's
language is the one with the largest mean marginal, so passages in another
language count for what they are.

Every language of the training rows is learned, from a bounded sample
(``ROWS_PER_LANGUAGE`` rows of each, fewer where there are many languages,
chosen by a hash of the id, and ``CHAINS_PER_ROW`` evenly spaced chains of
each): the sample's size doesn't depend on the corpus.
Scoring reads every whole text once, where it lies, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm import crf
from hirelens.llm.common import CLASSIFIED_BYTES, text_slices

#: Bounds of the training sample.
ROWS_PER_LANGUAGE = 300
CHAINS_PER_ROW = 4
#: Beyond so many rows of all languages each gives fewer, down to ``LEAST_ROWS``.
MOST_ROWS, LEAST_ROWS = 9_600, 40
#: Languages up to which a slice of texts has its full size.
FULL_SLICE_LANGUAGES = 16

UNDETERMINED = "und"


def training_rows(id_col: str = "doc_id") -> Column:
    """Rows to learn from: crc32 of the id as text modulo 3 is not 1.  A null
    id has no remainder and isn't learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 3 != 1


def _chains(texts: list[str]) -> tuple[list[str], list[int]]:
    """Evenly spaced chains of words from each text, as texts again."""
    out, row = [], []
    for i, text in enumerate(texts):
        words = text.split()
        starts = range(0, max(len(words), 1), crf.CHAIN)
        for a in sorted({starts[j * (len(starts) - 1) // max(CHAINS_PER_ROW - 1, 1)] for j in range(CHAINS_PER_ROW)}):
            out.append(" ".join(words[a:a + crf.CHAIN])[:crf.CHAIN * 64])
            row.append(i)
    return out, row


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> crf.Model | None:
    """A model of the languages in the rows where ``learn`` holds, or None
    if there are none with a language and a text."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy(F.col(lang_col).alias("lang")).count().collect()}
    langs = sorted(counts)
    if not langs:
        return None
    most = min(ROWS_PER_LANGUAGE, max(LEAST_ROWS, MOST_ROWS // len(langs)))
    # Ids first, so that only the sample's texts travel; about twice as many as needed, by a threshold for each language.
    bars = docs.sparkSession.createDataFrame(
        [(lang, int(min(1.0, 2 * most / n) * 1_000_000) + 1) for lang, n in counts.items()], "_lang string, _bar int")
    key = F.pmod(F.xxhash64(id_col), F.lit(1_000_000))
    near = (rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), key.alias("key"))
            .join(F.broadcast(bars), F.col("lang") == F.col("_lang")).where("key < _bar").select("lang", "key", "id")
            .distinct().collect())
    ids: dict = {}
    for lang, at, i in sorted(tuple(r) for r in near):
        ids.setdefault(lang, []).append(i)
    chosen = {i for of in ids.values() for i in of[:most]}
    # One row for an id, however often it stands in the table.
    sample = (rows.where(F.col(id_col).isin(sorted(chosen))).groupBy(F.col(id_col).alias("id"))
              .agg(F.min(F.struct(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))).alias("one"))
              .select("one.lang", "one.text"))

    def cut(batches):
        for batch in batches:
            for part, _, _ in text_slices(batch):
                texts, row = _chains(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row, pa.int64())),
                                                  pa.array(texts, pa.string())], names=["lang", "text"])

    got = sorted((r["lang"], r["text"]) for r in sample.mapInArrow(cut, "lang string, text string").collect()
                 if r["lang"] in counts)
    data = [text.encode() for _, text in got]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    words = crf.words_in(np.frombuffer(b"".join(data), np.uint8), offsets)
    if not len(words.start):
        return None
    place = {lang: k for k, lang in enumerate(langs)}
    target = np.asarray([place[lang] for lang, _ in got])[words.doc]
    return crf.fit(langs, words, target)


def _slices(batch: pa.RecordBatch, model: crf.Model | None, column: str = "text"):
    """Slices of a batch, smaller where a word has many labels' marginals."""
    labels = max(FULL_SLICE_LANGUAGES, len(model.labels) if model else 0)
    return text_slices(batch, column, CLASSIFIED_BYTES * FULL_SLICE_LANGUAGES // labels)


def tag(model: crf.Model | None, texts: list[str | None], raw: np.ndarray,
        offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language and score of each text of a slice, and how surely its words
    are of some learned language each (their largest marginals' mean).  Of
    languages with equal scores the first in the order of their names."""
    n = len(offsets) - 1
    label, score, sure = [UNDETERMINED] * n, np.zeros(n), np.zeros(n)
    if model is None:
        return label, score, sure
    words = crf.words_in(raw, offsets)
    marginal = model.marginals(words)
    count = np.bincount(words.doc, minlength=n)
    mean = np.stack([np.bincount(words.doc, marginal[:, k], n) for k in range(len(model.labels))],
                    axis=1) / np.maximum(count, 1)[:, None]
    best = mean.argmax(axis=1)
    ascii_letter = np.zeros(n, bool)
    ascii_letter[words.doc[raw[words.start] < 0x80]] = True
    for i in np.flatnonzero(count):
        if ascii_letter[i] or any(c.isalpha() for c in texts[i]):
            label[i], score[i] = model.labels[best[i]], min(float(mean[i, best[i]]), 1.0)
    sure[:] = np.bincount(words.doc, marginal.max(axis=1), n) / np.maximum(count, 1)
    return label, score, sure


def identify(docs: DataFrame, model: crf.Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) per input row.

    A null text and one without a letter are ``und`` with score 0, and so is
    everything if there is no model.  Rows may repeat; a null id's remainder
    is unknown, so it isn't held out.  An empty table gives no rows; other
    columns, whatever their names, are not read.
    """
    rows = docs.select(docs[id_col].alias(id_col), docs[text_col].alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model and model.state())

    def run(batches):
        model = crf.Model.of(shared.value)
        for batch in batches:
            for part, raw, offsets in _slices(batch, model):
                label, score, _ = tag(model, part.column("text").to_pylist(), raw, offsets)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(label, pa.string()), pa.array(score)],
                                                 names=[id_col, "lang_pred", "score"])

    tagged = rows.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
    return tagged.select(id_col, held.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: crf.Model | None, min_sure: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that have a language and whose words
    are, in the mean, each of some learned language with at least ``min_sure``.
    A text that mixes languages evenly, so that none has a large share of it,
    stays: each of its words has one."""
    shared = docs.sparkSession.sparkContext.broadcast(model and model.state())

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = crf.Model.of(shared.value)
        for batch in batches:
            for part, raw, offsets in _slices(batch, model, text_col):
                label, _, sure = tag(model, part.column(text_col).to_pylist(), raw, offsets)
                keep = (np.asarray(label) != UNDETERMINED) & (sure >= min_sure)
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
