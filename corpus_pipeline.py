"""Corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's documents.

language_id        documents whose language is undetermined, or whose words
                   are not, in the mean, each of some learned language with
                   at least ``MIN_LANGUAGE``, go (mixed texts stay)
toxicity           documents that the classifier marks toxic go
ngram_jaccard      of documents linked at Jaccard 0.8 over five-word shingles
                   the one with the smallest id stays (of an id with several
                   texts, each is judged by itself)
best_fit_packing   what is left, packed into training sequences

All but the last return the columns of ``documents``; nulls, repeated ids,
empty tables and further columns pass through (rows with a null id can't be
named by a group and stay in the third stage).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hirelens.llm import language_id, ngram_jaccard, packing, toxicity
from hirelens.llm.common import small_batches, spooled, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Least mean of a document's words' largest language marginals.
MIN_LANGUAGE = 0.35


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = language_id.train(docs, language_id.training_rows())
    return language_id.keep_identified(docs, model, MIN_LANGUAGE)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.training_rows())
    return toxicity.keep_clean(docs, model)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_jaccard.without(docs, spooled(ngram_jaccard.surplus(docs), "gone"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified), ("toxicity", civil), ("ngram_jaccard", distinct_texts), ("best_fit_packing", packed)]

#: Classifiers and packing have no SQL form; the stages are tested against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spooled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
