"""Checked queries for page parsing, dedupe and run quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens.operators.dedupe import dedupe_cross_batch, dedupe_strict
from hirelens.operators.quality import (null_profile, quality_gate, raw_statistics, run_report,
                                        salary_outliers, salary_quartiles, stats_json)
from hirelens.sources.bindings import AS_OF, article_cards, html_pages, raw_jobs, star, url_batches
from hirelens.sources.html_cards import job_cards, page_triage, valid_cards
from hirelens.sources.tables import Tables

SCRAPED_AT = AS_OF.replace(" ", "T")


def _cards(spark, sf_dir):
    return job_cards(html_pages(Tables(spark, sf_dir)), scraped_at=SCRAPED_AT)


def _flat(cards):
    return cards.select("page_id", "pos", "title", "url", "company", "location", "salary",
                        F.array_join("skills", ",").alias("skills"), "scraped_at")


def job_cards_q(spark, sf_dir):
    return _flat(_cards(spark, sf_dir))


def valid_cards_q(spark, sf_dir):
    return _flat(valid_cards(_cards(spark, sf_dir)))


def page_triage_q(spark, sf_dir):
    return page_triage(Tables(spark, sf_dir)("pages"))


def page_cards_q(spark, sf_dir):
    """The driver's own saved pages, whole, each article as a card."""
    cards = job_cards(article_cards(Tables(spark, sf_dir)("pages")), scraped_at=SCRAPED_AT)
    return cards.select("page_id", "pos", "title", "url", "company", "parse_error")


def dedupe_cross_batch_q(spark, sf_dir):
    return dedupe_cross_batch(url_batches(Tables(spark, sf_dir)))


def dedupe_strict_q(spark, sf_dir):
    return dedupe_strict(url_batches(Tables(spark, sf_dir)))


def raw_statistics_q(spark, sf_dir):
    return raw_statistics(raw_jobs(Tables(spark, sf_dir)), SCRAPED_AT)


def stats_json_q(spark, sf_dir):
    return stats_json(raw_statistics(raw_jobs(Tables(spark, sf_dir)), SCRAPED_AT))


def quality_gate_q(spark, sf_dir):
    return quality_gate(raw_statistics(raw_jobs(Tables(spark, sf_dir)), SCRAPED_AT))


def run_report_q(spark, sf_dir):
    return run_report(raw_statistics(raw_jobs(Tables(spark, sf_dir)), SCRAPED_AT), AS_OF)


def null_profile_q(spark, sf_dir):
    return null_profile(star(Tables(spark, sf_dir)).fact_jobs)


def salary_quartiles_q(spark, sf_dir):
    return salary_quartiles(star(Tables(spark, sf_dir)).fact_jobs)


def salary_outliers_q(spark, sf_dir):
    return salary_outliers(star(Tables(spark, sf_dir)).fact_jobs)


INGEST_QUERIES = {
    "job_cards": job_cards_q,
    "valid_cards": valid_cards_q,
    "page_triage": page_triage_q,
    "page_cards": page_cards_q,
    "dedupe_cross_batch": dedupe_cross_batch_q,
    "dedupe_strict": dedupe_strict_q,
    "raw_statistics": raw_statistics_q,
    "stats_json": stats_json_q,
    "quality_gate": quality_gate_q,
    "run_report": run_report_q,
    "null_profile": null_profile_q,
    "salary_quartiles": salary_quartiles_q,
    "salary_outliers": salary_outliers_q,
}
