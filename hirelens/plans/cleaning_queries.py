"""Checked queries for the cleaning operators, over the raw-postings binding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.salary import normalize_salary
from hirelens.functions.skills import extract_skills, job_skill_sets
from hirelens.functions.text import clean_text
from hirelens.operators.cleaning import add_metadata, process
from hirelens.operators.warehouse import normalize_url_col
from hirelens.sources.bindings import AS_OF, raw_jobs, skilled_documents
from hirelens.sources.tables import Tables

PROCESSED_AT = AS_OF.replace(" ", "T")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_jobs(Tables(spark, sf_dir))


def clean_text_q(spark, sf_dir):
    return clean_text(_raw(spark, sf_dir), "title", "company").select("job_id", "title", "company")


def normalize_salary_q(spark, sf_dir):
    return normalize_salary(_raw(spark, sf_dir), drop=False).select(
        "job_id", "salary", "salary_min", "salary_max")


def normalize_salary_strict_q(spark, sf_dir):
    return normalize_salary(_raw(spark, sf_dir), strip_thousands=True, drop=False).select(
        "job_id", "salary", "salary_min", "salary_max")


def skills_compat_q(spark, sf_dir):
    return extract_skills(_raw(spark, sf_dir), mode="compat").select("job_id", "skill")


def skills_bounded_q(spark, sf_dir):
    return extract_skills(_raw(spark, sf_dir), mode="bounded").select("job_id", "skill")


def skills_exploded_outer_q(spark, sf_dir):
    return extract_skills(_raw(spark, sf_dir), mode="bounded", keep_empty=True).select("job_id", "skill")


def job_skill_sets_q(spark, sf_dir):
    """Every job, those without a skill with an empty list."""
    sets = job_skill_sets(_raw(spark, sf_dir))
    return sets.select("job_id", F.array_join("skills", ",").alias("skills"), "skill_count")


def _documents(spark, sf_dir):
    """The driver's documents as long job texts."""
    return Tables(spark, sf_dir)("documents").select("doc_id", "text")


def document_clean_text_q(spark, sf_dir):
    return clean_text(_documents(spark, sf_dir), "text")


def document_skills_bounded_q(spark, sf_dir):
    """Long texts that name skills at their start and end."""
    docs = skilled_documents(Tables(spark, sf_dir))
    return extract_skills(docs, text_col="text", mode="bounded").select("doc_id", "skill")


def document_skill_sets_q(spark, sf_dir):
    sets = job_skill_sets(_documents(spark, sf_dir), text_col="text")
    return sets.select("doc_id", F.array_join("skills", ",").alias("skills"), "skill_count")


def add_metadata_q(spark, sf_dir):
    parsed = normalize_salary(_raw(spark, sf_dir), drop=False)
    return add_metadata(parsed, PROCESSED_AT, score="completeness").select(
        "job_id", "processed_at", "data_quality_score")


def processed_postings_q(spark, sf_dir):
    return process(_raw(spark, sf_dir), PROCESSED_AT).select(
        "job_id", "title", "company", "location", "url", "scraped_at", "salary_min", "salary_max",
        "processed_at", "data_quality_score")


def normalize_url_q(spark, sf_dir):
    """Relative posting urls get the site base; "N/A", "" and NULL stay."""
    raw = _raw(spark, sf_dir)
    return raw.select("job_id", "url", normalize_url_col(F.col("url")).alias("job_url"))


CLEANING_QUERIES = {
    "normalize_url": normalize_url_q,
    "clean_text": clean_text_q,
    "normalize_salary": normalize_salary_q,
    "normalize_salary_strict": normalize_salary_strict_q,
    "skills_compat": skills_compat_q,
    "skills_bounded": skills_bounded_q,
    "skills_exploded_outer": skills_exploded_outer_q,
    "job_skill_sets": job_skill_sets_q,
    "document_clean_text": document_clean_text_q,
    "document_skills_bounded": document_skills_bounded_q,
    "document_skill_sets": document_skill_sets_q,
    "add_metadata": add_metadata_q,
    "processed_postings": processed_postings_q,
}
