"""Explicit schemas: raw postings, processed postings and the star warehouse.

Raw data is always read with one of these schemas, never inferred.
"""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _s(*fields):
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# One scraped posting.  Missing text is the literal "N/A", missing skills [].
RAW = _s(
    ("title", StringType(), True),
    ("company", StringType(), True),
    ("location", StringType(), True),
    ("salary", StringType(), True),
    ("skills", ArrayType(StringType()), True),
    ("url", StringType(), True),
    ("scraped_at", StringType(), True),
)

# RAW without salary, plus the parsed range and run metadata.
PROCESSED = _s(
    ("title", StringType(), True),
    ("company", StringType(), True),
    ("location", StringType(), True),
    ("skills", ArrayType(StringType()), True),
    ("url", StringType(), True),
    ("scraped_at", StringType(), True),
    ("salary_min", IntegerType(), True),
    ("salary_max", IntegerType(), True),
    ("processed_at", StringType(), True),
    ("data_quality_score", DoubleType(), True),
)

# A saved web page.
PAGE = _s(
    ("page_id", LongType(), True),
    ("url", StringType(), True),
    ("html", StringType(), True),
)

# One job card parsed from a page, in document order.
JOB_CARD = _s(
    ("page_id", LongType(), True),
    ("pos", IntegerType(), True),
    ("title", StringType(), True),
    ("url", StringType(), True),
    ("company", StringType(), True),
    ("location", StringType(), True),
    ("salary", StringType(), True),
    ("skills", ArrayType(StringType()), True),
    ("parse_error", StringType(), True),
)

DIM_COMPANIES = _s(
    ("company_id", LongType(), False),
    ("company_name", StringType(), False),
    ("industry", StringType(), True),
    ("created_at", TimestampNTZType(), True),
)

FACT_JOBS = _s(
    ("job_id", LongType(), False),
    ("company_id", LongType(), False),
    ("job_title", StringType(), False),
    ("job_url", StringType(), True),
    ("location", StringType(), True),
    ("salary_min", IntegerType(), True),
    ("salary_max", IntegerType(), True),
    ("posted_date", TimestampNTZType(), True),
    ("scraped_at", TimestampNTZType(), True),
    ("processed_at", TimestampNTZType(), True),
    ("data_quality_score", DoubleType(), True),
)

DIM_SKILLS = _s(
    ("skill_id", LongType(), False),
    ("skill_name", StringType(), False),
    ("skill_category", StringType(), True),
    ("created_at", TimestampNTZType(), True),
)

BRIDGE_JOB_SKILLS = _s(
    ("job_skill_id", LongType(), False),
    ("job_id", LongType(), False),
    ("skill_id", LongType(), False),
)

DIM_LOCATIONS = _s(
    ("location_id", LongType(), False),
    ("location_name", StringType(), False),
    ("city", StringType(), True),
    ("country", StringType(), True),
    ("created_at", TimestampNTZType(), True),
)

STAGING_RAW_JOBS = _s(
    ("staging_id", LongType(), False),
    ("job_title", StringType(), True),
    ("company_name", StringType(), True),
    ("location", StringType(), True),
    ("salary", StringType(), True),
    ("description_preview", StringType(), True),
    ("job_url", StringType(), True),
    ("source", StringType(), True),
    ("scraped_at", TimestampNTZType(), True),
    ("created_at", TimestampNTZType(), True),
)

WAREHOUSE = {
    "dim_companies": DIM_COMPANIES,
    "fact_jobs": FACT_JOBS,
    "dim_skills": DIM_SKILLS,
    "bridge_job_skills": BRIDGE_JOB_SKILLS,
    "dim_locations": DIM_LOCATIONS,
    "staging_raw_jobs": STAGING_RAW_JOBS,
}

# Column length limits of the warehouse DDL (VARCHAR(n)), checked by D8.
LENGTH_LIMITS = {
    "dim_companies": {"company_name": 255, "industry": 100},
    "fact_jobs": {"job_title": 255, "job_url": 500, "location": 100},
    "dim_skills": {"skill_name": 100, "skill_category": 50},
    "dim_locations": {"location_name": 100, "city": 50, "country": 50},
    "staging_raw_jobs": {"job_title": 255, "company_name": 255, "location": 100, "salary": 100, "job_url": 500,
                         "source": 50},
}
