"""Posting dedupe across scrape batches.

The scraper drops a posting whose url was seen in an *earlier* keyword
batch, while duplicates inside one batch survive, and a missing (NULL) url
is treated like any other value.  Both rules are written as one aggregate
on the url (combined map-side, so a url carried by a third of all rows is
reduced before the shuffle) plus, for the batch rule, one equi-join back on
the url that AQE can split if it is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Search keywords, one listing page each, in scrape order.
KEYWORDS = [
    "java", "python", "javascript", "typescript", "c-sharp", "php", "golang", "ruby", "c-plus-plus", "swift",
    "kotlin", "rust", "scala",
    "reactjs", "angular", "vuejs", "node-js", "spring-boot", "django", "laravel", "flutter", "react-native", ".net",
    "backend-developer", "frontend-developer", "fullstack-developer", "mobile-developer", "ios", "android",
    "devops-engineer", "automation-tester", "manual-tester", "qa-qc",
    "business-analyst", "project-manager", "product-owner", "product-manager",
    "data-engineer", "data-analyst", "data-scientist", "ai-engineer",
    "system-admin", "network-engineer", "solution-architect", "ui-ux-designer",
    "aws", "azure", "google-cloud", "docker", "kubernetes",
]


def keyword_slice(max_pages: int) -> list[str]:
    """All keywords, unless 0 < max_pages < 5 (then the first max_pages)."""
    return KEYWORDS[:max_pages] if 0 < max_pages < 5 else list(KEYWORDS)


def keyword_targets(spark, max_pages: int = 50, base_url: str = "https://jobs.example.com/it-jobs/") -> DataFrame:
    """(batch_idx, keyword, target_url) for the keywords to scrape."""
    rows = [(i, k) for i, k in enumerate(keyword_slice(max_pages))]
    df = spark.createDataFrame(rows, "batch_idx int, keyword string")
    return df.withColumn("target_url", F.concat(F.lit(base_url), F.col("keyword")))


def dedupe_cross_batch(df: DataFrame, url_col: str = "url", batch_col: str = "batch_idx") -> DataFrame:
    """Keep a row unless its url already appeared in an earlier batch."""
    first = df.groupBy(url_col).agg(F.min(batch_col).alias("_first_batch"))
    joined = df.join(first, df[url_col].eqNullSafe(first[url_col]))
    return joined.where(F.col(batch_col) == F.col("_first_batch")).select(df["*"])


def dedupe_strict(df: DataFrame, url_col: str = "url", order_cols: tuple = ("batch_idx", "pos")) -> DataFrame:
    """Keep exactly the first row per url in (batch, position) order."""
    rest = [c for c in df.columns if c != url_col]
    first = df.groupBy(url_col).agg(
        F.min_by(F.struct(*rest), F.struct(*order_cols)).alias("_row"))
    return first.select(url_col, "_row.*").select(*df.columns)
