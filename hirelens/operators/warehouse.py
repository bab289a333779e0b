"""Set-based warehouse load: staging, find-or-create companies, jobs,
skills, the job-skill bridge and locations (D1-D7, D10).

The original declares a star schema and a one-row-at-a-time
find-or-create function but never fills the tables.  Here every step is
one DataFrame transform over the whole batch:

* staging renames fields, maps the scraper's "N/A" to NULL, normalises
  urls and parses timestamps;
* companies are found or created with a left-anti join on the name, new
  ones get keys after the current maximum; a posting without a company
  belongs to the company "N/A", so it isn't lost;
* a posting without a title can't be in the fact (NOT NULL): it is in
  ``rejected_jobs``, so loaded + rejected = staged;
* jobs get their company id by an equi-join on the name (AQE splits a hot
  company's partition) and keys in staging order;
* skills come from a fixed, curated dictionary (a literal map), and the
  bridge is unique per (job, skill) by construction, without a shuffle;
* staging is range-ordered and checkpointed once, and once more cleaned; job
  and bridge keys are then numbered in place from it, without further range
  shuffles.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.salary import salary_max_col, salary_min_col
from hirelens.functions.skills import CATEGORY_OF, SKILL_NAMES, skills_bounded_col
from hirelens.functions.text import clean_text_col
from hirelens.operators.keys import assign_keys, next_key_start, number_in_order
from hirelens.sources.bindings import Star
from hirelens.sources.io import drop_seen

NA = "N/A"
DEFAULT_BASE_URL = "https://jobs.example.com"
DEFAULT_SOURCE = "job-board"

# Exact copies of a staged row handled per range-partitioned chunk.
COPIES_CHUNK = 100_000

STAGING_ORDER = ["job_url", "scraped_at", "job_title", "company_name", "location", "salary",
                 "description_preview"]


def _ts(value: str | None) -> Column:
    return F.lit(value).cast("timestamp_ntz") if value else F.localtimestamp()


def not_na(c: Column) -> Column:
    return F.nullif(c, F.lit(NA))


def normalize_url_col(url: Column, base_url: str = DEFAULT_BASE_URL) -> Column:
    """Prefix a relative url with the site base; "", NULL and "N/A" unchanged."""
    relative = url.isNotNull() & (url != "") & (url != NA) & ~url.startswith("http")
    return F.when(relative, F.concat(F.lit(base_url), url)).otherwise(url)


def with_row_identity(df: DataFrame, col: str = "_row") -> DataFrame:
    """Stable identity of each row of a file-based DataFrame: (file, row index).

    Identical postings then still differ in their sort key, so range
    partitioning spreads a group of copies instead of keeping it together.
    """
    return df.withColumn(col, F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")))


def stage_jobs(raw: DataFrame, loaded_at: str | None = None, source: str = DEFAULT_SOURCE,
               base_url: str = DEFAULT_BASE_URL, tiebreak: str | None = None,
               existing: DataFrame | None = None) -> DataFrame:
    """Raw postings -> staging_raw_jobs rows with dense staging ids (D1),
    after those of ``existing``.

    ``tiebreak`` names a column that identifies each raw row (a source key,
    or ``with_row_identity``); it orders exact copies last.  Without one,
    copies are numbered first (an extra aggregation) so that a group of
    copies cannot pin one range partition.
    """
    desc = F.col("description_preview") if "description_preview" in raw.columns else F.lit(None)
    extra = [F.col(tiebreak).alias("_tiebreak")] if tiebreak else []
    staged = raw.select(
        not_na(F.col("title")).alias("job_title"),
        not_na(F.col("company")).alias("company_name"),
        not_na(F.col("location")).alias("location"),
        not_na(F.col("salary")).alias("salary"),
        desc.cast("string").alias("description_preview"),
        normalize_url_col(not_na(F.col("url")), base_url).alias("job_url"),
        F.lit(source).alias("source"),
        F.col("scraped_at").try_cast("timestamp_ntz").alias("scraped_at"),
        _ts(loaded_at).alias("created_at"),
        *extra,
    )
    start = next_key_start(existing, "staging_id")
    if tiebreak:
        keyed = assign_keys(staged, STAGING_ORDER + ["_tiebreak"], "staging_id", start=start)
    else:
        keyed = assign_keys(staged, STAGING_ORDER, "staging_id", start=start, copies_chunk=COPIES_CHUNK)
    return keyed.select(
        "staging_id", "job_title", "company_name", "location", "salary", "description_preview",
        "job_url", "source", "scraped_at", "created_at")


def prepare_jobs(staging: DataFrame) -> DataFrame:
    """Cleaned title and company, parsed salary range (the processing step)."""
    return staging.select(
        "staging_id",
        F.nullif(clean_text_col("job_title"), F.lit("")).alias("job_title"),
        F.coalesce(F.nullif(clean_text_col("company_name"), F.lit("")), F.lit(NA)).alias("company_name"),
        "location",
        salary_min_col("salary").alias("salary_min"),
        salary_max_col("salary").alias("salary_max"),
        "job_url", "scraped_at", "description_preview",
    )


def conform(df: DataFrame, like: DataFrame) -> DataFrame:
    """Select ``like``'s columns from ``df``, NULL for the ones it lacks."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(like.schema[c].dataType).alias(c)
                       for c in like.columns])


def new_companies(existing: DataFrame | None, jobs: DataFrame, loaded_at: str | None = None) -> DataFrame:
    """Companies of ``jobs`` that don't exist yet, by exact name; their keys
    continue after the current maximum in name order."""
    names = jobs.where(F.col("company_name").isNotNull()).select("company_name").distinct()
    if existing is not None:
        names = drop_seen(names, existing, "company_name")
    return assign_keys(names, ["company_name"], "company_id",
                       start=next_key_start(existing, "company_id")).select(
        "company_id", "company_name", F.lit(None).cast("string").alias("industry"),
        _ts(loaded_at).alias("created_at"))


def upsert_companies(existing: DataFrame | None, jobs: DataFrame,
                     loaded_at: str | None = None) -> DataFrame:
    """Find-or-create by exact name (D2): existing rows + new names."""
    new = new_companies(existing, jobs, loaded_at)
    return new if existing is None else conform(existing, new).unionByName(new)


def loadable(jobs: DataFrame) -> DataFrame:
    """Rows that satisfy fact_jobs' NOT NULL rules (every job has a company)."""
    return jobs.where(F.col("job_title").isNotNull())


def rejected(jobs: DataFrame) -> DataFrame:
    """The other rows, with the reason: what staging holds and the fact can't."""
    return jobs.where(F.col("job_title").isNull()).withColumn("reason", F.lit("job_title is missing"))


def number_jobs(jobs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """job_id in staging order after the current maximum.

    ``jobs`` comes from ``prepare_jobs`` (narrow steps over the checkpointed,
    range-ordered staging frame), so keys are assigned in place.
    """
    return number_in_order(loadable(jobs), "job_id", start=next_key_start(existing, "job_id"))


def load_fact(numbered_jobs: DataFrame, companies: DataFrame, loaded_at: str | None = None,
              keep_description: bool = False) -> DataFrame:
    """Insert jobs (D3): company id by exact name, posted_date = load time.

    Every loadable row has a company in ``companies`` (they were upserted
    from the same rows), so the inner join keeps all of them.
    """
    with_company = numbered_jobs.join(companies.select("company_name", "company_id"), "company_name")
    cols = [
        "job_id", "company_id", "job_title", "job_url", "location", "salary_min", "salary_max",
        _ts(loaded_at).alias("posted_date"), "scraped_at", _ts(loaded_at).alias("processed_at"),
        F.lit(1.0).alias("data_quality_score"),
    ]
    if keep_description:
        cols.append("description_preview")
    return with_company.select(*cols)


def skill_dimension(spark: SparkSession, loaded_at: str | None = None) -> DataFrame:
    """dim_skills from the curated dictionary, ids in list order."""
    rows = [(i + 1, n, CATEGORY_OF.get(n)) for i, n in enumerate(SKILL_NAMES)]
    return spark.createDataFrame(rows, "skill_id long, skill_name string, skill_category string") \
        .withColumn("created_at", _ts(loaded_at))


def _skill_id_map() -> Column:
    pairs = []
    for i, n in enumerate(SKILL_NAMES):
        pairs += [F.lit(n), F.lit(i + 1).cast("long")]
    return F.create_map(*pairs)


def load_bridge(numbered_jobs: DataFrame, existing: DataFrame | None = None,
                text_col: str = "description_preview") -> DataFrame:
    """One row per distinct (job, skill) found in the job text.

    Skill ids come from the fixed dictionary (a literal map, no join), the
    bounded extraction returns distinct skills per job so UNIQUE(job_id,
    skill_id) holds without a dedupe shuffle, and since jobs arrive in
    job_id order and each job's ids are sorted, the bridge keys follow
    (job_id, skill_id) order without another shuffle.
    """
    ids = F.array_sort(F.transform(skills_bounded_col(text_col), lambda n: _skill_id_map()[n]))
    # The skill regex is the costly step and numbering reads its output twice
    # (counts, then keys): write the small (job, skill) pairs once instead.
    # A checkpoint keeps partitions and their order, as numbering requires.
    pairs = numbered_jobs.select("job_id", F.explode(ids).alias("skill_id")).checkpoint(eager=True)
    return number_in_order(pairs, "job_skill_id", start=next_key_start(existing, "job_skill_id")).select(
        "job_skill_id", "job_id", "skill_id")


def new_locations(existing: DataFrame | None, jobs: DataFrame, loaded_at: str | None = None) -> DataFrame:
    """Distinct non-null locations that don't exist yet, split into city / country."""
    names = jobs.where(F.col("location").isNotNull()).select(F.col("location").alias("location_name")).distinct()
    if existing is not None:
        names = drop_seen(names, existing, "location_name")
    parts = F.split(F.col("location_name"), ",")
    return assign_keys(names, ["location_name"], "location_id",
                       start=next_key_start(existing, "location_id")).select(
        "location_id", "location_name",
        F.nullif(F.trim(F.try_element_at(parts, F.lit(1))), F.lit("")).alias("city"),
        F.nullif(F.trim(F.try_element_at(parts, F.lit(2))), F.lit("")).alias("country"),
        _ts(loaded_at).alias("created_at"))


class Warehouse:
    """The loaded tables of one batch, built lazily: a query that reads only
    the fact does not pay for the bridge or the locations."""

    def __init__(self, raw: DataFrame, loaded_at: str | None = None, previous=None,
                 base_url: str = DEFAULT_BASE_URL, tiebreak: str | None = None):
        self._raw, self._at, self._prev, self._base = raw, loaded_at, previous, base_url
        self._tiebreak = tiebreak

    @cached_property
    def new_staging(self) -> DataFrame:
        return stage_jobs(self._raw, self._at, base_url=self._base, tiebreak=self._tiebreak,
                          existing=self._prev.staging_raw_jobs if self._prev else None)

    @cached_property
    def _jobs(self) -> DataFrame:
        # Read by companies, fact, bridge, locations and rejected rows: cleaned
        # once (a checkpoint keeps the partition order that numbering relies on).
        return prepare_jobs(self.new_staging).checkpoint(eager=True)

    @cached_property
    def rejected_jobs(self) -> DataFrame:
        """Rows of this batch that the fact can't hold."""
        return rejected(self._jobs)

    @cached_property
    def new_companies(self) -> DataFrame:
        return new_companies(self._prev.dim_companies if self._prev else None, self._jobs, self._at)

    @cached_property
    def _numbered(self) -> DataFrame:
        return number_jobs(self._jobs, self._prev.fact_jobs if self._prev else None)

    @cached_property
    def new_fact_jobs(self) -> DataFrame:
        return load_fact(self._numbered, self.dim_companies, self._at)

    @cached_property
    def new_bridge(self) -> DataFrame:
        return load_bridge(self._numbered, self._prev.bridge_job_skills if self._prev else None)

    @cached_property
    def new_locations(self) -> DataFrame:
        return new_locations(self._prev.dim_locations if self._prev else None, loadable(self._jobs), self._at)

    def _with_previous(self, name: str, new: DataFrame) -> DataFrame:
        return conform(getattr(self._prev, name), new).unionByName(new) if self._prev else new

    @cached_property
    def staging_raw_jobs(self) -> DataFrame:
        return self._with_previous("staging_raw_jobs", self.new_staging)

    @cached_property
    def dim_companies(self) -> DataFrame:
        return self._with_previous("dim_companies", self.new_companies)

    @cached_property
    def fact_jobs(self) -> DataFrame:
        return self._with_previous("fact_jobs", self.new_fact_jobs)

    @cached_property
    def dim_skills(self) -> DataFrame:
        if self._prev and not self._prev.dim_skills.isEmpty():
            return self._prev.dim_skills
        return skill_dimension(self._raw.sparkSession, self._at)

    @cached_property
    def bridge_job_skills(self) -> DataFrame:
        return self._with_previous("bridge_job_skills", self.new_bridge)

    @cached_property
    def dim_locations(self) -> DataFrame:
        return self._with_previous("dim_locations", self.new_locations)

    def star(self) -> Star:
        return Star(self.fact_jobs, self.dim_companies, self.dim_skills, self.bridge_job_skills)


def load_warehouse(raw: DataFrame, loaded_at: str | None = None, previous=None,
                   base_url: str = DEFAULT_BASE_URL, tiebreak: str | None = None) -> Warehouse:
    """Raw postings -> warehouse tables, appended to ``previous`` if given: any
    object with the six tables, such as another load or a stored warehouse."""
    return Warehouse(raw, loaded_at, previous, base_url, tiebreak)
