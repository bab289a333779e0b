"""The daily run in stage order, as one function (C10 + the DAG's order).

pages -> job cards (parsed once, landed) -> junk filter -> cross-batch url
dedupe -> raw -> statistics + quality gate -> processing -> warehouse load
-> report.

A run has an id (the day by default).  Its cards, raw and processed rows lie in
partitions of that id, and running it again replaces them; only the run's own
batch is processed.

The warehouse's tables change together.  Each attempt of a run writes folders
of its own (``run_id=<id>``, then ``run_id=<id>~1`` and so on), and only when
all six tables are written does a manifest with one rename name them in place
of the earlier attempt's.  ``read_warehouse`` reads what the newest manifest
names: a run that breaks off changes nothing, and a run repeated under the same
id replaces itself whatever months its jobs are posted in.  Companies and
locations are found or created in the published tables; surrogate keys continue
after those of the other runs.  Folders that no manifest names go with the next
attempt; those that were replaced go right after (a reader of them has to start
anew).  Before that the run's own rows are held against the keys' rules
(``run_violations``); a run that breaks one raises and publishes nothing.

The gate is advisory, as in the original, unless ``strict_gate`` is set; a
run without a single card warns and goes on.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hirelens.operators.cleaning import process
from hirelens.operators.constraints import run_violations
from hirelens.operators.dedupe import dedupe_cross_batch
from hirelens.operators.quality import quality_gate, raw_statistics, run_report, write_report
from hirelens.operators.warehouse import Warehouse, load_warehouse, with_row_identity
from hirelens.plans.run_summaries import NAME as SUMMARY
from hirelens.plans.run_summaries import RUN_SUMMARY, summarise
from hirelens.schemas import JOB_CARD, RAW, WAREHOUSE
from hirelens.sources.bindings import Star
from hirelens.sources.html_cards import job_cards, valid_cards
from hirelens.sources.files import delete, matching
from hirelens.sources.io import drop_partition, empty_frame, path_exists, write_table
from hirelens.sources.manifest import Manifest

RAW_COLS = [f.name for f in RAW.fields]
RUN, MONTH = "run_id", "posted_month"
#: Tables of which a repeated run replaces its rows; to the others it adds.
REPLACED = ("staging_raw_jobs", "fact_jobs", "bridge_job_skills", SUMMARY)


@dataclass(frozen=True)
class StoredWarehouse:
    """The six written tables; a following run continues from them."""

    staging_raw_jobs: DataFrame
    dim_companies: DataFrame
    fact_jobs: DataFrame
    dim_skills: DataFrame
    bridge_job_skills: DataFrame
    dim_locations: DataFrame

    def star(self) -> Star:
        return Star(self.fact_jobs, self.dim_companies, self.dim_skills, self.bridge_job_skills)


@dataclass
class RunResult:
    raw_rows: int
    processed_rows: int
    rejected_rows: int
    passed: bool
    warehouse: StoredWarehouse
    report: DataFrame


def _plus(schema: StructType, *columns: str) -> StructType:
    """``schema`` with text columns added (text, so that partition values stay as written)."""
    return StructType([*schema.fields, *(StructField(c, StringType(), True) for c in columns)])


def read_runs(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table partitioned by run; the typed empty frame if nothing was written."""
    full = _plus(schema, RUN)
    return spark.read.schema(full).parquet(path) if path_exists(spark, path) else empty_frame(spark, full)


def write_run(df: DataFrame, path: str, run_id: str) -> int:
    """Write a run's rows in place of its earlier ones."""
    rows = write_table(df.withColumn(RUN, F.lit(run_id)), path, partition_by=[RUN], one_partition=True)
    if not rows:  # nothing to write also replaces
        drop_partition(df.sparkSession, path, f"{RUN}={run_id}")
    return rows


def published(spark: SparkSession, base: str) -> dict[str, dict[str, list[str]]]:
    """By table and run the folders that are valid."""
    manifest = Manifest(spark, base)
    if manifest.exists():
        return manifest.read().get("tables", {})
    # Written before there was a manifest: every folder counts.
    found: dict[str, dict[str, list[str]]] = {}
    for name in WAREHOUSE:
        for path in matching(spark, f"{base}/{name}/{RUN}=*"):
            folder = path.rsplit("/", 1)[1]
            found.setdefault(name, {})[folder.split("=", 1)[1]] = [folder]
    return found


def stored(spark: SparkSession, base: str, tables: dict, name: str, schema: StructType | None = None,
           without_run: str | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """What ``tables`` (of ``published``) names of one table."""
    full = _plus(schema or WAREHOUSE[name], RUN, *more)
    paths = [f"{base}/{name}/{folder}" for run, folders in sorted(tables.get(name, {}).items()) if run != without_run
             for folder in folders]
    if not paths:
        return empty_frame(spark, full)
    read = spark.read.schema(full).option("basePath", f"{base}/{name}").parquet(*paths)
    return read.withColumn(RUN, F.regexp_replace(RUN, r"~\d+$", ""))


def read_warehouse(spark: SparkSession, base: str, without_run: str | None = None) -> StoredWarehouse:
    """The published warehouse.  ``without_run`` leaves out the staging, jobs
    and bridge rows of one run, which is about to replace them.  The fact
    keeps its month column, so date-bounded reports read few folders."""
    tables = published(spark, base)

    def runs(name: str, *more: str) -> DataFrame:
        return stored(spark, base, tables, name, without_run=without_run, more=more)

    def dimension(name: str) -> DataFrame:
        return stored(spark, base, tables, name).drop(RUN)

    return StoredWarehouse(runs("staging_raw_jobs"), dimension("dim_companies"), runs("fact_jobs", MONTH),
                           dimension("dim_skills"), runs("bridge_job_skills"), dimension("dim_locations"))


def broken_keys(spark: SparkSession, base: str, new: dict, held: dict) -> dict[str, int]:
    """The rules of the keys (not null, unique, foreign) that the folders in ``new``
    break beside those in ``held``, with the number of rows.  Overlong texts
    are for the reports."""
    def frames(tables: dict) -> dict[str, DataFrame]:
        return {name: stored(spark, base, tables, name).drop(RUN) for name in WAREHOUSE if any(tables.get(name, {}).values())}

    added = frames(new)
    if not added:
        return {}
    found = run_violations(added, frames(held)).where("violations > 0 and not contains(check_name, ' length <= ')")
    return {r["check_name"]: r["violations"] for r in found.collect()}


def write_warehouse(wh: Warehouse, base: str, run_id: str) -> dict[str, int]:
    """Write what a run adds, hold it against the keys' rules, then publish it in one step."""
    if "~" in run_id:
        raise ValueError("a run id can't have a '~'")
    spark, tables = wh.new_staging.sparkSession, published(wh.new_staging.sparkSession, base)
    named = {f"{name}/{folder}" for name in tables for folders in tables[name].values() for folder in folders}
    for name in (*WAREHOUSE, SUMMARY):  # what broken attempts left
        for path in matching(spark, f"{base}/{name}/{RUN}=*"):
            if "/".join(path.rsplit("/", 2)[1:]) not in named:
                delete(spark, path)
    first = f"{RUN}={quote(run_id, safe=' ')}"
    tried = {folder for name in tables for folder in tables[name].get(run_id, ())}
    number = 1 + max((int(f.rpartition("~")[2]) if "~" in f else 0 for f in tried), default=-1)
    folder = f"{first}~{number}" if number else first

    new = {
        "staging_raw_jobs": wh.new_staging,
        "dim_companies": wh.new_companies,
        "dim_locations": wh.new_locations,
        "fact_jobs": wh.new_fact_jobs.withColumn(MONTH, F.date_format("posted_date", "yyyy-MM")),
        "bridge_job_skills": wh.new_bridge,
    }
    if not tables.get("dim_skills"):
        new["dim_skills"] = wh.dim_skills
    counts, gone = {}, []
    held = {name: {run: list(folders) for run, folders in runs.items() if name not in REPLACED or run != run_id}
            for name, runs in tables.items()}

    def write(name: str, rows: DataFrame) -> None:
        path = f"{base}/{name}/{folder}"
        # A run's jobs are posted at the time they are loaded: one month.
        counts[name] = write_table(rows, path, partition_by=[MONTH] if name == "fact_jobs" else None, one_partition=True)
        runs = tables.setdefault(name, {})
        if name in REPLACED:
            gone.extend(f"{base}/{name}/{old}" for old in runs.pop(run_id, ()))
        if counts[name]:
            runs[run_id] = [*runs.get(run_id, ()), folder]
        else:
            delete(spark, path)

    for name, rows in new.items():
        write(name, rows)
    own = {name: {run_id: [folder] if counts[name] else []} for name in new}
    broken = broken_keys(spark, base, own, held)
    if broken:
        raise ValueError(f"run {run_id} isn't published, rows that break a rule: {broken}")
    write(SUMMARY, summarise(stored(spark, base, own, "fact_jobs"), stored(spark, base, own, "bridge_job_skills"),
                             stored(spark, base, tables, "dim_locations")))
    Manifest(spark, base).publish({"tables": tables})
    for path in gone:
        delete(spark, path)
    return counts


def run_daily(pages: DataFrame, out_dir: str, as_of: str, run_id: str | None = None,
              strict_gate: bool = False, min_rows: int = 0) -> RunResult:
    """One run over saved pages (page_id, html, batch_idx)."""
    spark, as_of_iso, run_id = pages.sparkSession, as_of.replace(" ", "T"), run_id or as_of[:10]
    card_schema = StructType([*JOB_CARD.fields, pages.schema["batch_idx"], StructField("scraped_at", StringType())])

    # The dearest step, Python per page, runs once: all else reads the landed cards.
    write_run(job_cards(pages, scraped_at=as_of_iso, carry=("batch_idx",)), f"{out_dir}/cards", run_id)
    cards = read_runs(spark, f"{out_dir}/cards", card_schema).where(F.col(RUN) == run_id)
    raw = dedupe_cross_batch(valid_cards(cards), "url", "batch_idx").select(*RAW_COLS)
    raw_rows = write_run(raw, f"{out_dir}/raw_jobs", run_id)

    landed = read_runs(spark, f"{out_dir}/raw_jobs", RAW)
    if raw_rows:
        batch = with_row_identity(landed).where(F.col(RUN) == run_id).drop(RUN)
    else:
        batch = landed.where("false").drop(RUN).withColumn("_row", F.lit(0))
    stats = raw_statistics(batch.drop("_row"), as_of_iso)
    passed = bool(quality_gate(stats, min_rows).first()["passed"])
    if strict_gate and not passed:
        raise RuntimeError("quality gate failed: no raw postings")
    processed_rows = write_run(process(batch.drop("_row"), as_of_iso), f"{out_dir}/processed_jobs", run_id)

    base = f"{out_dir}/warehouse"
    previous = read_warehouse(spark, base, without_run=run_id)
    wh = load_warehouse(batch.withColumn("description_preview", F.array_join("skills", ", ")), as_of, previous,
                        tiebreak="_row")
    write_warehouse(wh, base, run_id)
    rejected_rows = write_run(wh.rejected_jobs, f"{out_dir}/rejected_jobs", run_id)
    report = run_report(stats, as_of)
    write_report(report, f"{out_dir}/reports/report_{as_of_iso.replace(':', '-')}")
    return RunResult(raw_rows, processed_rows, rejected_rows, passed, read_warehouse(spark, base), report)
