"""Warehouse constraints as violation counts (D8) and cascading delete.

Spark tables do not enforce keys, so the DDL's NOT NULL / UNIQUE / FOREIGN
KEY / VARCHAR(n) rules become one report: (check_name, violations).  Each
table is scanned once for all its row-level rules; a uniqueness rule is one
aggregate on the key and a foreign-key rule one anti join.

``run_violations`` is the same report for the rows that a run adds.  Stored rows
are read for their keys only, and only where they may matter: the least and
largest of the new keys go to the scan (runs' surrogate keys rise, so no row
group of an earlier run is read for them), and what is read has to pass a Bloom
filter of the new keys before it is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.operators.key_filter import KeyFilter, ends, paired
from hirelens.schemas import LENGTH_LIMITS
from hirelens.session import small_shuffle_tasks
from hirelens.sources.bindings import Star

NOT_NULL = {
    "fact_jobs": ["job_id", "company_id", "job_title"],
    "dim_companies": ["company_id", "company_name"],
    "dim_skills": ["skill_id", "skill_name"],
    "bridge_job_skills": ["job_skill_id", "job_id", "skill_id"],
    "dim_locations": ["location_id", "location_name"],
    "staging_raw_jobs": ["staging_id"],
}
UNIQUE = {
    "fact_jobs": [["job_id"]],
    "dim_companies": [["company_id"], ["company_name"]],
    "dim_skills": [["skill_id"], ["skill_name"]],
    "bridge_job_skills": [["job_skill_id"], ["job_id", "skill_id"]],
    "dim_locations": [["location_id"], ["location_name"]],
    "staging_raw_jobs": [["staging_id"]],
}
FOREIGN_KEYS = [
    ("fact_jobs", "company_id", "dim_companies", "company_id"),
    ("bridge_job_skills", "job_id", "fact_jobs", "job_id"),
    ("bridge_job_skills", "skill_id", "dim_skills", "skill_id"),
]


def _row_rules(name: str, df: DataFrame) -> list[tuple[str, Column]]:
    """(check_name, aggregate) of the rules that a row breaks by itself."""
    checks: list[tuple[str, Column]] = []
    for c in NOT_NULL.get(name, []):
        if c in df.columns:
            checks.append((f"{name}.{c} not null", F.count_if(F.col(c).isNull())))
    for c, n in LENGTH_LIMITS.get(name, {}).items():
        if c in df.columns:
            checks.append((f"{name}.{c} length <= {n}", F.count_if(F.length(c) > n)))
    return checks


def _row_checks(name: str, df: DataFrame) -> DataFrame | None:
    checks = _row_rules(name, df)
    if not checks:
        return None
    rows = F.array(*[F.struct(F.lit(k).alias("check_name"), v.alias("violations")) for k, v in checks])
    return df.agg(rows.alias("_checks")).select(F.inline("_checks"))


def _unique_check(name: str, df: DataFrame, key: list[str]) -> DataFrame:
    # As in the DDL, nulls are never equal (NOT NULL rules count them).
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in key])
    dup = df.where(whole).groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return dup.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("violations")).select(
        F.lit(f"{name}({', '.join(key)}) unique").alias("check_name"), "violations")


def _fk_check(child_name: str, child: DataFrame, col: str, parent_name: str, parent: DataFrame,
              pcol: str) -> DataFrame:
    orphans = (child.where(F.col(col).isNotNull()).select(col)
               .join(parent.select(F.col(pcol).alias(col)), col, "left_anti"))
    return orphans.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(f"{child_name}.{col} -> {parent_name}.{pcol}").alias("check_name"), "violations")


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    small_shuffle_tasks(next(iter(tables.values())).sparkSession)
    parts: list[DataFrame] = []
    for name, df in tables.items():
        rc = _row_checks(name, df)
        if rc is not None:
            parts.append(rc)
        for key in UNIQUE.get(name, []):
            if all(k in df.columns for k in key):
                parts.append(_unique_check(name, df, key))
    for child, col, parent, pcol in FOREIGN_KEYS:
        if child in tables and parent in tables:
            parts.append(_fk_check(child, tables[child], col, parent, tables[parent], pcol))
    return reduce(DataFrame.unionByName, parts).select(
        "check_name", F.col("violations").cast("long").alias("violations"))


def _run_unique_check(name: str, new: DataFrame, stored: DataFrame | None, key: list[str], among: KeyFilter) -> DataFrame:
    """New rows that may not be added: of each key all but one, and that one too if a stored row has the key.
    Both sides are summed by key together, which needs no sorted join and reads the new rows once."""
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in key])
    rows = new.where(whole).select(*key, F.lit(1).cast("long").alias("_new"), F.lit(0).cast("long").alias("_old"))
    if stored is not None and among.meets(stored, key[0]):
        kinds = [new.schema[k].dataType for k in key]
        known = among.candidates(stored, key)
        if [known.schema[k].dataType for k in key] != kinds:  # compared as a join does, by the new rows' spelling
            known = rows.select(*key).distinct().join(known, key, "left_semi").select(*[rows[k] for k in key])
        rows = rows.union(known.select(*key, F.lit(0).cast("long"), F.lit(1).cast("long")))
    held = rows.groupBy(*key).agg(F.sum("_new").alias("_new"), F.max("_old").alias("_old")).where("_new > 0")
    return held.agg(F.coalesce(F.sum(F.col("_new") - 1 + F.col("_old")), F.lit(0)).alias("violations")).select(
        F.lit(f"{name}({', '.join(key)}) unique").alias("check_name"), "violations")


def _run_fk_check(child_name: str, child: DataFrame, col: str, parent_name: str, parents: DataFrame | None,
                  stored: DataFrame | None, pcol: str, among: KeyFilter) -> DataFrame:
    """New rows whose parent is neither among the run's rows nor stored."""
    keys = loose = child.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    if parents is not None:
        loose = loose.join(parents.select(F.col(pcol).alias(col)), col, "left_anti")
    held = None if stored is None else stored.select(F.col(pcol).alias(col))
    if held is not None and among.meets(held, col):
        loose = loose.join(among.candidates(held, [col], keys), col, "left_anti")
    return loose.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
        F.lit(f"{child_name}.{col} -> {parent_name}.{pcol}").alias("check_name"), "violations")


def run_violations(new: dict[str, DataFrame], stored: dict[str, DataFrame]) -> DataFrame:
    """(check_name, violations): the rows of ``new`` that break a rule beside
    the ``stored`` ones.

    A unique key counts every new row but the first that brings it, and that
    one too if a stored row has the key.  Foreign keys look among the new and
    the stored parents.  Nulls are as in ``constraint_violations``; stored rows
    that break a rule among themselves don't count, and without new rows
    nothing does.  One pass over each new table counts what a row breaks by
    itself and takes the keys' ranges; a unique key is one aggregate over new and
    possible stored rows, and only the foreign keys' look-ups are joins.
    """
    spark = next(iter(new.values())).sparkSession
    small_shuffle_tasks(spark)
    alone: list[tuple[str, int]] = []  # what the run's rows break by themselves
    parts: list[DataFrame] = []
    among = {}
    for name, df in new.items():
        keys = [k for k in UNIQUE.get(name, []) if all(c in df.columns for c in k)]
        columns = {k[0] for k in keys} | {col for child, col, _, _ in FOREIGN_KEYS if child == name}
        columns = sorted(columns & set(df.columns))
        rules = _row_rules(name, df)
        row = df.agg(F.count(F.lit(1)), *ends(columns), *[rule for _, rule in rules]).first()
        alone += zip([check for check, _ in rules], row[1 + 2 * len(columns):])
        among[name] = KeyFilter(df, row[0], paired(columns, row[1:]))
        for key in keys:
            parts.append(_run_unique_check(name, df, stored.get(name), key, among[name]))
    for child, col, parent, pcol in FOREIGN_KEYS:
        if child in new and (parent in new or parent in stored):
            parts.append(_run_fk_check(child, new[child], col, parent, new.get(parent), stored.get(parent), pcol,
                                       among[child]))
    first = spark.createDataFrame(alone, "check_name string, violations long")
    return (reduce(DataFrame.unionByName, [p.select("check_name", F.col("violations").cast("long").alias("violations"))
                                           for p in parts], first)
            .groupBy("check_name").agg(F.sum("violations").alias("violations")))


def star_tables(star) -> dict[str, DataFrame]:
    """The tables of a star, or all six of a whole warehouse."""
    names = ("fact_jobs", "dim_companies", "dim_skills", "bridge_job_skills", "dim_locations", "staging_raw_jobs")
    return {name: getattr(star, name) for name in names if hasattr(star, name)}


def cascade_delete(star: Star, doomed: Column) -> Star:
    """Delete the jobs matching ``doomed`` and, as ON DELETE CASCADE does,
    their bridge rows.  Returns the remaining star."""
    gone = star.fact_jobs.where(doomed).select("job_id")
    fact = star.fact_jobs.where(~doomed | doomed.isNull())
    bridge = star.bridge_job_skills.join(gone, "job_id", "left_anti")
    return Star(fact, star.dim_companies, star.dim_skills, bridge)
