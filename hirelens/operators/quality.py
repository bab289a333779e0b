"""Run statistics, quality gate, run report, null profile and salary
outliers (B8, E1-E4, A10).

All of them are single-pass aggregates or small transforms of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The quality gate messages and the run report template.
GATE_PASSED = "Validation passed - Data available for processing"
GATE_WARNING = "Validation warning - Little or no data"
REPORT_TEMPLATE = """
        ===== ETL Pipeline Report =====
        Execution Date: %s

        Scraping Results:
        - Total Jobs: %d
        - Unique Companies: %d
        - Unique Locations: %d

        Status: %s
        """


def _distinct_with_null(c: str) -> Column:
    """Number of distinct values, an explicit NULL counting as one value
    (document-store ``distinct`` semantics)."""
    return F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))


def raw_statistics(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    """total_jobs, unique_companies, unique_locations, last_scraped (one row)."""
    stamp = F.lit(as_of) if as_of else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return raw.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.coalesce(_distinct_with_null("company"), F.lit(0)).alias("unique_companies"),
        F.coalesce(_distinct_with_null("location"), F.lit(0)).alias("unique_locations"),
    ).withColumn("last_scraped", stamp)


def stats_json(stats: DataFrame) -> DataFrame:
    """The statistics as one JSON text (F16)."""
    return stats.select(F.to_json(F.struct(*stats.columns)).alias("stats"))


def quality_gate(stats: DataFrame, min_rows: int = 0) -> DataFrame:
    """passed = total_jobs > min_rows.  Advisory: it reports, it does not stop."""
    passed = F.coalesce(F.col("total_jobs") > min_rows, F.lit(False))
    return stats.select(
        "total_jobs", passed.alias("passed"),
        F.when(passed, GATE_PASSED).otherwise(GATE_WARNING).alias("message"))


def run_report(stats: DataFrame, execution_date: str, status: str = "SUCCESS") -> DataFrame:
    """One row: the report text; missing statistics count as 0."""
    return stats.select(
        F.lit(execution_date).alias("execution_date"),
        F.format_string(
            REPORT_TEMPLATE, F.lit(execution_date),
            F.coalesce("total_jobs", F.lit(0)), F.coalesce("unique_companies", F.lit(0)),
            F.coalesce("unique_locations", F.lit(0)), F.lit(status)).alias("report"))


def write_report(report: DataFrame, path: str) -> None:
    report.select("report").coalesce(1).write.mode("overwrite").text(path)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_count, total_rows, null_rate), one pass over df."""
    columns = columns or df.columns
    total = F.count(F.lit(1))
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("null_count"))
                     for c in columns])
    return (df.agg(total.alias("total_rows"), rows.alias("_p"))
            .select("total_rows", F.inline("_p"))
            .select("column_name", "null_count", "total_rows",
                    (F.col("null_count") / F.nullif(F.col("total_rows"), F.lit(0))).alias("null_rate")))


def _cumulative(hist: DataFrame, value_col: str, weight_col: str) -> DataFrame:
    """Add ``_before`` = total weight of smaller values and ``_all`` = total
    weight (exact, distributed).

    Same scheme as the surrogate keys: range partitions, per-partition
    totals, offsets over one row per partition, then a running sum inside
    each partition.  The histogram is materialised once; all else reads it.
    """
    ranged = (hist.repartitionByRange(value_col)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    totals = ranged.groupBy("_pid").agg(F.sum(weight_col).alias("_tot"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("_pid", F.coalesce(F.sum("_tot").over(earlier), F.lit(0)).alias("_off"),
                            F.sum("_tot").over(whole).alias("_all"))
    inner = F.sum(weight_col).over(Window.partitionBy("_pid").orderBy(value_col)
                                   .rowsBetween(Window.unboundedPreceding, -1))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn("_before", F.col("_off") + F.coalesce(inner, F.lit(0)))
            .drop("_pid", "_off"))


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """Exact continuous quantiles (linear interpolation, like percentile_cont)
    without gathering the values: a histogram of distinct values (combined
    map-side), exact cumulative counts over it, then all ranks in one
    aggregate.  One row, one column ``q<i>`` per probability."""
    hist = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_w"))
    cum = _cumulative(hist, col, "_w")

    def value_at(rank: Column) -> Column:
        hit = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_w"))
        return F.min(F.when(hit, F.col(col))).cast("double")

    ranks = {}
    for i, p in enumerate(probs):
        pos = (F.col("_all") - 1).cast("double") * F.lit(float(p))
        ranks |= {f"_lo{i}": value_at(F.floor(pos)), f"_hi{i}": value_at(F.ceil(pos)),
                  f"_part{i}": F.max(pos - F.floor(pos))}
    row = cum.agg(*[c.alias(name) for name, c in ranks.items()])
    return row.select(*[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")).alias(f"q{i}")
                        for i in range(len(probs))])


def salary_quartiles(fact: DataFrame, col: str = "salary_max", k: float = 1.5) -> DataFrame:
    q = exact_quantiles(fact, col, [0.25, 0.75])
    iqr = F.col("q1") - F.col("q0")
    return q.select(F.col("q0").alias("q1"), F.col("q1").alias("q3"), iqr.alias("iqr"),
                    (F.col("q0") - iqr * k).alias("lower_fence"), (F.col("q1") + iqr * k).alias("upper_fence"))


def salary_outliers(fact: DataFrame, col: str = "salary_max", k: float = 1.5) -> DataFrame:
    """Jobs whose salary is outside the IQR fences, or whose min > max."""
    fences = salary_quartiles(fact, col, k).first()  # one row of numbers
    lo, hi = (F.lit(fences[c]).cast("double") for c in ("lower_fence", "upper_fence"))
    outside = (F.col(col) < lo) | (F.col(col) > hi)
    inverted = F.col("salary_min") > F.col("salary_max")
    flagged = fact.where(F.coalesce(outside, F.lit(False)) | F.coalesce(inverted, F.lit(False)))
    return flagged.select(
        "job_id", "salary_min", "salary_max",
        F.coalesce(outside, F.lit(False)).alias("outside_fence"),
        F.coalesce(inverted, F.lit(False)).alias("min_above_max"))
