"""URL filters by hashed host-suffix / path-prefix expressions (native).

Every distinct URL is expanded into the expressions host suffix + path
prefix that a rule could be; an expression meets the rules by an equi-join on
the first 8 hex digits of its SHA-256, and counts only if the whole digest
agrees.  The longest fitting rule wins.

Expansion is complete, not capped: a rule with at most ``m`` host labels can
only be a suffix of at most ``m`` labels, and a rule's path can only be a
prefix of one of the path lengths that occur among the rules.  Both come
from the rule table.

Work is per distinct URL, so a URL that holds a third of the rows is
expanded once; only (url, verdict) rows meet the page rows again, in a join
whose skewed side AQE can split.  Nothing is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_DIGITS = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased; path: then up to ``?``, ``#`` or the end.  A null URL or
    one without ``://`` has both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, action string")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row (id, host, path, rule, verdict) per input row.

    ``rules``: (host, path, action).  A rule fits its host and all its
    subdomains if the URL's path starts with the rule's path.  Among fitting
    rules the longest host + path wins; equally long ones by longer host,
    then ``block``, then text.  No fitting rule: rule null, verdict
    ``default``.  Null URLs, empty hosts, repeated rows and null ids each
    give one row; rules with a null part or an empty host fit nothing; other
    columns of ``pages`` are not read.
    """
    rules = rules.where("host is not null and host != '' and path is not null and action is not null").select(
        F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"),
        F.col("action").alias("r_action")).distinct()
    # At most one number for each path length that occurs among the rules.
    shape = rules.agg(F.max(F.size(F.split("r_host", r"\."))).alias("labels"),
                      F.collect_set(F.length("r_path")).alias("lengths")).first()
    labels, lengths = shape["labels"] or 0, sorted(shape["lengths"])

    rows = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias("_url"))
    host, path = host_and_path(F.col("_url"))
    parts = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
                       lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    starts = F.transform(fits, lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(ends, lambda h: F.transform(starts, lambda p: F.concat(h, p))))

    hashed = (rows.select("_url").where("_url is not null").distinct()
              .withColumns({"host": host, "path": path})
              .select("_url", F.explode(expressions).alias("expression"))
              .withColumn("digest", F.sha2("expression", 256))
              .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS)))
    rule = F.concat("r_host", "r_path")
    listed = (rules.withColumn("r_rule", rule).withColumn("r_digest", F.sha2("r_rule", 256))
              .withColumn("r_short", F.substring("r_digest", 1, PREFIX_DIGITS)))
    order = F.struct(F.length("r_rule"), F.length("r_host"), (F.col("r_action") == "block").alias("b"),
                     "r_rule", "r_action")
    best = (hashed.join(listed, F.col("short") == F.col("r_short"))
            .where("digest = r_digest")
            .groupBy(F.col("_url").alias("_hit")).agg(F.max(order).alias("_best")))
    return (rows.join(best, F.col("_url") == F.col("_hit"), "left")
            .select(id_col, host.alias("host"), path.alias("path"), F.col("_best.r_rule").alias("rule"),
                    F.coalesce("_best.r_action", F.lit(default)).alias("verdict")))
