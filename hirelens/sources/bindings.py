"""Deterministic job-market data derived from the driver tables.

The driver tables hold orders, customers and parts, not job postings.  These
bindings turn them into the reference's data model so every operator runs on
data that grows with the tables:

* ``star``      – the warehouse (fact_jobs, dim_companies, dim_skills,
                  bridge_job_skills) used by the reporting queries;
* ``raw_jobs``  – scraped-looking raw postings (HTML in titles, salary text,
                  descriptions) used by cleaning and the warehouse load;
* ``html_pages``– saved listing pages with job-card markup;
* ``url_batches`` – keyword batches of scraped urls for the dedupe rules.

The ``%`` expressions below shape values (inject NULLs, pick a salary
format, vary the markup); none of them filters rows: every binding uses
whole tables.  The DuckDB oracles in ``hirelens.oracle`` build the same tables
with the same rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.skills import SKILL_NAMES
from hirelens.sources.tables import Tables

# Fixed evaluation time of the bound reporting queries ("now").
AS_OF = "2001-07-30 12:00:00"

# Job titles per order priority.
TITLE_BY_PRIORITY = {
    "1-URGENT": "Senior Data Engineer",
    "2-HIGH": "DATA ENGINEER",
    "3-MEDIUM": "Backend Developer",
    "5-LOW": "QA Lead",
}
DEFAULT_TITLE = "DevOps Engineer"


@dataclass(frozen=True)
class Star:
    fact_jobs: DataFrame
    dim_companies: DataFrame
    dim_skills: DataFrame
    bridge_job_skills: DataFrame


def _s(c: Column) -> Column:
    return c.cast("string")


def _priority_title(prio: Column) -> Column:
    expr = None
    for p, title in TITLE_BY_PRIORITY.items():
        expr = (F.when(prio == p, title) if expr is None else expr.when(prio == p, title))
    return expr.otherwise(DEFAULT_TITLE)


def _orders_customers(t: Tables, with_nation: bool) -> DataFrame:
    """orders ⋈ customer (⋈ nation).  Customer grows with the data, so the
    join strategy is left to AQE's runtime size check; nation is the fixed
    25-row TPC-H table and is broadcast."""
    o = t("orders")
    c = t("customer")
    df = o.join(c, o.o_custkey == c.c_custkey)
    if with_nation:
        n = t("nation")
        df = df.join(F.broadcast(n), df.c_nationkey == n.n_nationkey)
    return df


def star(t: Tables) -> Star:
    k = F.col("o_orderkey")
    dim_companies = t("customer").select(
        F.col("c_custkey").alias("company_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
    )
    parts = t("part").select(
        F.col("p_partkey").alias("skill_id"),
        F.concat(F.col("p_name"), F.lit("#"), _s(F.col("p_partkey"))).alias("skill_name"),
    )
    # The skill dictionary joins the dimension with ids above every part key:
    # skills that no job requires (kept by the reports' left joins).
    top_part = t("part").select(F.max("p_partkey")).scalar()
    terms = t.spark.createDataFrame(list(enumerate(SKILL_NAMES, start=1)), "i int, skill_name string")
    dim_skills = parts.unionByName(terms.select((top_part + F.col("i")).alias("skill_id"), "skill_name"))
    bridge = (
        t("lineitem")
        .select(F.col("l_orderkey").alias("job_id"), F.col("l_partkey").alias("skill_id"))
        .distinct()
    )
    fact = _orders_customers(t, with_nation=True).select(
        k.alias("job_id"),
        F.col("o_custkey").alias("company_id"),
        F.concat(_priority_title(F.col("o_orderpriority")), F.lit(" "),
                 F.col("o_orderstatus")).alias("job_title"),
        F.concat(F.lit("https://jobs.example.com/"), _s(k)).alias("job_url"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("location"),
        F.when(k % 7 == 0, F.lit(None))
        .otherwise((F.lit(500) + k % 2503).cast("int")).alias("salary_min"),
        F.when((k % 7 == 0) | (k % 13 == 0), F.lit(None))
        .otherwise((F.lit(700) + k % 5501).cast("int")).alias("salary_max"),
        F.col("o_orderdate").alias("posted_date"),
        F.col("o_orderdate").alias("scraped_at"),
        (F.lit(1.0) - (k % 5) / F.lit(10.0)).cast("double").alias("data_quality_score"),
    )
    return Star(fact, dim_companies, dim_skills, bridge)


# The description snippets and salary formats of the raw binding.
DESCRIPTIONS = [
    "Python, JavaScript and good digital tools",
    "C++/C# with Google Cloud, Go",
    "NoSQL MySQL scalable Node.js",
    "nothing special",
    "Java, Java, java; ETL on Spark",
]


def skilled_documents(t: Tables) -> DataFrame:
    """The driver's documents as job texts: each begins with one of the
    descriptions and ends with the next one."""
    sentences = F.array(*[F.lit(d) for d in DESCRIPTIONS])
    k = F.pmod("doc_id", F.lit(len(DESCRIPTIONS))).cast("int")
    after = F.pmod(k + 1, F.lit(len(DESCRIPTIONS)))
    return t("documents").select("doc_id", F.concat(
        F.element_at(sentences, k + 1), F.lit(". "), "text", F.lit(" "), F.element_at(sentences, after + 1)).alias("text"))


def landed_postings(t: Tables) -> DataFrame:
    """Postings as they land over five days of landing: by their time, but one
    in seven a landing later, and one in five again in a later landing, some
    days or some years after (``landing``)."""
    k = F.col("job_id")
    at = F.col("scraped_at").try_cast("timestamp_ntz")
    period = F.floor((F.year(at) - 1995) / 3)
    first = raw_jobs(t).select("job_id", "url", at.alias("at"),
                               (period + F.when(k % 7 == 1, 1).otherwise(0)).cast("int").alias("landing"))
    later = F.when(k % 2 == 1, F.expr("at + INTERVAL 20 DAYS")).otherwise(F.expr("at + INTERVAL 900 DAYS"))
    again = first.where(k % 5 == 0).select(
        "job_id", "url", later.alias("at"), (F.col("landing") + 1 + F.when(k % 3 == 0, 1).otherwise(0)).alias("landing"))
    return first.unionByName(again).select(
        "job_id", "url", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"), "landing")


def raw_jobs(t: Tables) -> DataFrame:
    """Raw postings as the scraper would store them (RAW + id + description).

    Missing text is the literal "N/A", exactly as the scraper writes it.
    """
    k = F.col("o_orderkey")
    lo = _s(F.lit(500) + k % 900)
    hi = _s(F.lit(1500) + k % 900)
    salary = (
        F.when(k % 9 == 0, F.concat(F.lit("$"), lo, F.lit(" - $"), hi))
        .when(k % 9 == 1, F.concat(F.lit("$"), lo, F.lit("-$"), hi))
        .when(k % 9 == 2, F.lit("$1,000 - $2,500"))
        .when(k % 9 == 3, F.concat(F.lit("Up to $"), _s(k % 5000)))
        .when(k % 9 == 4, F.lit("N/A"))
        .when(k % 9 == 5, F.lit("Sign-in to view"))
        .when(k % 9 == 6, F.lit("1000 - 2000 USD"))
        .when(k % 9 == 7, F.lit(None).cast("string"))
        .otherwise(F.lit("$99999999999"))
    )
    desc = F.lit(DESCRIPTIONS[-1])
    for i in range(len(DESCRIPTIONS) - 2, -1, -1):
        desc = F.when(k % 5 == i, DESCRIPTIONS[i]).otherwise(desc)
    return _orders_customers(t, with_nation=True).select(
        k.alias("job_id"),
        F.when(k % 29 == 0, "N/A").otherwise(F.concat(
            F.lit("  <b>Senior</b>  "),
            F.when(k % 3 == 0, "Data<br>Engineer").otherwise("DEV   <i class=x>Ops</i>"),
            F.lit(" "), F.col("o_orderpriority"), F.lit(" "),
        )).alias("title"),
        F.when(k % 23 == 0, "N/A").otherwise(
            F.concat(F.lit("<a href=x>"), F.col("c_name"), F.lit("</a> "))).alias("company"),
        F.when(k % 11 == 0, F.lit("N/A"))
        .when(k % 4 == 0, F.concat(F.lit("City "), _s(F.col("n_regionkey")), F.lit(" , "), F.col("n_name")))
        .otherwise(F.col("n_name")).alias("location"),
        salary.alias("salary"),
        F.concat(F.lit("We use "), desc, F.lit(".")).alias("description_preview"),
        F.when(k % 17 == 0, F.lit("N/A"))
        .otherwise(F.concat(F.lit("/it-jobs/"), _s(k))).alias("url"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"),
        F.when(k % 3 == 0, F.array(F.lit("Java"), F.lit("SQL"))).when(k % 3 == 1, F.array(F.lit("Python")))
        .otherwise(F.array().cast("array<string>")).alias("skills"),
    )


# Orders per generated page: page = o_orderkey div PAGE_KEYS, so a page never
# holds more than PAGE_KEYS cards no matter how the data grows or skews.
PAGE_KEYS = 64


def card_html(k: Column, prio: Column, cname: Column, segment: Column) -> Column:
    """Markup of one job card (and, for k % 10 = 3, a wrapper that repeats it)."""
    card = F.concat(
        F.when(k % 4 == 0, F.lit('<div class="other">')).otherwise(F.lit('<div class="ipy-2 job-card">')),
        F.when(k % 3 == 0, F.lit("<h3>")).otherwise(
            F.concat(F.lit('<h3 data-url="/it-jobs/'), _s(k), F.lit('">'))),
        F.lit(' <a href="https://x.example/'), _s(k), F.lit('">'), F.when(k % 15 == 2, "N/A").otherwise(prio),
        F.lit("</a> </h3><br>"),
        F.lit('<a href="/companies/x"><img src=l></a><a href="/companies/x"> '), cname,
        F.lit(" &amp; Co</a>"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.lit('<div class="fw salary">$1 - $2</div>')),
        F.lit('<span class="text-nowrap text-rich-grey x text-truncate">'), segment, F.lit("</span>"),
        F.lit('<div data-controller="responsive-tag-list"><a>Java</a><a> SQL </a>'),
        F.when(k % 2 == 0, F.lit("<a>Spark</a>")).otherwise(F.lit("")), F.lit("</div>"),
        F.when(k % 6 == 1, F.lit("<form></form>")).otherwise(F.lit("")),
        F.lit("<p>"), F.when(k % 7 == 0, F.lit("")).otherwise(F.lit("lorem " * 10)), F.lit("</p></div>"),
    )
    return F.when(k % 10 == 3, F.concat(F.lit('<div class="jobs-list">'), card, F.lit("</div>"))).otherwise(card)


def article_cards(pages: DataFrame) -> DataFrame:
    """The driver's saved pages with each article marked up as a job card:
    its heading as the card's title.  (They hold no job cards themselves.)"""
    html = F.replace("html", F.lit("<article><h1>"), F.lit('<div class="job-card"><h3 data-url="/p">'))
    return pages.select("page_id", "url", F.replace(html, F.lit("</h1>"), F.lit("</h3>")).alias("html"))


def html_pages(t: Tables) -> DataFrame:
    """One listing page per block of PAGE_KEYS order keys, cards in key order.

    What a card is made of is shuffled and gathered; its markup, many times as
    long, is written when the page is.
    """
    o = t("orders")
    c = t("customer")
    cards = o.join(c, o.o_custkey == c.c_custkey).select(
        (F.col("o_orderkey") / PAGE_KEYS).cast("long").alias("page_id"),
        F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("prio"),
                 F.col("c_name").alias("cname"), F.col("c_mktsegment").alias("segment")).alias("card"),
    )
    # An explicit repartition on page_id (kept as is by AQE, and reused by the
    # aggregate) so that parsing the pages later runs on every core.
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    written = F.transform(F.collect_list("card"), lambda x: F.struct(
        x["k"].alias("k"), card_html(x["k"], x["prio"], x["cname"], x["segment"]).alias("html")))
    return cards.repartition(n, "page_id").groupBy("page_id").agg(
        F.concat(
            F.lit('<html><body><script>var t="<div class=job>";</script>'),
            F.array_join(F.transform(F.sort_array(written), lambda x: x["html"]), ""),
            F.lit("</body></html>"),
        ).alias("html")
    ).select(
        "page_id",
        F.concat(F.lit("https://jobs.example.com/page/"), _s(F.col("page_id"))).alias("url"),
        "html",
    )


def url_batches(t: Tables) -> DataFrame:
    """Scraped urls per keyword batch: (pos, batch_idx, url), NULL urls included."""
    return t("orders").select(
        F.col("o_orderkey").alias("pos"),
        (F.col("o_orderkey") % 5).alias("batch_idx"),
        F.when(F.col("o_custkey") % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("u"), _s(F.col("o_custkey")))).alias("url"),
    )
