"""Independent DuckDB SQL for every checked query (the correctness oracle).

Written against the driver's views (orders, customer, ...).  Rounding is
done in exact integer arithmetic here, so the oracle does not depend on how
either engine rounds a binary double:

* percent, 2 decimals, half-up:  (20000 n + d) // (2 d) / 100
* average, 0 decimals, half-up:  (2 s + c) // (2 c)
"""

from __future__ import annotations

from hirelens.sources.bindings import AS_OF, DESCRIPTIONS, PAGE_KEYS

# The skill terms in their order (SURVEY, C5), and their categories.
SKILL_TERMS = [
    "Python", "Java", "JavaScript", "TypeScript", "SQL", "NoSQL", "MongoDB", "PostgreSQL",
    "MySQL", "Spark", "Hadoop", "Hive", "Airflow", "Docker", "Kubernetes", "AWS",
    "Azure", "GCP", "Google Cloud", "Scala", "Go", "Rust", "C++", "C#",
    "React", "Vue", "Angular", "Node.js", "Django", "Flask", "FastAPI", "Spring",
    "Git", "Jenkins", "Elasticsearch", "Redis", "Kafka", "RabbitMQ", "Tableau",
    "Power BI", "Looker", "ETL", "Linux", "Unix", "REST API", "GraphQL", "Microservices",
    "Agile", "Scrum", "JIRA", "Pandas", "NumPy", "Scikit-learn", "TensorFlow", "PyTorch",
    "Machine Learning", "Deep Learning", "NLP", "Computer Vision",
]
CATEGORIES = {
    "Language": "Python,Java,JavaScript,TypeScript,Scala,Go,Rust,C++,C#",
    "Database": "SQL,NoSQL,MongoDB,PostgreSQL,MySQL,Redis,Elasticsearch",
    "Data": "Spark,Hadoop,Hive,Airflow,Kafka,ETL,Tableau,Power BI,Looker,Pandas,NumPy",
    "DevOps": "Docker,Kubernetes,Jenkins,Git,Linux,Unix",
    "Cloud": "AWS,Azure,GCP,Google Cloud",
    "Frontend": "React,Vue,Angular",
    "Backend": "Node.js,Django,Flask,FastAPI,Spring,RabbitMQ,REST API,GraphQL,Microservices",
    "AI/ML": "Scikit-learn,TensorFlow,PyTorch,Machine Learning,Deep Learning,NLP,Computer Vision",
    "Practice": "Agile,Scrum,JIRA",
}
CATEGORY = {t: c for c, terms in CATEGORIES.items() for t in terms.split(",")}
# The terms as regular expressions: only the signs of "C++" are escaped in the original list, "." stands for any sign.
COMPAT = "(?i)(" + "|".join(t.replace("+", r"\+") for t in SKILL_TERMS) + ")"
BEFORE, AFTER = "a-z0-9_", "a-z0-9_+#"
# The quality gate's messages.
GATE_PASSED = "Validation passed - Data available for processing"
GATE_WARNING = "Validation warning - Little or no data"


def literal_term(term: str) -> str:
    return "".join("\\" + c if c in "+.#-" else c for c in term.lower())


_TERMS = "VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(SKILL_TERMS, start=1))

STAR = f"""
dim_companies AS (SELECT c_custkey company_id, c_name company_name, c_mktsegment industry FROM customer),
dim_skills AS (SELECT p_partkey skill_id, concat(p_name, '#', cast(p_partkey AS varchar)) skill_name FROM part
  UNION ALL SELECT (SELECT max(p_partkey) FROM part) + i, skill_name FROM ({_TERMS}) terms(i, skill_name)),
bridge_job_skills AS (SELECT DISTINCT l_orderkey job_id, l_partkey skill_id FROM lineitem),
fact_jobs AS (
  SELECT o_orderkey job_id, o_custkey company_id,
    concat(CASE o_orderpriority WHEN '1-URGENT' THEN 'Senior Data Engineer' WHEN '2-HIGH' THEN 'DATA ENGINEER'
           WHEN '3-MEDIUM' THEN 'Backend Developer' WHEN '5-LOW' THEN 'QA Lead' ELSE 'DevOps Engineer' END,
           ' ', o_orderstatus) job_title,
    concat('https://jobs.example.com/', cast(o_orderkey AS varchar)) job_url,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE n_name END location,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE cast(500 + o_orderkey % 2503 AS int) END salary_min,
    CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 13 = 0 THEN NULL ELSE cast(700 + o_orderkey % 5501 AS int) END salary_max,
    o_orderdate posted_date, o_orderdate scraped_at,
    cast(1.0 - (o_orderkey % 5) / 10.0 AS double) data_quality_score
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def pct(n: str, d: str) -> str:
    return f"CAST((20000 * ({n}) + ({d})) // (2 * NULLIF({d}, 0)) AS DOUBLE) / 100"


def half_up(total: str, n: str) -> str:
    """total / n to a whole number, halves up."""
    return f"CAST((2 * ({total}) + ({n})) // (2 * NULLIF({n}, 0)) AS DOUBLE)"


def star(sql: str) -> str:
    """``sql`` is a SELECT, or further CTEs (beginning with a comma) and a SELECT."""
    return "WITH RECURSIVE " + STAR.strip() + sql


# Numbers that several reports need, each aggregated on ids before any name is joined.
_DEMAND = """,
demand AS (SELECT skill_id, count(*) AS jobs FROM bridge_job_skills GROUP BY skill_id),
every AS (SELECT count(*) AS jobs FROM fact_jobs)"""
_PAID = """,
paid AS (SELECT *, CAST(salary_min AS BIGINT) + salary_max AS mins_max FROM fact_jobs
         WHERE salary_min + salary_max IS NOT NULL)"""
_FIRMS = """,
firm AS (SELECT company_id, count(*) AS jobs, len(list_distinct(list(location))) AS places,
    count(*) FILTER (WHERE mins_max IS NOT NULL) AS priced, sum(mins_max // 2) AS middles,
    min(salary_min) FILTER (WHERE mins_max IS NOT NULL) AS least, max(salary_max) FILTER (WHERE mins_max IS NOT NULL) AS most
  FROM (SELECT *, CAST(salary_min AS BIGINT) + salary_max AS mins_max FROM fact_jobs) GROUP BY company_id)"""


def _per_location(more: str, condition: str, source: str = "fact_jobs") -> str:
    return f"""
SELECT location, {more} FROM (
  SELECT location, count(*) AS n, sum(salary_min) AS lows, count(salary_min) AS n_low, sum(salary_max) AS highs,
    count(salary_max) AS n_high FROM {source} GROUP BY location)
WHERE location IS NOT NULL{condition}"""


_BOUNDS = """(VALUES (NULL, NULL, 'Not disclosed'), (-2147483648, 999, 'Under 1000'), (1000, 1999, '1000 - 2000'),
  (2000, 2999, '2000 - 3000'), (3000, 3999, '3000 - 4000'), (4000, 4999, '4000 - 5000'),
  (5000, 2147483647, 'Above 5000')) AS bucket(lo, hi, label)"""

REPORTS = {
    "q01_top_skills": star(_DEMAND + f"""
SELECT skill_name, coalesce(demand.jobs, 0) AS job_count, {pct('coalesce(demand.jobs, 0)', 'every.jobs')} AS percentage
FROM every, dim_skills LEFT JOIN demand USING (skill_id) ORDER BY job_count DESC, skill_id LIMIT 20"""),
    "q02_salary_by_location": star(_PAID + _per_location(
        f"n AS total_jobs, {half_up('lows', 'n')} AS avg_min_salary, {half_up('highs', 'n')} AS avg_max_salary, "
        f"{half_up('lows + highs', '2 * n')} AS avg_midpoint", "", "paid")),
    "q03_top_companies": star(_FIRMS + f"""
SELECT company_name, jobs AS job_count, places AS locations_count, {half_up('middles', 'priced')} AS avg_salary
FROM (SELECT * FROM firm ORDER BY jobs DESC, company_id LIMIT 15) JOIN dim_companies USING (company_id)"""),
    "q04_skill_pairs": star(""",
needs AS (SELECT job_id, list_sort(list(skill_id)) AS ids FROM bridge_job_skills GROUP BY job_id),
heads AS (SELECT ids, unnest(range(1, len(ids))) AS i FROM needs),
pairs AS (SELECT ids[i] AS one, unnest(ids[i + 1:]) AS two FROM heads),
best AS (SELECT one, two, count(*) AS n FROM pairs GROUP BY ALL ORDER BY n DESC, one, two LIMIT 20)
SELECT a.skill_name AS skill_1, b.skill_name AS skill_2, n AS co_occurrence_count
FROM best JOIN dim_skills a ON a.skill_id = one JOIN dim_skills b ON b.skill_id = two"""),
    "q05_title_distribution": star(f"""
SELECT job_title, n AS job_count, {half_up('middles', 'priced')} AS avg_salary, len(firms) AS unique_companies
FROM (SELECT job_title, count(*) AS n, sum((salary_min + salary_max) // 2) AS middles,
        count(salary_min + salary_max) AS priced, list_distinct(list(company_id)) AS firms
      FROM fact_jobs GROUP BY job_title) ORDER BY n DESC, job_title LIMIT 20"""),
    "q06_location_popularity": star(f"""
SELECT location, n AS job_count, len(firms) AS unique_companies, {pct('n', 'total')} AS percentage
FROM (SELECT *, sum(n) OVER ()::BIGINT AS total FROM (
        SELECT location, count(*) AS n, list_distinct(list(company_id)) AS firms FROM fact_jobs GROUP BY location))
WHERE location IS NOT NULL ORDER BY n DESC, location LIMIT 15"""),
    "q07_salary_buckets": star(f"""
SELECT label AS salary_range, n AS job_count, {pct('n', 'disclosed')} AS percentage
FROM (SELECT label, count(*) AS n FROM fact_jobs JOIN {_BOUNDS}
        ON salary_max BETWEEN lo AND hi OR (salary_max IS NULL AND lo IS NULL) GROUP BY label),
     (SELECT count(salary_max) AS disclosed FROM fact_jobs)"""),
    "q08_data_quality": star(""",
counts AS (
  SELECT count(*) AS jobs, count(coalesce(salary_min, salary_max)) AS priced, count(location) AS placed,
    len(list_distinct(list(company_id))) AS firms, len(list_distinct(list(location))) AS places FROM fact_jobs),
named AS (SELECT unnest([('Total Jobs', jobs), ('Jobs with Salary Info', priced), ('Jobs with Location', placed),
    ('Unique Companies', firms), ('Unique Locations', places), ('Unique Skills Mentioned',
    (SELECT len(list_distinct(list(skill_id))) FROM bridge_job_skills))]) AS m FROM counts)
SELECT m[1] AS metric, m[2]::VARCHAR AS value FROM named"""),
    "q09_skills_for_title": star(f""",
wanted AS (SELECT job_id FROM fact_jobs WHERE contains(lower(job_title), 'data engineer')),
asked AS (SELECT skill_id, count(*) AS n FROM bridge_job_skills SEMI JOIN wanted USING (job_id) GROUP BY skill_id)
SELECT skill_name, n AS required_count, {pct('n', '(SELECT count(*) FROM wanted)')} AS percentage_required
FROM asked JOIN dim_skills USING (skill_id)"""),
    "q10_recent_jobs": star(f"""
SELECT job_title, company_name, location, salary_min, salary_max, posted_date
FROM (SELECT * FROM fact_jobs WHERE date_diff('day', posted_date, TIMESTAMP '{AS_OF}') <= 7
      ORDER BY posted_date DESC, job_id LIMIT 20) JOIN dim_companies USING (company_id)"""),
    "q11_company_salary": star(_FIRMS + f"""
SELECT company_name, priced AS job_count, most AS max_salary, {half_up('middles', 'priced')} AS avg_salary,
  least AS min_salary
FROM firm JOIN dim_companies USING (company_id) WHERE priced > 0 ORDER BY avg_salary DESC, company_id LIMIT 20"""),
    "q12_export_jobs": star(""",
newest AS (SELECT * FROM fact_jobs ORDER BY posted_date DESC, job_id LIMIT 100),
skilled AS (SELECT job_id, array_to_string(list_sort(list(skill_name)), ', ') AS required_skills
  FROM bridge_job_skills SEMI JOIN newest USING (job_id) JOIN dim_skills USING (skill_id) GROUP BY job_id)
SELECT job_id, job_title, company_name, location, salary_min, salary_max, required_skills
FROM newest JOIN dim_companies USING (company_id) LEFT JOIN skilled USING (job_id)"""),
    "q13_scrape_status": star(f"""
SELECT max(scraped_at) FILTER (WHERE fresh) AS last_scrape_time, count(*) FILTER (WHERE fresh) AS jobs_added,
  round(avg(data_quality_score) FILTER (WHERE fresh), 2) AS avg_quality
FROM (SELECT *, coalesce(scraped_at + INTERVAL 24 HOUR >= TIMESTAMP '{AS_OF}', false) AS fresh FROM fact_jobs)"""),
    "q14_missing_fields": star("""
SELECT job_id, job_title, lacks[1] AS missing_field_1, lacks[2] AS missing_field_2, lacks[3] AS missing_field_3
FROM (SELECT job_id, job_title, [if(salary_min IS NULL, 'Missing salary_min', ''),
        if(location IS NULL, 'Missing location', ''), if(company_id IS NULL, 'Missing company', '')] AS lacks
      FROM fact_jobs)
WHERE len(array_to_string(lacks, '')) > 0 ORDER BY job_id LIMIT 20"""),
    "v1_top_skills": star(_DEMAND + f"""
SELECT skill_name, coalesce(demand.jobs, 0) AS skill_count,
  {pct('coalesce(demand.jobs, 0)', 'every.jobs')} AS skill_percentage
FROM every, dim_skills LEFT JOIN demand USING (skill_id)"""),
    "v2_salary_by_company": star(_PAID + f"""
SELECT company_name, n AS job_count, {half_up('lows', 'n')} AS avg_salary_min, {half_up('highs', 'n')} AS avg_salary_max,
  {half_up('lows + highs', '2 * n')} AS avg_salary_midpoint
FROM (SELECT company_id, count(*) AS n, sum(salary_min) AS lows, sum(salary_max) AS highs FROM paid GROUP BY company_id)
  JOIN dim_companies USING (company_id)"""),
    "v3_jobs_by_location": star(_per_location(
        f"n AS job_count, {half_up('lows', 'n_low')} AS avg_salary_min, {half_up('highs', 'n_high')} AS avg_salary_max", "")),
    "v4_skills_by_location": star(""",
counted AS (SELECT location, skill_id, count(*) AS n
  FROM bridge_job_skills JOIN (SELECT job_id, location FROM fact_jobs WHERE location IS NOT NULL) USING (job_id)
  GROUP BY ALL)
SELECT location, skill_name, n AS skill_count FROM counted JOIN dim_skills USING (skill_id)"""),
}

ORACLES: dict[str, str] = {}
ORACLES.update(REPORTS)


# ------------------------------------------------------------------ cleaning

def _desc_case() -> str:
    whens = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DESCRIPTIONS[:-1]))
    return f"CASE o_orderkey % 5 {whens} ELSE '{DESCRIPTIONS[-1]}' END"


RAW = f"""
raw_jobs AS (
  SELECT o_orderkey job_id,
    CASE WHEN o_orderkey % 29 = 0 THEN 'N/A' ELSE
      concat('  <b>Senior</b>  ', CASE WHEN o_orderkey % 3 = 0 THEN 'Data<br>Engineer' ELSE 'DEV   <i class=x>Ops</i>' END,
             ' ', o_orderpriority, ' ') END title,
    CASE WHEN o_orderkey % 23 = 0 THEN 'N/A' ELSE concat('<a href=x>', c_name, '</a> ') END company,
    CASE WHEN o_orderkey % 11 = 0 THEN 'N/A' WHEN o_orderkey % 4 = 0
      THEN concat('City ', n_regionkey, ' , ', n_name) ELSE n_name END location,
    CASE o_orderkey % 3 WHEN 0 THEN ['Java', 'SQL'] WHEN 1 THEN ['Python'] ELSE [] END skills,
    CASE o_orderkey % 9
      WHEN 0 THEN concat('$', cast(500 + o_orderkey % 900 AS varchar), ' - $', cast(1500 + o_orderkey % 900 AS varchar))
      WHEN 1 THEN concat('$', cast(500 + o_orderkey % 900 AS varchar), '-$', cast(1500 + o_orderkey % 900 AS varchar))
      WHEN 2 THEN '$1,000 - $2,500' WHEN 3 THEN concat('Up to $', cast(o_orderkey % 5000 AS varchar))
      WHEN 4 THEN 'N/A' WHEN 5 THEN 'Sign-in to view' WHEN 6 THEN '1000 - 2000 USD' WHEN 7 THEN NULL
      ELSE '$99999999999' END salary,
    concat('We use ', {_desc_case()}, '.') description_preview,
    CASE WHEN o_orderkey % 17 = 0 THEN 'N/A' ELSE concat('/it-jobs/', cast(o_orderkey AS varchar)) END url,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') scraped_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def raw(sql: str, *more_ctes: str) -> str:
    ctes = [RAW.strip()] + [c.strip() for c in more_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + sql


def clean_sql(c: str) -> str:
    return f"lower(trim(regexp_replace(regexp_replace({c}, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')))"


def smin_sql(s: str) -> str:
    return f"CASE WHEN contains({s}, '$') THEN try_cast(regexp_extract({s}, '\\$(\\d+)', 1) AS INTEGER) END"


def smax_sql(s: str) -> str:
    return (f"CASE WHEN contains({s}, '-') THEN try_cast(regexp_extract({s}, '\\$\\d+\\s*-\\s*\\$(\\d+)', 1) AS INTEGER)"
            f" ELSE {smin_sql(s)} END")


_STRIPPED = "regexp_replace(salary, '(\\d),(\\d{3})', '\\1\\2', 'g')"
_AS_OF_ISO = AS_OF.replace(" ", "T")
_PRESENT = ["(title IS NOT NULL AND title <> 'N/A')", "(company IS NOT NULL AND company <> 'N/A')",
            "(location IS NOT NULL AND location <> 'N/A')", "(salary_min IS NOT NULL)",
            "(url IS NOT NULL AND url <> 'N/A')"]


def _skill_terms_values() -> str:
    rows = ", ".join(f"('{n}', '{literal_term(n)}')" for n in SKILL_TERMS)
    return f"skill_terms(skill, term) AS (VALUES {rows})"


def _sentence(number: str) -> str:
    listed = ", ".join(f"'{d}'" for d in DESCRIPTIONS)
    return f"([{listed}])[({number}) % {len(DESCRIPTIONS)} + 1]"


_BOUNDED_MATCH = (f"regexp_matches(lower(r.description_preview), '(^|[^{BEFORE}])' || t.term || "
                  f"'([^{AFTER}]|$)')")

CLEANING = {
    "normalize_url": raw("""
SELECT job_id, url, CASE WHEN url IS NOT NULL AND url <> '' AND url <> 'N/A' AND NOT starts_with(url, 'http')
  THEN concat('https://jobs.example.com', url) ELSE url END AS job_url FROM raw_jobs"""),
    "clean_text": raw(f"SELECT job_id, {clean_sql('title')} AS title, {clean_sql('company')} AS company FROM raw_jobs"),
    "normalize_salary": raw(f"SELECT job_id, salary, {smin_sql('salary')} AS salary_min, "
                            f"{smax_sql('salary')} AS salary_max FROM raw_jobs"),
    "normalize_salary_strict": raw(f"SELECT job_id, salary, {smin_sql(_STRIPPED)} AS salary_min, "
                                   f"{smax_sql(_STRIPPED)} AS salary_max FROM raw_jobs"),
    "skills_compat": raw(f"SELECT job_id, unnest(regexp_extract_all(lower(description_preview), '{COMPAT}', 1)) AS skill "
                         f"FROM raw_jobs"),
    "skills_bounded": raw(f"SELECT r.job_id, t.skill FROM raw_jobs r JOIN skill_terms t ON {_BOUNDED_MATCH}",
                          _skill_terms_values()),
    "skills_exploded_outer": raw(f"SELECT r.job_id, t.skill FROM raw_jobs r LEFT JOIN skill_terms t ON {_BOUNDED_MATCH}",
                                 _skill_terms_values()),
    "job_skill_sets": raw(f"""
SELECT job_id, array_to_string(found, ',') AS skills, CAST(len(found) AS INTEGER) AS skill_count
FROM (SELECT job_id, list_sort(list_distinct(regexp_extract_all(lower(description_preview), '{COMPAT}', 1))) AS found
      FROM raw_jobs)"""),
    "document_clean_text": f"SELECT doc_id, {clean_sql('text')} AS text FROM documents",
    "document_skill_sets": f"""
SELECT doc_id, array_to_string(found, ',') AS skills, CAST(len(found) AS INTEGER) AS skill_count
FROM (SELECT doc_id, list_sort(list_distinct(regexp_extract_all(lower(text), '{COMPAT}', 1))) AS found FROM documents)""",
    "document_skills_bounded": f"""
WITH {_skill_terms_values()},
texts AS (SELECT doc_id, {_sentence('doc_id')} || '. ' || text || ' ' || {_sentence('doc_id + 1')} AS text FROM documents)
SELECT doc_id, skill FROM texts r JOIN skill_terms t
  ON regexp_matches(lower(r.text), '(^|[^{BEFORE}])' || t.term || '([^{AFTER}]|$)')""",
    "add_metadata": raw(f"""
SELECT job_id, '{_AS_OF_ISO}' AS processed_at,
  CAST(({' + '.join(f'CAST({p} AS INTEGER)' for p in _PRESENT)}) / 5.0 AS DOUBLE) AS data_quality_score
FROM (SELECT job_id, title, company, location, url, {smin_sql('salary')} AS salary_min FROM raw_jobs)"""),
    "processed_postings": raw(f"""
SELECT job_id, {clean_sql('title')} AS title, {clean_sql('company')} AS company, location, url, scraped_at,
  {smin_sql('salary')} AS salary_min, {smax_sql('salary')} AS salary_max,
  '{_AS_OF_ISO}' AS processed_at, CAST(1.0 AS DOUBLE) AS data_quality_score
FROM raw_jobs"""),
}
ORACLES.update(CLEANING)


# ----------------------------------------------------------------- warehouse

def _skill_dim_values() -> str:
    rows = ", ".join(f"({i + 1}, '{n}', '{CATEGORY[n]}', '{literal_term(n)}')"
                     for i, n in enumerate(SKILL_TERMS))
    return f"skill_terms(skill_id, skill_name, skill_category, term) AS (VALUES {rows})"


_TS = f"TIMESTAMP '{AS_OF}'"
_NF = " NULLS FIRST"
_STAGED = f"""
staged AS (
  SELECT NULLIF(title, 'N/A') job_title, NULLIF(company, 'N/A') company_name, NULLIF(location, 'N/A') location,
    NULLIF(salary, 'N/A') salary, description_preview,
    CASE WHEN u IS NOT NULL AND u <> '' AND u <> 'N/A' AND NOT starts_with(u, 'http')
         THEN concat('https://jobs.example.com', u) ELSE u END job_url,
    'job-board' source, try_cast(scraped_at AS TIMESTAMP) scraped_at, {_TS} created_at
  FROM (SELECT *, NULLIF(url, 'N/A') u FROM raw_jobs)),
staging_raw_jobs AS (
  SELECT row_number() OVER (ORDER BY job_url{_NF}, scraped_at{_NF}, job_title{_NF}, company_name{_NF},
           location{_NF}, salary{_NF}, description_preview{_NF}) staging_id, *
  FROM staged),
prepared AS (
  SELECT staging_id, NULLIF({clean_sql('job_title')}, '') job_title,
    coalesce(NULLIF({clean_sql('company_name')}, ''), 'N/A') company_name,
    location, {smin_sql('salary')} salary_min, {smax_sql('salary')} salary_max, job_url, scraped_at, description_preview
  FROM staging_raw_jobs)"""

_LOADED = _STAGED + f""",
dim_companies AS (
  SELECT row_number() OVER (ORDER BY company_name) company_id, company_name, CAST(NULL AS VARCHAR) industry,
    {_TS} created_at
  FROM (SELECT DISTINCT company_name FROM prepared WHERE company_name IS NOT NULL)),
fact_text AS (
  SELECT row_number() OVER (ORDER BY p.staging_id) job_id, c.company_id, p.job_title, p.job_url, p.location,
    p.salary_min, p.salary_max, {_TS} posted_date, p.scraped_at, {_TS} processed_at,
    CAST(1.0 AS DOUBLE) data_quality_score, p.description_preview
  FROM prepared p JOIN dim_companies c ON p.company_name = c.company_name WHERE p.job_title IS NOT NULL),
fact_jobs AS (SELECT * EXCLUDE (description_preview) FROM fact_text),
{_skill_dim_values()},
dim_skills AS (SELECT CAST(skill_id AS BIGINT) skill_id, skill_name, skill_category, {_TS} created_at FROM skill_terms),
bridge_job_skills AS (
  SELECT row_number() OVER (ORDER BY f.job_id, t.skill_id) job_skill_id, f.job_id, CAST(t.skill_id AS BIGINT) skill_id
  FROM fact_text f JOIN skill_terms t ON regexp_matches(lower(f.description_preview),
       '(^|[^{BEFORE}])' || t.term || '([^{AFTER}]|$)')),
dim_locations AS (
  SELECT row_number() OVER (ORDER BY location_name) location_id, location_name,
    NULLIF(trim(split_part(location_name, ',', 1)), '') city,
    NULLIF(trim(split_part(location_name, ',', 2)), '') country, {_TS} created_at
  FROM (SELECT DISTINCT location location_name FROM prepared WHERE job_title IS NOT NULL AND location IS NOT NULL))"""


def loaded(sql: str) -> str:
    return raw(sql, _LOADED)


def loaded_report(name: str) -> str:
    """A report over the loaded tables instead of the bound star."""
    rest = REPORTS[name][len("WITH RECURSIVE " + STAR.strip()):]
    return "WITH " + RAW.strip() + ",\n" + _LOADED.strip() + rest


# The warehouse's rules by table: columns that must be set, unique keys, and most characters (SURVEY, D8).
RULES = {
    "fact_jobs": ("job_id company_id job_title", ["job_id"], {"job_title": 255, "job_url": 500, "location": 100}),
    "dim_companies": ("company_id company_name", ["company_id", "company_name"], {"company_name": 255, "industry": 100}),
    "dim_skills": ("skill_id skill_name", ["skill_id", "skill_name"], {"skill_name": 100, "skill_category": 50}),
    "bridge_job_skills": ("job_skill_id job_id skill_id", ["job_skill_id", "job_id, skill_id"], {}),
    "dim_locations": ("location_id location_name", ["location_id", "location_name"],
                      {"location_name": 100, "city": 50, "country": 50}),
    "staging_raw_jobs": ("staging_id", ["staging_id"],
                         {"job_title": 255, "company_name": 255, "location": 100, "salary": 100, "job_url": 500,
                          "source": 50}),
}
_PARENTS = [("fact_jobs", "company_id", "dim_companies"), ("bridge_job_skills", "job_id", "fact_jobs"),
            ("bridge_job_skills", "skill_id", "dim_skills")]


def _violations_sql(tables: str, lacking: str = "") -> str:
    """Violation counts of the named tables; ``lacking``: columns that they don't have."""
    parts, names, gone = [], tables.split(), lacking.split()
    for t in names:
        needed, unique, limits = RULES[t]
        bad = [(f"{c} not null", f"{c} IS NULL") for c in needed.split() if c not in gone]
        bad += [(f"{c} length <= {n}", f"len({c}) > {n}") for c, n in limits.items() if c not in gone]
        parts += [f"SELECT '{t}.{what}' AS check_name, count(*) FILTER (WHERE {cond}) AS violations FROM {t}"
                  for what, cond in bad]
        for key in unique:
            if key not in gone:
                set_ = " AND ".join(f"{c} IS NOT NULL" for c in key.split(", "))
                parts.append(f"SELECT '{t}({key}) unique', (count(*) - count(DISTINCT ({key})))::BIGINT "
                             f"FROM {t} WHERE {set_}")
    for child, c, parent in _PARENTS:
        if child in names and parent in names:
            parts.append(f"SELECT '{child}.{c} -> {parent}.{c}', count(*) FROM {child} "
                         f"ANTI JOIN {parent} USING ({c}) WHERE {c} IS NOT NULL")
    return "\n" + "\nUNION ALL ".join(parts)


_STAR_TABLES = "fact_jobs dim_companies dim_skills bridge_job_skills"

_STAGING_COLS = ("staging_id, job_title, company_name, location, salary, description_preview, job_url, source, "
                 "scraped_at, created_at")

_PLANTED = star(""",
planted_companies AS (SELECT company_id, CASE WHEN company_id % 7 = 0 THEN NULL ELSE company_name END company_name,
    repeat(industry, CASE WHEN company_id % 11 = 0 THEN 20 ELSE 1 END) industry FROM dim_companies
  UNION ALL SELECT company_id, company_name, industry FROM dim_companies WHERE company_id % 13 = 0),
planted_jobs AS (SELECT job_id, company_id, job_title, repeat(job_url, CASE WHEN job_id % 9 = 0 THEN 40 ELSE 1 END) job_url,
    repeat(location, CASE WHEN job_id % 10 = 0 THEN 40 ELSE 1 END) location FROM fact_jobs
  UNION ALL SELECT job_id, NULL, NULL, job_url, location FROM fact_jobs WHERE job_id % 5 = 0
  UNION ALL SELECT -job_id, -company_id, job_title, job_url, location FROM fact_jobs WHERE job_id % 6 = 0),
planted_bridge AS (SELECT job_id * 1000000 + skill_id AS job_skill_id, job_id, skill_id FROM bridge_job_skills
  UNION ALL SELECT job_id, job_id, -skill_id FROM bridge_job_skills WHERE job_id % 8 = 0
  UNION ALL SELECT NULL, NULL, skill_id FROM bridge_job_skills WHERE job_id % 12 = 0),
planted_locations AS (SELECT company_id AS location_id, location AS location_name, repeat('c', 51) AS city,
    'x' AS country FROM fact_jobs)
""" + _violations_sql("fact_jobs dim_companies bridge_job_skills dim_locations")
    .replace("FROM fact_jobs", "FROM planted_jobs").replace("JOIN fact_jobs", "JOIN planted_jobs")
    .replace("dim_companies USING", "planted_companies USING").replace("FROM dim_companies", "FROM planted_companies")
    .replace("FROM bridge_job_skills", "FROM planted_bridge").replace("FROM dim_locations", "FROM planted_locations"))

def _run_violations_sql(added: dict[str, str], held: dict[str, str]) -> str:
    """Violations of the rows that ``added`` names by table, beside those of ``held``."""
    parts = []
    for t, new in added.items():
        needed, unique, limits = RULES[t]
        for what, bad in [(f"{c} not null", f"{c} IS NULL") for c in needed.split()] + [
                (f"{c} length <= {n}", f"len({c}) > {n}") for c, n in limits.items()]:
            parts.append(f"SELECT '{t}.{what}' AS check_name, count(*) FILTER (WHERE {bad}) AS violations FROM {new}")
        for key in unique:
            set_ = " AND ".join(f"{c} IS NOT NULL" for c in key.split(", "))
            parts.append(f"SELECT '{t}({key}) unique', (SELECT count(*) FROM {new} WHERE {set_}) - (SELECT count(*) FROM "
                         f"(SELECT {key} FROM {new} WHERE {set_} EXCEPT SELECT {key} FROM {held[t]}))")
    for child, c, parent in _PARENTS:
        known = " UNION ALL ".join(f"SELECT {c} FROM {side[parent]}" for side in (added, held) if parent in side)
        parts.append(f"SELECT '{child}.{c} -> {parent}.{c}', count(*) FROM {added[child]} "
                     f"ANTI JOIN ({known}) known USING ({c}) WHERE {c} IS NOT NULL")
    return "\n" + "\nUNION ALL ".join(parts)


_PLANTED_RUN = star(""",
b AS (SELECT job_id * 1000 + skill_id AS job_skill_id, job_id, skill_id FROM bridge_job_skills),
f AS (SELECT job_id, company_id, job_title, job_url, location FROM fact_jobs),
c AS (SELECT company_id, company_name, industry FROM dim_companies),
old_jobs AS (SELECT * FROM f WHERE job_id % 3 > 0), old_companies AS (SELECT * FROM c WHERE company_id % 4 > 0),
old_skills AS (SELECT * FROM dim_skills WHERE skill_id % 9 > 0), old_bridge AS (SELECT * FROM b WHERE job_id % 3 > 0),
new_jobs AS (SELECT * FROM f WHERE job_id % 3 = 0 UNION ALL SELECT * FROM f WHERE job_id % 5 = 0
  UNION ALL SELECT -job_id, -company_id, job_title, job_url, location FROM f WHERE job_id % 6 = 0),
new_companies AS (SELECT * FROM c WHERE company_id % 8 = 4 UNION ALL SELECT * FROM c WHERE company_id % 13 = 0
  UNION ALL SELECT -company_id, company_name, industry FROM c WHERE company_id % 17 = 0),
new_bridge AS (SELECT * FROM b WHERE job_id % 3 = 0 UNION ALL SELECT * FROM b WHERE job_id % 8 = 0
  UNION ALL SELECT job_skill_id, CASE WHEN job_id % 2 = 0 THEN job_id + 1000000000 END, skill_id FROM b WHERE job_id % 7 = 0)
""" + _run_violations_sql(
    {"fact_jobs": "new_jobs", "dim_companies": "new_companies", "bridge_job_skills": "new_bridge"},
    {"fact_jobs": "old_jobs", "dim_companies": "old_companies", "bridge_job_skills": "old_bridge",
     "dim_skills": "old_skills"}))

WAREHOUSE = {
    "stage_jobs": raw(f"SELECT {_STAGING_COLS} FROM staging_raw_jobs", _STAGED),
    "stage_jobs_copies": raw(f"SELECT {_STAGING_COLS} FROM staging_raw_jobs", _STAGED),
    "upsert_companies": raw(f"""
SELECT company_id, company_name, industry, CAST(NULL AS TIMESTAMP) created_at FROM known
UNION ALL
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY company_name), company_name,
  CAST(NULL AS VARCHAR), {_TS}
FROM (SELECT DISTINCT company_name FROM prepared WHERE company_name IS NOT NULL
      AND company_name NOT IN (SELECT company_name FROM known))""", _STAGED, """
known AS (SELECT c_custkey company_id, c_mktsegment industry,
  CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) ELSE c_name END company_name FROM customer)"""),
    "load_fact": loaded("SELECT * FROM fact_jobs"),
    "load_bridge": loaded("SELECT * FROM bridge_job_skills"),
    "load_locations": loaded("SELECT * FROM dim_locations"),
    "loaded_top_skills": loaded_report("q01_top_skills"),
    "loaded_salary_buckets": loaded_report("q07_salary_buckets"),
    "summarised_top_skills": loaded_report("q01_top_skills"),
    "summarised_data_quality": loaded_report("q08_data_quality"),
    "loaded_constraint_violations": loaded(_violations_sql(" ".join(RULES))),
    "constraint_violations": star(_violations_sql(_STAR_TABLES, "skill_category job_skill_id")),
    "planted_violations": _PLANTED,
    "planted_run_violations": _PLANTED_RUN,
    "loaded_and_rejected": loaded("""
SELECT (SELECT count(*) FROM staging_raw_jobs) AS staged, (SELECT count(*) FROM fact_jobs) AS loaded,
  (SELECT count(*) FROM prepared WHERE job_title IS NULL) AS rejected,
  (SELECT count(*) FROM fact_jobs JOIN dim_companies USING (company_id) WHERE company_name = 'N/A') AS without_company"""),
    "cascade_delete_jobs": star("""
SELECT job_id, company_id FROM fact_jobs WHERE posted_date >= TIMESTAMP '1995-07-01 00:00:00' OR posted_date IS NULL"""),
    "cascade_delete": star("""
SELECT job_id, skill_id FROM bridge_job_skills
WHERE job_id NOT IN (SELECT job_id FROM fact_jobs WHERE posted_date < TIMESTAMP '1995-07-01 00:00:00')"""),
    "skill_category_demand": loaded("""
SELECT ds.skill_category, count(DISTINCT b.job_id) AS job_count
FROM bridge_job_skills b JOIN dim_skills ds ON b.skill_id = ds.skill_id GROUP BY ds.skill_category"""),
}
ORACLES.update(WAREHOUSE)


# -------------------------------------------------------------------- ingest

_CARD_ROWS = f"""
cards AS (
  SELECT o_orderkey // {PAGE_KEYS} page_id, o_orderkey k,
    CASE WHEN o_orderkey % 15 = 2 THEN 'N/A' ELSE o_orderpriority END prio, c_name, c_mktsegment seg
  FROM orders JOIN customer ON o_custkey = c_custkey),
valid AS (
  SELECT *, unnest(CASE WHEN k % 10 = 3 THEN [0, 1] ELSE [0] END) dup FROM cards
  WHERE k % 4 <> 0 AND k % 6 <> 1
    AND length(prio) + 2 + length(c_name) + 6 + (CASE WHEN k % 5 = 0 THEN 0 ELSE 7 END) + length(seg) + 9
        + (CASE WHEN k % 2 = 0 THEN 5 ELSE 0 END) + (CASE WHEN k % 7 = 0 THEN 0 ELSE 60 END) > 50),
ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY k, dup) pos FROM valid),
job_cards AS (
SELECT page_id, CAST(pos AS INTEGER) AS pos, prio AS title,
  CASE WHEN k % 3 = 0 THEN concat('https://x.example/', k) ELSE concat('https://jobs.example.com/it-jobs/', k) END AS url,
  concat(c_name, ' & Co') AS company, seg AS location,
  CASE WHEN k % 5 = 0 THEN 'N/A' ELSE '$1 - $2' END AS salary,
  CASE WHEN k % 2 = 0 THEN 'Java,SQL,Spark' ELSE 'Java,SQL' END AS skills, '{_AS_OF_ISO}' AS scraped_at
FROM ranked WHERE pos <= 40)"""
_CARDS = f"WITH {_CARD_ROWS} SELECT * FROM job_cards"

_DAILY = f"""WITH {_CARD_ROWS},
daily AS (SELECT *, page_id % 2 AS day FROM job_cards WHERE title <> 'N/A')
SELECT CASE day WHEN 0 THEN '2001-07-30' ELSE '2001-07-31' END AS run_id,
  row_number() OVER (ORDER BY day, url, title, company, location, salary) AS job_id, lower(title) AS job_title,
  lower(company) AS company_name, location, CASE WHEN salary = 'N/A' THEN NULL ELSE 1 END::INTEGER AS salary_min,
  CASE WHEN salary = 'N/A' THEN NULL ELSE 2 END::INTEGER AS salary_max, 0::BIGINT AS violations
FROM daily"""

_MARK = "(contains(html, 'Verify you are human') OR contains(html, 'Just a moment'))"
_WAIT = "(contains(html, 'Just a moment') OR contains(html, 'Checking your browser'))"
_URLS = """
WITH u AS (SELECT o_orderkey pos, o_orderkey % 5 batch_idx,
  CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE concat('u', cast(o_custkey AS varchar)) END url FROM orders)
"""
_STATS = raw("""
SELECT count(*) AS total_jobs,
  count(DISTINCT company) + max(CAST(company IS NULL AS INTEGER)) AS unique_companies,
  count(DISTINCT location) + max(CAST(location IS NULL AS INTEGER)) AS unique_locations,
  '""" + _AS_OF_ISO + "' AS last_scraped FROM raw_jobs")
_REPORT_FMT = ("\n        ===== ETL Pipeline Report =====\n        Execution Date: %s\n\n        Scraping Results:\n"
               "        - Total Jobs: %d\n        - Unique Companies: %d\n        - Unique Locations: %d\n\n"
               "        Status: %s\n        ")
_FACT_COLS = ["job_id", "company_id", "job_title", "job_url", "location", "salary_min", "salary_max",
              "posted_date", "scraped_at", "data_quality_score"]

INGEST = {
    "job_cards": _CARDS,
    "valid_cards": _CARDS + " WHERE title <> 'N/A'",
    "daily_runs": _DAILY,
    "page_cards": """
SELECT page_id, 1::INTEGER AS pos, trim(replace(replace(replace(
    regexp_extract(html, '<article><h1>(.*?)</h1>', 1), '&quot;', '"'), '&lt;', '<'), '&amp;', '&')) AS title,
  'https://jobs.example.com/p' AS url, 'N/A' AS company, CAST(NULL AS VARCHAR) AS parse_error
FROM pages
WHERE contains(html, '<article><h1>') AND length(regexp_replace(regexp_extract(html, '(?s)<article>(.*)', 1),
  '<[^>]*>|&[a-z]*;', '', 'g')) > 50""",
    "created_tables": """
SELECT unnest(['dim_companies', 'fact_jobs', 'dim_skills', 'bridge_job_skills', 'dim_locations', 'staging_raw_jobs'])
    AS table_name, true AS created, false AS created_again,
  unnest([0, (SELECT count(*) FROM orders), 0, 0, 0, 0])::BIGINT AS n_rows""",
    "view_top_skills": star(_DEMAND + """
SELECT skill_name, jobs AS skill_count FROM demand JOIN dim_skills USING (skill_id)"""),
    "purge": raw("""
SELECT unnest(['raw_jobs', 'jobs_without_salary']) AS collection,
  unnest([count(*), count(*) FILTER (WHERE salary IS NULL)]) AS deleted, 0::BIGINT AS left FROM raw_jobs""").replace(
        "AS left", 'AS "left"'),
    "stats_json": _STATS.replace("SELECT count(*) AS total_jobs,", """SELECT '{"total_jobs":' || total_jobs
  || ',"unique_companies":' || unique_companies || ',"unique_locations":' || unique_locations
  || ',"last_scraped":"' || last_scraped || '"}' AS stats FROM (SELECT count(*) AS total_jobs,""", 1) + ")",
    "page_triage": f"""
SELECT page_id, CAST(length(html) AS INTEGER) AS n_chars, {_MARK} AND length(html) <= 100000 AS is_challenge,
  {_WAIT} AS needs_wait, length(html) < 30000 AS is_short,
  CASE WHEN {_MARK} AND length(html) <= 100000 THEN 'challenge' WHEN length(html) < 30000 THEN 'short'
       ELSE 'ok' END AS page_status
FROM pages""",
    "dedupe_cross_batch": _URLS + """
SELECT pos, batch_idx, url FROM u
WHERE batch_idx = (SELECT min(batch_idx) FROM u u2 WHERE u2.url IS NOT DISTINCT FROM u.url)""",
    "dedupe_strict": _URLS + """
SELECT pos, batch_idx, url FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY batch_idx, pos) rn FROM u) WHERE rn = 1""",
    "raw_statistics": _STATS,
    "null_profile": star("\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS total_rows, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) AS null_rate FROM fact_jobs"
        for c in _FACT_COLS)),
    "salary_quartiles": star("""
SELECT q1, q3, q3 - q1 AS iqr, q1 - (q3 - q1) * 1.5 AS lower_fence, q3 + (q3 - q1) * 1.5 AS upper_fence
FROM (SELECT quantile_cont(salary_max, 0.25) q1, quantile_cont(salary_max, 0.75) q3 FROM fact_jobs)"""),
    "salary_outliers": star("""
SELECT job_id, salary_min, salary_max,
  coalesce(salary_max < f.lo OR salary_max > f.hi, false) AS outside_fence,
  coalesce(salary_min > salary_max, false) AS min_above_max
FROM fact_jobs, (SELECT q1 - (q3 - q1) * 1.5 lo, q3 + (q3 - q1) * 1.5 hi FROM
   (SELECT quantile_cont(salary_max, 0.25) q1, quantile_cont(salary_max, 0.75) q3 FROM fact_jobs)) f
WHERE coalesce(salary_max < f.lo OR salary_max > f.hi, false) OR coalesce(salary_min > salary_max, false)"""),
}
INGEST["quality_gate"] = _STATS.replace(
    "SELECT count(*) AS total_jobs,", "SELECT total_jobs, total_jobs > 0 AS passed, CASE WHEN total_jobs > 0 THEN "
    f"'{GATE_PASSED}' ELSE '{GATE_WARNING}' END AS message "
    "FROM (SELECT count(*) AS total_jobs,", 1) + ")"
INGEST["run_report"] = _STATS.replace(
    "SELECT count(*) AS total_jobs,",
    f"SELECT '{AS_OF}' AS execution_date, printf('{_REPORT_FMT}', '{AS_OF}', total_jobs, unique_companies, "
    "unique_locations, 'SUCCESS') AS report FROM (SELECT count(*) AS total_jobs,", 1) + ")"
ORACLES.update(INGEST)


# ------------------------------------------------------------------------ io

_PROCESSED = CLEANING["processed_postings"]
IO = {
    "parquet_roundtrip": _PROCESSED,
    "append_processed": _PROCESSED,
    "sample_rows": f"SELECT * FROM ({_PROCESSED}) ORDER BY job_id LIMIT 5",
    "read_raw_json": raw("SELECT title, company, location, salary, url, scraped_at, array_to_string(skills, ',') AS skills "
                         "FROM raw_jobs"),
    "incremental_ingest": raw(f"""
SELECT job_id, {clean_sql('title')} AS title, {clean_sql('company')} AS company, url,
  {smin_sql('salary')} AS salary_min, {smax_sql('salary')} AS salary_max FROM (
  SELECT *, CASE WHEN year(try_cast(scraped_at AS TIMESTAMP)) < 1997 THEN 0
    WHEN year(try_cast(scraped_at AS TIMESTAMP)) < 1999 THEN 1
    WHEN year(try_cast(scraped_at AS TIMESTAMP)) < 2001 THEN 2 ELSE 3 END b FROM raw_jobs) r
WHERE url IS NULL OR url IN ('', 'N/A') OR b = (SELECT min(b2) FROM (
  SELECT url, CASE WHEN year(try_cast(scraped_at AS TIMESTAMP)) < 1997 THEN 0
    WHEN year(try_cast(scraped_at AS TIMESTAMP)) < 1999 THEN 1
    WHEN year(try_cast(scraped_at AS TIMESTAMP)) < 2001 THEN 2 ELSE 3 END b2 FROM raw_jobs) x
  WHERE x.url = r.url)"""),
    # Landing by landing, what each url is remembered until.
    "streamed_postings": raw("""
SELECT job_id, url, strftime(t, '%Y-%m-%dT%H:%M:%S') AS scraped_at, (SELECT count(*) FROM ruled WHERE late) AS late_rows
FROM ruled WHERE kept
UNION ALL
SELECT job_id, url, strftime(t, '%Y-%m-%dT%H:%M:%S'), (SELECT count(*) FROM ruled WHERE late) FROM landed
WHERE url = 'N/A' AND i < 5""", """
first AS (SELECT job_id, url, CAST(scraped_at AS TIMESTAMP) AS t,
  (year(CAST(scraped_at AS TIMESTAMP)) - 1995) // 3 + CASE WHEN job_id % 7 = 1 THEN 1 ELSE 0 END AS i FROM raw_jobs),
landed AS (
  SELECT * FROM first UNION ALL
  SELECT job_id, url, CASE WHEN job_id % 2 = 1 THEN t + INTERVAL 20 DAY ELSE t + INTERVAL 900 DAY END,
    i + 1 + CASE WHEN job_id % 3 = 0 THEN 1 ELSE 0 END FROM first WHERE job_id % 5 = 0),
mark AS (SELECT g.i, (SELECT max(t) FROM landed l WHERE l.i < g.i AND l.url <> 'N/A') - INTERVAL 700 DAY AS w
  FROM range(5) g(i)),
ordered AS (SELECT l.*, w, row_number() OVER (PARTITION BY url ORDER BY l.i) AS n FROM landed l JOIN mark USING (i)
  WHERE url <> 'N/A'),
ruled(job_id, url, t, n, until, kept, late) AS (
  SELECT job_id, url, t, n, CASE WHEN w IS NULL OR t > w THEN t + INTERVAL 700 DAY END, w IS NULL OR t > w, t <= w
  FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.job_id, o.url, o.t, o.n, CASE WHEN o.t > w AND NOT coalesce(until > w, false) THEN o.t + INTERVAL 700 DAY
    ELSE until END, o.t > w AND NOT coalesce(until > w, false), o.t <= w
  FROM ruled r JOIN ordered o ON o.url = r.url AND o.n = r.n + 1)""").replace("WITH ", "WITH RECURSIVE ", 1),
}
ORACLES.update(IO)
IO["append_raw"] = IO["read_raw_json"]
IO["surrogate_keys"] = """
SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS line_key FROM lineitem"""
ORACLES.update(IO)


# ------------------------------------------------------------ stored in buckets

ORACLES.update({f"stored_{name}": ORACLES[name] for name in (
    "q09_skills_for_title", "q12_export_jobs", "v4_skills_by_location")})
