"""Random-input properties: the Spark column functions against plain Python
statements of the same rules (one Spark job per generated batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hirelens.functions.salary import normalize_salary
from hirelens.functions.text import clean_text_col
from hirelens.operators.warehouse import stage_jobs

JAVA_SPACE = "[ \t\n\x0b\f\r]"

salary_text = st.lists(
    st.text(alphabet="$0123456789-, UptoUSD\t", min_size=0, max_size=16) | st.none(),
    min_size=30, max_size=60)
free_text = st.lists(st.text(alphabet="ab <>/\t\n\x0b\xa0Xyz&;", max_size=30) | st.none(),
                     min_size=30, max_size=60)


def py_int(s):
    if not s:
        return None
    v = int(s)
    return v if -2**31 <= v < 2**31 else None


def py_salary(s):
    if s is None:
        return None, None
    m = re.search(r"\$(\d+)", s)
    lo = py_int(m.group(1)) if "$" in s and m else None
    if "-" in s:
        m = re.search(r"\$\d+" + JAVA_SPACE + r"*-" + JAVA_SPACE + r"*\$(\d+)", s)
        hi = py_int(m.group(1)) if m else None
    else:
        hi = lo
    return lo, hi


def py_clean(s):
    if s is None:
        return None
    s = re.sub(r"<[^>]+>", "", s)
    s = re.sub(JAVA_SPACE + "+", " ", s)
    return s.strip(" ").lower()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=salary_text)
def test_salary_matches_python_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "salary string")
    got = [(r.salary_min, r.salary_max) for r in normalize_salary(df).collect()]
    assert got == [py_salary(v) for v in values]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=free_text)
def test_clean_text_matches_python_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r.c for r in df.select(clean_text_col("t").alias("c")).collect()]
    assert got == [py_clean(v) for v in values]


def test_vertical_tab_is_whitespace_and_nbsp_is_not(spark):
    df = spark.createDataFrame([("a\x0b\x0bb\xa0c",)], "t string")
    assert df.select(clean_text_col("t").alias("c")).first().c == "a b\xa0c"


def test_unparsable_scraped_at_is_null(spark):
    raw = spark.createDataFrame([("t", "c", "L", "$1", "/u", "not a date"), ("t", "c", "L", "$1", "/v", "2001-07-30T10:00:00")],
                                "title string, company string, location string, salary string, url string, scraped_at string")
    got = sorted((r.job_url, r.scraped_at) for r in stage_jobs(raw, "2001-07-30 12:00:00").collect())
    assert got[0][1] is None and str(got[1][1]) == "2001-07-30 10:00:00"
