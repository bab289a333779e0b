"""Column functions: literal truth tables and known traps."""

import pytest
from pyspark.sql import functions as F

from hirelens.functions.salary import normalize_salary
from hirelens.functions.skills import skills_bounded_col, skills_compat_col
from hirelens.functions.text import clean_text_col
from hirelens.operators.warehouse import normalize_url_col

SALARY_TABLE = [
    ("$1000 - $2000", 1000, 2000),
    ("$1000-$2000", 1000, 2000),
    ("$1,000 - $2,500", 1, None),
    ("Up to $2000", 2000, 2000),
    ("$1000-2000", 1000, None),
    ("$500 - 700 - $900", 500, None),
    ("N/A", None, None),
    ("1000 - 2000 USD", None, None),
    ("Sign-in to view", None, None),
    (None, None, None),
    ("$99999999999", None, None),
]


def test_salary_truth_table(spark):
    df = spark.createDataFrame([(s,) for s, _, _ in SALARY_TABLE], "salary string")
    got = [(r.salary_min, r.salary_max) for r in normalize_salary(df).collect()]
    assert got == [(lo, hi) for _, lo, hi in SALARY_TABLE]


def test_salary_strip_thousands(spark):
    df = spark.createDataFrame([("$1,000 - $2,500",), ("$1,200,000",)], "salary string")
    got = [(r.salary_min, r.salary_max) for r in normalize_salary(df, strip_thousands=True).collect()]
    assert got == [(1000, 2500), (1200000, 1200000)]


@pytest.mark.parametrize("text,expected", [
    ("a<br>b", "ab"),
    ("  <b>Senior</b>  Data<br>Engineer  ", "senior dataengineer"),
    ("DEV   <i class=x>Ops</i>\t\nX", "dev ops x"),
    ("A B", "a b"),          # NBSP is not whitespace for \s: kept
    ("Tom &amp; Co", "tom &amp; co"),  # entities are not decoded
    (None, None),
])
def test_clean_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(clean_text_col("t").alias("c")).first().c == expected


def test_clean_text_idempotent(spark):
    rows = [("  Hello   World  ",), ("x<y",), ("a\tb",)]
    df = spark.createDataFrame(rows, "t string").select(clean_text_col("t").alias("c"))
    twice = df.select(clean_text_col("c").alias("c2"), "c")
    assert all(r.c == r.c2 for r in twice.collect())


def test_skills_compat_traps(spark):
    df = spark.createDataFrame([("JavaScript, good digital scalable",), (None,)], "d string")
    got = [r.s for r in df.select(skills_compat_col("d").alias("s")).collect()]
    # no word boundaries and list order wins, exactly as the original rule
    assert got[0] == ["java", "go", "git", "scala"]
    assert got[1] == []


def test_skills_bounded(spark):
    df = spark.createDataFrame([("JavaScript, good digital; C++/C# on Google Cloud, node.js and SQL",)],
                               "d string")
    got = sorted(df.select(skills_bounded_col("d").alias("s")).first().s)
    assert got == sorted(["JavaScript", "C++", "C#", "Google Cloud", "Node.js", "SQL"])


def test_normalize_url(spark):
    rows = [("/it-jobs/1",), ("https://a/b",), ("N/A",), ("",), (None,)]
    df = spark.createDataFrame(rows, "u string")
    got = [r.n for r in df.select(normalize_url_col(F.col("u"), "https://base").alias("n")).collect()]
    assert got == ["https://base/it-jobs/1", "https://a/b", "N/A", "", None]


def test_midpoint_of_large_salaries(spark):
    from hirelens.functions.numeric import int_midpoint

    df = spark.createDataFrame([(2000000000, 2100000000), (None, 1), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(int_midpoint("a", "b")).collect()] == [2050000000, None, 1]


def test_tries_find_what_the_plain_alternations_find():
    """Random texts of term parts, both modes, against the terms in a plain alternation."""
    import random
    import re

    from hirelens.functions import skills as S

    longest = sorted({n.lower() for n in S.SKILL_NAMES}, key=lambda t: (-len(t), t))
    plain = {"compat": re.compile("(?i)(" + "|".join(S.SKILL_PATTERNS) + ")"),
             "bounded": re.compile(f"(?<![{S.WORD_BEFORE}])({'|'.join(map(re.escape, longest))})(?![{S.WORD_AFTER}])")}
    rng = random.Random(6)
    parts = [n.lower()[:k] for n in S.SKILL_NAMES for k in (2, 3, len(n), len(n))] + list(" .,+#/-x") + ["\n"]
    for _ in range(3_000):
        text = "".join(rng.choice(parts) for _ in range(12))
        assert re.findall(S.compat_pattern(), text) == plain["compat"].findall(text)
        assert re.findall(S.bounded_pattern(), text) == plain["bounded"].findall(text)


def test_skill_sets_stay_in_place(spark):
    from hirelens.functions.skills import job_skill_sets

    df = spark.createDataFrame([(1, "Java, java and SQL"), (1, "Go"), (2, None), (None, "x")], "job_id int, d string")
    got = job_skill_sets(df, "d")
    assert [tuple(r)[2:] for r in got.collect()] == [(["java", "sql"], 2), (["go"], 1), ([], 0), ([], 0)]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
