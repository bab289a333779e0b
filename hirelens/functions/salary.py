"""Salary text -> (salary_min, salary_max) as Column expressions.

``compat`` keeps the original rules exactly, including their quirks
("$1,000 - $2,500" gives min 1 and max NULL).  With ``strip_thousands`` a
comma between digits is removed first.  Parsing uses ``try_cast`` so that an
empty match or an overflow gives NULL under ANSI mode instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The salary patterns.
MIN_PATTERN = r"\$(\d+)"
MAX_PATTERN = r"\$\d+\s*-\s*\$(\d+)"
THOUSANDS_PATTERN = r"(?<=\d),(?=\d{3})"


def _prepared(salary: Column, strip_thousands: bool) -> Column:
    if strip_thousands:
        return F.regexp_replace(salary, F.lit(THOUSANDS_PATTERN), F.lit(""))
    return salary


def salary_min_col(salary: Column | str, strip_thousands: bool = False) -> Column:
    s = _prepared(F.col(salary) if isinstance(salary, str) else salary, strip_thousands)
    return F.when(s.contains("$"), F.regexp_extract(s, MIN_PATTERN, 1).try_cast("int"))


def salary_max_col(salary: Column | str, strip_thousands: bool = False) -> Column:
    s = _prepared(F.col(salary) if isinstance(salary, str) else salary, strip_thousands)
    return F.when(
        s.contains("-"), F.regexp_extract(s, MAX_PATTERN, 1).try_cast("int")
    ).otherwise(salary_min_col(s))


def normalize_salary(df: DataFrame, column: str = "salary", strip_thousands: bool = False,
                     drop: bool = True) -> DataFrame:
    out = df.withColumns({
        "salary_min": salary_min_col(column, strip_thousands),
        "salary_max": salary_max_col(column, strip_thousands),
    })
    return out.drop(column) if drop else out
