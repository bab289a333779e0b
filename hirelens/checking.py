"""Order-insensitive result comparison used by the oracle check and tests."""

from __future__ import annotations

import datetime as dt
import decimal
import math


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return (1, "nan" if math.isnan(f) else repr(f))
    if isinstance(v, dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (3, dt.datetime(v.year, v.month, v.day).isoformat())
    if isinstance(v, (list, tuple)):
        return (4, repr([norm(x) for x in v]))
    return (5, str(v))


def canonical_rows(records, cols):
    """Rows with columns in name order and values normalised, sorted."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


def same_result(got, got_cols, exp, exp_cols) -> bool:
    return sorted(got_cols) == sorted(exp_cols) and canonical_rows(got, got_cols) == canonical_rows(exp, exp_cols)


# Spark type -> DuckDB type name, for the schema part of the comparison.
DUCK_TYPES = {
    "LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
    "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "TimestampNTZType()": "TIMESTAMP",
    "DateType()": "DATE", "ShortType()": "SMALLINT", "FloatType()": "FLOAT",
}


def type_differences(spark_schema, duck_columns, duck_types) -> dict:
    """{column: (spark type, duckdb type)} for columns whose types differ."""
    st = {f.name: DUCK_TYPES.get(repr(f.dataType), repr(f.dataType)) for f in spark_schema}
    dt = {c: str(t) for c, t in zip(duck_columns, duck_types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
