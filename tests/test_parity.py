"""Every registered query against its DuckDB oracle (sf0.001), and the
driver contract (entry, queries, oracle_sql)."""

import pytest

import __spark_entry__ as E
from hirelens.checking import same_result, type_differences
from hirelens.plans.registry import all_queries

from conftest import SF_SMALL

QUERIES = {name: fn for name, fn in E.queries().items() if name in all_queries()}
ORACLES = {name: sql for name, sql in E.oracle_sql().items() if name in all_queries()}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    sql = ORACLES.get(name)
    if sql is None:
        assert isinstance(got, list)
        return
    con = duck(SF_SMALL)
    rel = con.sql(sql)
    assert type_differences(df.schema, rel.columns, rel.types) == {}, name
    cur = con.execute(sql)
    exp = cur.fetchall()
    assert same_result(got, df.columns, exp, [d[0] for d in cur.description]), name


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 20
    assert df.columns == ["skill_name", "job_count", "percentage"]
