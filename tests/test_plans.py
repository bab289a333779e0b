"""Physical-plan assertions: pushdown, no Python in reports, single scans."""

import contextlib
import io

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

QUERIES = E.queries()
REPORTS = [n for n in QUERIES if n[:1] in "qv" and n[1:3].isdigit()]
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonUDF", "FlatMapGroupsInPandas")


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", REPORTS)
def test_reports_stay_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert not any(node in text for node in PY_NODES), name


def test_recent_jobs_filter_reaches_the_scan(spark):
    text = plan(QUERIES["q10_recent_jobs"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in text


def test_column_pruning_on_orders(spark):
    text = plan(QUERIES["q06_location_popularity"](spark, SF_SMALL))
    schemas = [ln for ln in text.splitlines() if "ReadSchema: struct<o_orderkey" in ln]
    assert schemas and all("o_totalprice" not in s and "o_orderpriority" not in s for s in schemas)


def test_quality_report_scans_the_fact_once(spark):
    text = plan(QUERIES["q08_data_quality"](spark, SF_SMALL))
    main = text.split("===== Subqueries =====")[0]
    assert main.count("orders.parquet") == 1
    assert "Union" not in main


def test_export_filters_bridge_before_aggregating(spark):
    text = plan(QUERIES["q12_export_jobs"](spark, SF_SMALL))
    semi = text.index("LeftSemi")
    first_agg = text.index("HashAggregate")
    # the tree is printed top-down: the semi join must sit below (after) the
    # aggregate that de-duplicates lineitem, i.e. be applied before it
    assert semi > first_agg


def test_card_parsing_is_arrow_batched(spark):
    text = plan(QUERIES["job_cards"](spark, SF_SMALL))
    assert "MapInPandas" in text and "BatchEvalPython" not in text


def test_key_assignment_never_moves_rows_to_one_partition(spark):
    text = plan(QUERIES["surrogate_keys"](spark, SF_SMALL), "simple")
    lines = text.split("\n+- == Initial Plan ==")[0].splitlines()
    singles = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    assert singles, "offsets are computed over one row per partition"
    for i in singles:
        # the only single-partition exchange sits on the per-partition counts
        below = "\n".join(lines[i + 1:i + 4])
        assert "HashAggregate(keys=[_pid" in below, below
