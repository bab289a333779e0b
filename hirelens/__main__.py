"""Command line.

    python -m hirelens daily  --pages PAGES.parquet --out DIR [--as-of TS]
    python -m hirelens report --warehouse DIR --query q01_top_skills [--out PATH] [--as-of TS]
    python -m hirelens check  --warehouse DIR

``daily`` runs the whole stage order on saved pages (page_id, url, html
and an optional batch_idx) and continues from the warehouse under --out, ``report`` runs one reporting query over a
written warehouse (shown, or written as Parquet), and ``check`` prints the
constraint violations of a written warehouse.  The session comes from the
environment (spark-submit) or is built locally.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import functions as F

from hirelens.operators.constraints import constraint_violations, star_tables
from hirelens.plans import reports
from hirelens.plans.daily_run import read_warehouse, run_daily
from hirelens.session import apply_plan_conf, ensure_checkpoint_dir, get_session

REPORTS = {name: getattr(reports, name) for name in dir(reports) if name[:1] in "qv" and name[1:3].isdigit()}
TIMED = {"q10_recent_jobs", "q13_scrape_status"}


def _session():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession() or get_session()
    apply_plan_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="hirelens")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily")
    d.add_argument("--pages", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--as-of", default=None)
    d.add_argument("--run-id", default=None, help="the day by default; running an id again replaces its rows")
    r = sub.add_parser("report")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--query", required=True, choices=sorted(REPORTS))
    r.add_argument("--out", default=None)
    r.add_argument("--as-of", default=None)
    c = sub.add_parser("check")
    c.add_argument("--warehouse", required=True)
    a = p.parse_args(argv)

    spark = _session()
    if a.cmd == "daily":
        pages = spark.read.parquet(a.pages)
        if "batch_idx" not in pages.columns:
            pages = pages.withColumn("batch_idx", F.lit(0))
        as_of = a.as_of or datetime.now().isoformat(sep=" ", timespec="seconds")
        res = run_daily(pages, a.out, as_of, run_id=a.run_id)
        print(f"raw rows {res.raw_rows}, processed {res.processed_rows}, rejected {res.rejected_rows}, "
              f"gate passed {res.passed}")
        print(res.report.first()["report"])
    elif a.cmd == "report":
        star = read_warehouse(spark, a.warehouse).star()
        fn = REPORTS[a.query]
        df = fn(star, as_of=a.as_of) if a.query in TIMED else fn(star)
        if a.out:
            df.write.mode("overwrite").parquet(a.out)
        else:
            df.show(100, truncate=False)
    else:
        constraint_violations(star_tables(read_warehouse(spark, a.warehouse))).show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
