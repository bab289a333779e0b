"""Hand-made edge fixtures for the reports: empty tables, NULL salaries,
bucket edges, ties at k, no title match."""

import pytest

from hirelens.plans import reports
from hirelens.sources.bindings import Star

FACT = ("job_id long, company_id long, job_title string, job_url string, location string, "
        "salary_min int, salary_max int, posted_date timestamp_ntz, scraped_at timestamp_ntz, "
        "data_quality_score double")


def make_star(spark, facts, bridge=(), skills=((1, "s1"), (2, "s2"), (3, "s3")), companies=((1, "c1"), (2, "c2"))):
    fact = spark.createDataFrame(list(facts), FACT)
    return Star(fact,
                spark.createDataFrame(list(companies), "company_id long, company_name string"),
                spark.createDataFrame(list(skills), "skill_id long, skill_name string"),
                spark.createDataFrame(list(bridge), "job_id long, skill_id long"))


def job(i, lo=None, hi=None, loc="L", company=1, title="t", ts="2001-07-29 00:00:00"):
    import datetime as dt
    t = dt.datetime.fromisoformat(ts)
    return (i, company, title, f"u{i}", loc, lo, hi, t, t, 1.0)


def test_empty_star(spark):
    s = make_star(spark, [])
    assert reports.q01_top_skills(s).collect()[0].percentage is None  # 0 jobs -> NULL share
    row = reports.q13_scrape_status(s, as_of="2001-07-30 12:00:00").collect()
    assert len(row) == 1 and row[0].jobs_added == 0 and row[0].last_scrape_time is None
    assert reports.q07_salary_buckets(s).count() == 0
    assert {r.metric: r.value for r in reports.q08_data_quality(s).collect()}["Total Jobs"] == "0"


def test_all_salaries_null(spark):
    s = make_star(spark, [job(1), job(2)])
    (row,) = reports.q07_salary_buckets(s).collect()
    assert (row.salary_range, row.job_count, row.percentage) == ("Not disclosed", 2, None)


@pytest.mark.parametrize("value,bucket", [(999, "Under 1000"), (1000, "1000 - 2000"), (2000, "2000 - 3000"),
                                          (3000, "3000 - 4000"), (4000, "4000 - 5000"), (4999, "4000 - 5000"),
                                          (5000, "Above 5000")])
def test_bucket_edges(spark, value, bucket):
    s = make_star(spark, [job(1, 1, value)])
    assert reports.q07_salary_buckets(s).first().salary_range == bucket


def test_ties_at_k_are_broken_by_key(spark):
    facts = [job(i, company=1 + i % 2) for i in range(1, 5)]
    s = make_star(spark, facts, companies=((1, "c1"), (2, "c2")))
    top = reports.q03_top_companies(s, k=1).collect()
    assert [r.company_name for r in top] == ["c1"]  # both have 2 jobs: lower id wins


def test_title_match_without_skills(spark):
    s = make_star(spark, [job(1, title="Data Engineer"), job(2, title="data engineer II")],
                  bridge=[(2, 1)])
    (row,) = reports.q09_skills_for_title(s).collect()
    assert (row.skill_name, row.required_count, row.percentage_required) == ("s1", 1, 50.0)
    assert reports.q09_skills_for_title(s, pattern="%nothing%").count() == 0


def test_half_up_rounding(spark):
    # averages 1000.5 and 2.5 round up; shares 1/8 = 12.5% exactly
    s = make_star(spark, [job(1, 1000, 1001, loc="A"), job(2, 1001, 1002, loc="A")])
    (row,) = reports.q02_salary_by_location(s).collect()
    assert (row.avg_min_salary, row.avg_max_salary, row.avg_midpoint) == (1001.0, 1002.0, 1001.0)


def test_export_keeps_jobs_without_skills(spark):
    s = make_star(spark, [job(1), job(2)], bridge=[(1, 2), (1, 1)])
    got = {r.job_id: r.required_skills for r in reports.q12_export_jobs(s).collect()}
    assert got == {1: "s1, s2", 2: None}


def test_missing_fields_report(spark):
    s = make_star(spark, [job(3, None, 5, loc=None), job(1, 2, 3), job(2, None, None)])
    got = [(r.job_id, r.missing_field_1, r.missing_field_2) for r in reports.q14_missing_fields(s).collect()]
    assert got == [(2, "Missing salary_min", ""), (3, "Missing salary_min", "Missing location")]


def test_full_reports_come_ordered(spark):
    facts = [job(i, 1000 + i, 2000 + i, loc=f"L{i % 3}") for i in range(1, 10)]
    s = make_star(spark, facts)
    counts = [r.job_count for r in reports.v3_jobs_by_location(s).collect()]
    assert counts == sorted(counts, reverse=True)
    mids = [r.avg_midpoint for r in reports.q02_salary_by_location(s).collect()]
    assert mids == sorted(mids, reverse=True)


def test_export_is_ordered_by_posting_date(spark):
    s = make_star(spark, [job(1, ts="2001-07-01 00:00:00"), job(2, ts="2001-07-03 00:00:00"),
                          job(3, ts="2001-07-02 00:00:00")])
    assert [r.job_id for r in reports.q12_export_jobs(s).collect()] == [2, 3, 1]
