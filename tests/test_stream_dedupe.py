"""Dedupe by keyed state: repetitions, late rows, forgotten keys, restarts."""

import tempfile

from hirelens.streaming.dedupe import ingest_within

SCHEMA = "job long, url string, scraped_at string"


def run(spark, landings, delay="10 days"):
    base, late = tempfile.mkdtemp(), []
    for i, rows in enumerate(landings):
        df = spark.createDataFrame([(n, url, at and f"2024-{at}T00:00:00") for n, url, at in rows], SCHEMA)
        df.coalesce(1).write.parquet(f"{base}/in/l{i}")
        late.append(ingest_within(spark, f"{base}/in/*", df.schema, f"{base}/out", f"{base}/log", delay))
    return sorted(r["job"] for r in spark.read.parquet(f"{base}/out").collect()), late


def test_repetitions_late_rows_and_forgotten_keys(spark):
    stored, late = run(spark, [
        [(1, "/a", "01-10"), (2, "/b", "01-20"), (3, "/a", "01-10")],      # watermark: 10 January
        [(4, "/a", "01-12"), (5, "/c", "01-09"), (6, "/d", "01-11"), (7, "/e", "02-20")],  # then 10 February
        [(8, "/a", "02-15"), (9, "/b", "02-10"), (10, "/e", "02-19")],
    ])
    assert len({1, 3} & set(stored)) == 1                        # one of the same batch
    assert set(stored) - {1, 3} == {2, 6, 7, 8}                   # /a again after it was forgotten
    assert late == [0, 1, 1]                                     # /c, then /b at the watermark itself


def test_rows_that_cannot_be_compared_are_stored(spark):
    stored, late = run(spark, [
        [(1, None, "01-10"), (2, None, "01-10"), (3, "N/A", "01-10"), (4, "/a", None), (5, "/a", None), (6, "", "01-01")],
        [(7, "N/A", "01-10"), (8, "/a", "01-30")],
        [(9, None, "01-01")],
    ])
    assert stored == list(range(1, 10)) and late == [0, 0, 0]


def test_a_run_without_new_files_stores_nothing(spark):
    base = tempfile.mkdtemp()
    df = spark.createDataFrame([(1, "/a", "2024-01-01T00:00:00")], SCHEMA)
    df.write.parquet(f"{base}/in/l0")
    for _ in range(2):
        assert ingest_within(spark, f"{base}/in/*", df.schema, f"{base}/out", f"{base}/log", "1 day") == 0
    assert spark.read.parquet(f"{base}/out").count() == 1
