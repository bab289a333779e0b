"""Driver tables (one Parquet file per table) as DataFrames.

Reads are lazy and schema-on-read from Parquet footers, so Catalyst prunes
columns and pushes filters into every scan that a query builds on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown driver table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Accessor ``t("orders")`` bound to one session and data folder.  Every
    instance lists the files anew, so rows that were appended are seen."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.sf_dir, name)
        return self._frames[name]
