"""Base-table scans.

Every scan is a plain parquet read; Catalyst prunes columns and pushes
filters into the reader, so callers never pre-select columns by hand.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Whole table (lazy)."""
    if name not in BASE_TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def scan_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: scan(spark, sf_dir, n) for n in BASE_TABLES}


def scan_query(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run SQL over the base tables.

    ``sql`` names tables as ``{orders}`` placeholders; they are bound as
    DataFrame parameters, so no global temp view is created.
    """
    names = [n for n in BASE_TABLES if "{" + n + "}" in sql]
    return spark.sql(sql, **{n: scan(spark, sf_dir, n) for n in names})
