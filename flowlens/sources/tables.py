"""Readers for the parquet tables and SQL over parquet files."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sql_over_parquet(spark: SparkSession, sql: str, paths: list[str]) -> DataFrame:
    """Register each parquet path as temp view ``t0, t1, ...`` and run ``sql``.
    The query is planned by Catalyst, so filters and projections reach the
    parquet scans.  The views live in a session of their own, so callers do
    not overwrite each other's."""
    own = spark.newSession()
    for i, p in enumerate(paths):
        own.read.parquet(p).createOrReplaceTempView(f"t{i}")
    return own.sql(sql)
