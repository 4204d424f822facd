"""Versioned publishing of a build's tables.

A build writes its tables to a folder of its own; a manifest, written last,
names them.  Readers take the newest manifest that was written to the end, so
a build that dies between two tables leaves the one before it readable.  Works
on any file system that Spark reads.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFESTS, BUILDS = "_manifests", "_builds"


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def published_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions with a manifest written to the end, oldest first."""
    folder, fs = _folder(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath() for s in fs.listStatus(folder)]
    return sorted(int(p.getName()[2:]) for p in names
                  if p.getName().startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def new_build(root: str) -> str:
    """A folder for the tables of one build; nothing refers to it yet."""
    return f"{root.rstrip('/')}/{BUILDS}/{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, paths: dict[str, str]) -> int:
    """Make these tables the newest version; its number.

    Two builds that end together get different versions: the one that finds its
    number taken fails to write it and takes the next."""
    from pyspark.errors import AnalysisException
    rows = spark.createDataFrame(sorted(paths.items()), "name string, path string").coalesce(1)
    version = max(published_versions(spark, root), default=-1) + 1
    while True:
        try:
            rows.write.mode("error").parquet(f"{root.rstrip('/')}/{MANIFESTS}/v={version:08d}")
            return version
        except AnalysisException as e:
            if "PATH_ALREADY_EXISTS" not in str(e.getCondition()):
                raise
            version += 1


def published_paths(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Table paths by name of a version (the newest one by default; empty where there is none)."""
    versions = published_versions(spark, root)
    if version is None:
        if not versions:
            return {}
        version = versions[-1]
    elif version not in versions:
        raise LookupError(f"version {version} is not published in {root}")
    rows = spark.read.parquet(f"{root.rstrip('/')}/{MANIFESTS}/v={version:08d}").collect()  # a row a table
    return {r["name"]: r["path"] for r in rows}


def read_published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(published_paths(spark, root, version)[name])


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions (months) that ``df`` has rows of; the rest of the table stays."""
    rows = df.hint("rebalance", *partition_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
