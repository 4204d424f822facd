"""Spark session helpers.

The library never creates its own cluster settings; these helpers are for
tests, the bench and local runs.  ``checkpoint_dir`` reads the directory the
cluster names in ``spark.checkpoint.dir`` and only invents a local one when
the setting is absent on a local master (tests, bench); elsewhere it raises.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CKPT: str | None = None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "flowlens") -> SparkSession:
    """A local[N] session for tests and benchmarks (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FLOWLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def import_in_workers(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *paths])


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the session's setting, else a local one."""
    global _LOCAL_CKPT
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf)
        return conf
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _LOCAL_CKPT is None:
        _LOCAL_CKPT = tempfile.mkdtemp(prefix="flowlens-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", _LOCAL_CKPT)
    spark.sparkContext.setCheckpointDir(_LOCAL_CKPT)
    return _LOCAL_CKPT


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` written once as parquet to the shared checkpoint folder and read
    back: a short lineage, columns that consumers can prune, and no copy of
    the rows in the executors' memory."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, parts: int, names: list[str] | None = None, prefix: str = "bucketed") -> DataFrame:
    """``df`` as a table of ``parts`` buckets by ``key``; its name is added to ``names``."""
    spark = df.sparkSession
    name = f"{prefix}_{uuid.uuid4().hex}"
    if names is not None:
        names.append(name)
    df.write.format("parquet").bucketBy(parts, key).option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name)
    return spark.table(name)
