"""Ingest of the raw profile and ledger, and parquet sinks."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import month_start


def _strip(c) -> F.Column:
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def _to_double_or_null(c) -> F.Column:
    v = _strip(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(v), v)


def ingest_profile(raw: DataFrame) -> DataFrame:
    """Raw profile -> base1: month start, numeric values (unparsable -> NULL)."""
    return raw.select(
        F.col("ID").cast("string").alias("ID"),
        month_start("DT_REFE").alias("DT_REFE"),
        _to_double_or_null(F.col("VL_FATU")).alias("VL_FATU"),
        _to_double_or_null(F.col("VL_SLDO")).alias("VL_SLDO"),
        F.to_date("DT_ABRT").alias("DT_ABRT"),
        F.col("DS_CNAE").cast("string").alias("DS_CNAE"),
    )


def normalise_channel(c) -> F.Column:
    """Upper-case + strip, then the channel dictionary; anything unmatched
    (including NULL) -> the default channel."""
    key = F.upper(_strip(c.cast("string")))
    expr = None
    for k, v in C.CHANNEL_MAP.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr.otherwise(F.lit(C.CHANNEL_DEFAULT))


def ingest_transactions(raw: DataFrame) -> DataFrame:
    """Raw ledger -> base2: month start, amount (unparsable -> 0), channel."""
    return raw.select(
        F.col("ID_PGTO").cast("string").alias("ID_PGTO"),
        F.col("ID_RCBE").cast("string").alias("ID_RCBE"),
        month_start("DT_REFE").alias("DT_REFE"),
        F.coalesce(_to_double_or_null(F.col("VL")), F.lit(0.0)).alias("VL"),
        normalise_channel(F.col("DS_TRAN")).alias("DS_TRAN"),
    )


def ingest_counts(base1: DataFrame, base2: DataFrame) -> DataFrame:
    """Row counts of both ingested tables: (table, n_rows)."""
    c1 = base1.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("base1").alias("table"), "n_rows")
    c2 = base2.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("base2").alias("table"), "n_rows")
    return c1.unionByName(c2)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet sink (optionally partitioned, e.g. the ledger by month)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
