"""Adapter from the driver's TPC-H-style tables to the two source tables.

* ``base2`` (payment ledger): one payment per line item.  The payer is the
  order's customer folded onto the supplier key space (``custkey mod N``,
  N = number of suppliers), the receiver is the line's supplier.
* ``base1`` (monthly company profile): one row per supplier and calendar
  month between the first and the last ledger month.

Everything is lazy: the supplier count and the month range are scalar
subqueries evaluated once by Spark, not driver round trips.
"""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table
from ..functions.columns import month_start

# FIXED VALUES: adapter parameters (activity texts in sector-rule order,
# yearly revenue base per size class, raw channel per order priority).
ACTIVITY_TEXTS = [
    "EXTRACAO DE MINERIO - METAIS",
    "GERACAO DE ENERGIA; SOLAR",
    "COMERCIO DE COMBUSTIVEL/POSTO",
    "SIDERURGIA",
    "CONSTRUCAO DE OBRAS",
    "FABRICACAO EM GERAL",
    "PRODUTOS QUIMICOS",
    "MEDICAMENTO HUMANO",
    "SOFTWARE SOB ENCOMENDA",
    "VAREJO DE LOJA",
    "CONSULTORIA EMPRESARIAL",
    "RESTAURANTE",
    "PESCA",
]
REVENUE_BASE = [1e5, 1e6, 1e7, 4e8]
RAW_CHANNEL = {
    "1-URGENT": " pix ",
    "2-HIGH": "Ted",
    "3-MEDIUM": "BOLETO",
    "4-NOT SPECIFIED": "SISTEMICO",
    "5-LOW": "cheque",
}
CLEAN_CHANNEL = {
    "1-URGENT": "PIX",
    "2-HIGH": "TED",
    "3-MEDIUM": "BOLETO",
    "4-NOT SPECIFIED": "OUTROS",
    "5-LOW": "OUTROS",
}
OPENING_EPOCH = "1985-01-01"
AS_OF = "2001-09-01"


class Bases(NamedTuple):
    base1: DataFrame       # clean profile
    base2: DataFrame       # clean ledger (unreadable amounts are 0), self-payments removed
    base2_raw: DataFrame   # raw ledger (text amount/channel, self-payments kept)
    base1_raw: DataFrame   # raw profile (text values, mid-month timestamps)


def company_id(key) -> F.Column:
    return F.concat(F.lit("E"), F.lpad(key.cast("string"), 6, "0"))


def _mapped(c, mapping: dict) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items joined to their order (only the columns the ledger needs)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_discount")
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    sup = read_table(spark, sf_dir, "supplier")
    n_sup = sup.select(F.count(F.lit(1))).scalar()
    factor = (F.lit(3.0) + (F.col("l_suppkey") % 5).cast("double")) / F.lit(5.0)
    return (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
            .select(
                company_id(F.col("o_custkey") % n_sup).alias("ID_PGTO"),
                company_id(F.col("l_suppkey")).alias("ID_RCBE"),
                F.col("o_orderdate"),
                (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) * factor).alias("VL"),
                F.col("o_orderpriority"),
                F.col("l_orderkey")))


def _month_range(spark: SparkSession, sf_dir: str, start_month: str | None):
    od = read_table(spark, sf_dir, "orders")
    first = od.select(F.min(month_start("o_orderdate"))).scalar()
    last = od.select(F.max(month_start("o_orderdate"))).scalar()
    if start_month is not None:
        first = F.greatest(first, F.to_date(F.lit(start_month)))
    return first, last


def _profile(spark: SparkSession, sf_dir: str, start_month: str | None) -> DataFrame:
    first, last = _month_range(spark, sf_dir, start_month)
    k = F.col("s_suppkey")
    text_idx = F.when(k % 10 < 6, k % 2).otherwise(k % 13)
    revenue = (F.element_at(F.array(*[F.lit(v) for v in REVENUE_BASE]),
                            (F.floor(k / 2) % 4 + 1).cast("int"))
               * (F.lit(1.0) + F.abs(F.col("s_acctbal")) / F.lit(20000.0)))
    opened = F.when(k % 29 == 28, F.lit(None).cast("date")).otherwise(
        F.date_add(F.to_date(F.lit(OPENING_EPOCH)), ((k * 197) % 6000).cast("int")))
    # a supplier becomes a row a month: a small file would leave all of them to one task
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal").repartition(parts, "s_suppkey")
    return sup.select(
        company_id(k).alias("ID"),
        F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("DT_REFE"),
        revenue.alias("VL_FATU"),
        F.col("s_acctbal").cast("double").alias("VL_SLDO"),
        opened.alias("DT_ABRT"),
        F.element_at(F.array(*[F.lit(t) for t in ACTIVITY_TEXTS]), (text_idx + 1).cast("int")).alias("DS_CNAE"),
        k.alias("_key"),
    )


def load_bases(spark: SparkSession, sf_dir: str, start_month: str | None = None) -> Bases:
    pay = _payments(spark, sf_dir)
    if start_month is not None:
        pay = pay.filter(F.col("o_orderdate") >= F.to_timestamp(F.lit(start_month)))
    prio = F.col("o_orderpriority")
    base2_raw = pay.select(
        "ID_PGTO", "ID_RCBE",
        F.col("o_orderdate").cast("timestamp").alias("DT_REFE"),
        F.when(F.col("l_orderkey") % 997 == 0, F.lit("n/a"))
         .otherwise(F.col("VL").cast("string")).alias("VL"),
        _mapped(prio, RAW_CHANNEL).alias("DS_TRAN"))
    base2 = (pay.filter(F.col("ID_PGTO") != F.col("ID_RCBE"))
             .select("ID_PGTO", "ID_RCBE",
                     month_start("o_orderdate").alias("DT_REFE"),
                     # as ingest leaves them: unreadable amounts are 0
                     F.when(F.col("l_orderkey") % 997 == 0, F.lit(0.0)).otherwise(F.col("VL")).alias("VL"),
                     _mapped(prio, CLEAN_CHANNEL).alias("DS_TRAN")))
    prof = _profile(spark, sf_dir, start_month)
    base1 = prof.drop("_key")
    k = F.col("_key")
    base1_raw = prof.select(
        "ID",
        F.to_timestamp(F.date_add("DT_REFE", (k % 28).cast("int"))).alias("DT_REFE"),
        F.col("VL_FATU").cast("string").alias("VL_FATU"),
        F.when(k % 17 == 16, F.lit("n/a")).otherwise(F.col("VL_SLDO").cast("string")).alias("VL_SLDO"),
        "DT_ABRT", "DS_CNAE")
    return Bases(base1, base2, base2_raw, base1_raw)
