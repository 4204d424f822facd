"""Monthly cash-flow features per company.

Scale notes: the ledger is reduced to (company, month) with map-side
partial aggregation before anything else, so every later window runs over
at most one row per company and month (bounded by the number of months,
even for a hub company holding a large share of all payments).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import pct_change, safe_num
from ..schemas import FLOW_METRICS


def monthly_flows(base2: DataFrame) -> DataFrame:
    """Revenue (received), expense (paid), net flow, growth vs the previous
    flow row of the company and 3-row revenue volatility.

    Equivalent to a full outer join of the receiver- and payer-side sums,
    expressed as one unpivot + one aggregation (one shuffle)."""
    legs = base2.filter(F.col("DT_REFE").isNotNull()).select(
        "DT_REFE",
        F.explode(F.array(
            F.struct(F.col("ID_RCBE").alias("ID"), F.col("VL").alias("rec"), F.lit(0.0).alias("des")),
            F.struct(F.col("ID_PGTO").alias("ID"), F.lit(0.0).alias("rec"), F.col("VL").alias("des")),
        )).alias("leg"))
    m = (legs.filter(F.col("leg.ID").isNotNull())
         .groupBy(F.col("leg.ID").alias("ID"), F.col("DT_REFE").alias("year_month"))
         .agg(F.sum("leg.rec").alias("receita_mensal"), F.sum("leg.des").alias("despesa_mensal")))
    return flows_window(m)


def flows_window(m: DataFrame) -> DataFrame:
    """Net flow, growth vs the previous row and 3-row volatility over a
    (company, month) revenue/expense table."""
    w = Window.partitionBy("ID").orderBy("year_month")
    w3 = w.rowsBetween(-2, 0)
    return m.select(
        "ID", "year_month", "receita_mensal", "despesa_mensal",
        (F.col("receita_mensal") - F.col("despesa_mensal")).alias("fluxo_liquido"),
        pct_change(F.col("receita_mensal"), F.lag("receita_mensal").over(w)).alias("g_receita_mom"),
        F.when(F.count(F.lit(1)).over(w3) == 3, F.stddev_samp("receita_mensal").over(w3)).alias("vol_receita_3m"),
    )


def f_empresa_mes(base1: DataFrame, flows: DataFrame) -> DataFrame:
    """Profile rows left-joined to the flows; numeric NULLs -> 0 (growth and
    volatility keep +/-inf).  Text/date columns keep their NULLs."""
    b1 = base1.withColumnRenamed("DT_REFE", "year_month").filter(F.col("ID").isNotNull())
    j = b1.join(flows, ["ID", "year_month"], "left")
    numeric = ["VL_FATU", "VL_SLDO"] + FLOW_METRICS
    return j.select("ID", "year_month", "DT_ABRT", "DS_CNAE",
                    *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in numeric])


def flows_for_reporting(f: DataFrame) -> DataFrame:
    """Monthly facts for reporting: drop NULL months, add ``ym_str`` and make
    the five metrics finite (non-finite -> 0)."""
    return (f.filter(F.col("year_month").isNotNull())
            .select("ID", "year_month", F.date_format("year_month", "yyyy-MM").alias("ym_str"),
                    *[safe_num(c).alias(c) for c in FLOW_METRICS]))


def monthly_agg(rep: DataFrame) -> DataFrame:
    """One row per (ID, month): sums of money, means of growth/volatility."""
    return rep.groupBy("ID", "year_month", "ym_str").agg(
        F.sum("receita_mensal").alias("receita_mensal"),
        F.sum("despesa_mensal").alias("despesa_mensal"),
        F.sum("fluxo_liquido").alias("fluxo_liquido"),
        F.avg("g_receita_mom").alias("g_receita_mom"),
        F.avg("vol_receita_3m").alias("vol_receita_3m"),
    )


def edges_month(base2: DataFrame) -> DataFrame:
    """Shared pre-aggregate of the ledger: (payer, receiver, month, channel)
    -> total value and payment count.  Every relation, ego-network and risk
    operator reads this instead of the raw ledger."""
    return (base2.filter(F.col("ID_PGTO").isNotNull() & F.col("ID_RCBE").isNotNull()
                         & F.col("DT_REFE").isNotNull())
            .groupBy(F.col("ID_PGTO").alias("src"), F.col("ID_RCBE").alias("dst"),
                     F.col("DT_REFE").alias("year_month"), F.col("DS_TRAN").alias("channel"))
            .agg(F.sum("VL").alias("valor"), F.count(F.lit(1)).alias("n")))


def company_months(f: DataFrame) -> DataFrame:
    """Distinct months per company with the most recent first and a flag for
    the default selection (last six)."""
    w = Window.partitionBy("ID").orderBy(F.col("year_month").desc())
    d = f.filter(F.col("year_month").isNotNull()).select("ID", "year_month").distinct()
    return d.select("ID", "year_month", F.date_format("year_month", "yyyy-MM").alias("ym_str"),
                    (F.row_number().over(w) <= 6).alias("is_default"))


def company_ids(f: DataFrame) -> DataFrame:
    """Distinct company ids of the monthly facts, sorted (a range-partitioned
    distributed sort; no single-partition window)."""
    return f.select("ID").filter(F.col("ID").isNotNull()).distinct().orderBy("ID")


def month_list(base2: DataFrame) -> DataFrame:
    """Distinct ledger months (month starts) with their ``yyyy-MM`` label."""
    return (base2.select(F.col("DT_REFE").alias("year_month")).filter(F.col("year_month").isNotNull())
            .distinct().select("year_month", F.date_format("year_month", "yyyy-MM").alias("ym_str")))
