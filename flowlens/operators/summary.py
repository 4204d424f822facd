"""Per-company reporting queries (company summary, period KPIs, charts'
data).  Input is the reporting view of the monthly facts (finite metrics,
one row per company and month), so every per-company window is bounded by
the number of months."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import clip, compact_array, fold_accents, size_of, text_prefix_sector


def company_summary(rep: DataFrame, base1: DataFrame, stages: DataFrame | None = None) -> DataFrame:
    """Per company: mean revenue/expense/flow, total revenue, mean growth and
    volatility, positive-flow share, margin = mean flow / mean revenue
    (0 when |mean revenue| <= 1e-9); size and text-prefix sector from the
    company's earliest profile row; stage from ``stages`` (first per ID)."""
    g = rep.groupBy("ID").agg(
        F.avg("receita_mensal").alias("receita_media"), F.avg("despesa_mensal").alias("despesa_media"),
        F.avg("fluxo_liquido").alias("fluxo_medio"), F.sum("receita_mensal").alias("receita_total"),
        F.avg("g_receita_mom").alias("crescimento_medio"), F.avg("vol_receita_3m").alias("volatilidade_receita"),
        F.avg((F.col("fluxo_liquido") > 0).cast("double")).alias("consistencia_fluxo"))
    g = g.withColumn("margem_media", F.when(F.abs(F.col("receita_media")) > 1e-9,
                                            F.col("fluxo_medio") / F.col("receita_media")).otherwise(F.lit(0.0)))
    w = Window.partitionBy("ID").orderBy("DT_REFE")
    first = (base1.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
             .select("ID", "DS_CNAE", "VL_FATU"))
    g = g.join(first, "ID", "left").select(
        "*", size_of(F.coalesce(F.col("VL_FATU"), F.lit(0.0))).alias("porte"),
        text_prefix_sector("DS_CNAE").alias("setor"))
    if stages is not None:
        g = g.join(stages.select("ID", "estagio").dropDuplicates(["ID"]), "ID", "left")
    return g


def period_rows(rep: DataFrame, periods: list[str] | None = None) -> DataFrame:
    """Rows of the chosen months (``yyyy-MM`` strings); None = all months."""
    return rep if not periods else rep.filter(F.col("ym_str").isin(periods))


def period_kpis(rep: DataFrame, stages: DataFrame | None = None, periods: list[str] | None = None) -> DataFrame:
    """KPIs per company over the chosen months: totals, margin %, mean growth
    %, positive-flow %, mean volatility, number of months, stage and
    confidence (N/D and .5 when the company has no stage)."""
    d = period_rows(rep, periods)
    k = d.groupBy("ID").agg(
        F.sum("receita_mensal").alias("receita_total"), F.sum("despesa_mensal").alias("despesa_total"),
        F.sum("fluxo_liquido").alias("fluxo_total"),
        (F.avg("g_receita_mom") * 100).alias("crescimento_pct"),
        (F.avg((F.col("fluxo_liquido") > 0).cast("double")) * 100).alias("consistencia_pct"),
        F.avg("vol_receita_3m").alias("volatilidade_media"),
        F.countDistinct("year_month").alias("n_meses"))
    k = k.withColumn("margem_pct", F.when(F.col("receita_total") > 0,
                                          F.col("fluxo_total") / F.col("receita_total") * 100).otherwise(F.lit(0.0)))
    if stages is None:
        return k.select("*", F.lit("N/D").alias("estagio"), F.lit(0.5).alias("confianca"))
    st = stages.select("ID", "estagio", "confianca").dropDuplicates(["ID"])
    return k.join(st, "ID", "left").select(
        *[c for c in k.columns], F.coalesce(F.col("estagio"), F.lit("N/D")).alias("estagio"),
        F.when(F.col("estagio").isNull(), F.lit(0.5)).otherwise(F.col("confianca")).alias("confianca"))


def financial_composition(rep: DataFrame, periods: list[str] | None = None) -> DataFrame:
    """Expenses and profit = max(0, revenue - expenses) per company."""
    d = period_rows(rep, periods).groupBy("ID").agg(
        F.sum("receita_mensal").alias("_r"), F.sum("despesa_mensal").alias("despesas"))
    return d.select("ID", "despesas", F.greatest(F.lit(0.0), F.col("_r") - F.col("despesas")).alias("lucro"))


def flow_deltas(rep: DataFrame, periods: list[str] | None = None) -> DataFrame:
    """First month's flow, then month-to-month differences (companies with
    at least two months only)."""
    d = period_rows(rep, periods)
    w = Window.partitionBy("ID").orderBy("year_month")
    n = F.count(F.lit(1)).over(Window.partitionBy("ID"))
    prev = F.lag("fluxo_liquido").over(w)
    return (d.select("ID", "year_month", "ym_str", n.alias("_n"),
                     F.when(prev.isNull(), F.col("fluxo_liquido")).otherwise(F.col("fluxo_liquido") - prev)
                     .alias("delta"))
            .filter(F.col("_n") >= 2).drop("_n"))


def revenue_growth_pairs(rep: DataFrame, periods: list[str] | None = None) -> DataFrame:
    """Revenue vs growth % per company month, coloured by net flow."""
    return period_rows(rep, periods).select(
        "ID", "ym_str", F.col("receita_mensal").alias("receita"),
        (F.col("g_receita_mom") * 100).alias("crescimento_pct"), F.col("fluxo_liquido").alias("fluxo"))


def radar_scores(summary: DataFrame) -> DataFrame:
    """Five 0..100 scores per company."""
    return summary.select(
        "ID",
        clip(F.col("receita_media") / 100000 * 100, 0.0, 100.0).alias("receita"),
        clip(F.lit(50.0) + F.col("crescimento_medio") * 100, 0.0, 100.0).alias("crescimento"),
        clip(F.lit(50.0) + F.col("margem_media") * 100, 0.0, 100.0).alias("margem"),
        clip(F.col("consistencia_fluxo") * 100, 0.0, 100.0).alias("consistencia"),
        clip(F.lit(100.0) - F.col("volatilidade_receita"), 0.0, 100.0).alias("eficiencia"))


CORR_METRICS = ["receita_mensal", "despesa_mensal", "fluxo_liquido", "g_receita_mom", "vol_receita_3m"]


def metric_correlation(rep: DataFrame, periods: list[str] | None = None) -> DataFrame:
    """Pearson correlation matrix of the five monthly metrics per company,
    rounded half-even to 2 decimals; undefined (constant column) -> NULL."""
    d = period_rows(rep, periods)
    pairs = [(a, b) for a in CORR_METRICS for b in CORR_METRICS]
    # corr() raises on a constant column under ANSI mode: covariance over the
    # product of standard deviations with a NULL-safe division instead
    g = d.groupBy("ID").agg(*[
        F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b)).alias(f"{a}|{b}") for a, b in pairs])
    long = g.select("ID", F.explode(F.array(*[
        F.struct(F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"), F.col(f"`{a}|{b}`").alias("c"))
        for a, b in pairs])).alias("p")).select("ID", "p.*")
    return long.select("ID", "metric_a", "metric_b",
                       F.when(F.isnan("c"), F.lit(None)).otherwise(F.bround("c", 2)).alias("corr"))


def simple_competitive_score(summary: DataFrame, companies: DataFrame) -> DataFrame:
    """clip(rev/100k*30, 0, 30) + clip(15 + growth*50, 0, 30) +
    clip(consistency*40, 0, 40); 50 for a company without a summary."""
    s = (clip(F.col("receita_media") / 100000 * 30, 0.0, 30.0)
         + clip(F.lit(15.0) + F.col("crescimento_medio") * 50, 0.0, 30.0)
         + clip(F.col("consistencia_fluxo") * 40, 0.0, 40.0))
    ids = companies.select("ID").distinct()
    return ids.join(summary.select("ID", s.alias("_s")), "ID", "left").select(
        "ID", F.when(F.col("_s").isNull(), F.lit(50.0)).otherwise(F.col("_s")).alias("score"))


def trend_series(rep: DataFrame) -> DataFrame:
    """Per company month: revenue, fitted linear trend (row index), growth %,
    volatility and rolling-3 positive-flow share % (min 1 row)."""
    w = Window.partitionBy("ID").orderBy("year_month")
    whole = Window.partitionBy("ID")
    x = (F.row_number().over(w) - 1).cast("double")
    d = rep.select("*", x.alias("_x"))
    n = F.count(F.lit(1)).over(whole)
    slope = F.regr_slope("receita_mensal", "_x").over(whole)
    icpt = F.regr_intercept("receita_mensal", "_x").over(whole)
    return d.select("ID", "year_month", "ym_str", F.col("receita_mensal").alias("receita"),
                    F.when(n > 1, icpt + slope * F.col("_x")).alias("tendencia"),
                    (F.col("g_receita_mom") * 100).alias("crescimento_pct"),
                    F.col("vol_receita_3m").alias("volatilidade"),
                    (F.avg((F.col("fluxo_liquido") > 0).cast("double")).over(w.rowsBetween(-2, 0)) * 100)
                    .alias("consistencia_pct"))


def period_insights(rep: DataFrame, stages: DataFrame | None = None, periods: list[str] | None = None) -> DataFrame:
    """Insight codes per company over the chosen months: revenue trend
    (slope > 1000 up, < -1000 down; 'stable' only with a single month),
    positive-flow share (>= .8 / < .5), margin Σflow/(Σrevenue+1e-9)
    (> .2 / < 0) and stage recommendations (accent-insensitive stage)."""
    d = period_rows(rep, periods)
    w = Window.partitionBy("ID").orderBy("year_month")
    d = d.select("*", (F.row_number().over(w) - 1).cast("double").alias("_x"))
    g = d.groupBy("ID").agg(F.count(F.lit(1)).alias("_n"), F.regr_slope("receita_mensal", "_x").alias("_slope"),
                            F.avg((F.col("fluxo_liquido") > 0).cast("double")).alias("_pos"),
                            (F.sum("fluxo_liquido") / (F.sum("receita_mensal") + F.lit(1e-9))).alias("_margin"))
    if stages is not None:
        g = g.join(stages.select("ID", "estagio").dropDuplicates(["ID"]), "ID", "left")
    else:
        g = g.withColumn("estagio", F.lit(None).cast("string"))
    st = fold_accents(F.coalesce(F.col("estagio"), F.lit("N/D")))
    multi = F.col("_n") > 1
    codes = compact_array(
        (multi & (F.col("_slope") > 1000), "revenue_trend_up"),
        (multi & (F.col("_slope") < -1000), "revenue_trend_down"),
        (~multi, "revenue_stable"),
        (F.col("_pos") >= 0.8, "consistent_positive_flow"),
        (F.col("_pos") < 0.5, "negative_flow_majority"),
        (F.col("_margin") > 0.2, "healthy_margin"),
        (F.col("_margin") < 0, "negative_margin"),
        (st == "Inicio", "recs_start"), (st == "Crescimento", "recs_growth"),
        (st == "Maturidade", "recs_maturity"), (st == "Declinio", "recs_decline"))
    return g.select("ID", F.coalesce(F.col("estagio"), F.lit("N/D")).alias("estagio"), codes.alias("insights"))
