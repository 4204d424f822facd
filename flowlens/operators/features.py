"""Feature engineering for life-cycle staging and the rule labels.

Per-company windows run over the monthly fact table (at most one row per
company and month), so no window partition can exceed the month count.
Global statistics (medians, clip bounds, scaler parameters) are computed
by one aggregation and used as a scalar subquery -- no driver round trip,
no cross join.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.percentiles import column_percentiles
from ..functions.columns import (age_years, finite_or_null, sector_capital_intensive, sector_cycle,
                                 sector_of, size_of, size_ordinal)
from ..session import stored

EPS = 1e-6


# ----------------------------------------------------------- stage features
def stage_features(f: DataFrame, months_window: int = 12) -> DataFrame:
    """Eleven behaviour metrics over each company's last ``months_window``
    rows; companies with fewer than 3 rows are skipped.  The previous row
    used by the recovery rate is taken *after* the tail cut."""
    base = f.filter(F.col("year_month").isNotNull()).select(
        "ID", "year_month",
        F.coalesce(F.col("receita_mensal"), F.lit(0.0)).alias("rec"),
        F.coalesce(F.col("fluxo_liquido"), F.col("receita_mensal") - F.col("despesa_mensal"), F.lit(0.0)).alias("flx"),
        F.col("g_receita_mom").alias("g"), F.col("vol_receita_3m").alias("v3"))
    desc = Window.partitionBy("ID").orderBy(F.col("year_month").desc())
    tail = base.withColumn("_rd", F.row_number().over(desc)).filter(F.col("_rd") <= months_window)
    asc = Window.partitionBy("ID").orderBy("year_month")
    tail = tail.withColumn("_gp", F.lag("g").over(asc))
    g, gp = F.col("g"), F.col("_gp")
    up = F.coalesce((gp < -0.10) & (g > 0), F.lit(False))
    agg = tail.groupBy("ID").agg(
        F.count(F.lit(1)).alias("num_meses"),
        F.avg("rec").alias("_mean"), F.sum("rec").alias("receita_total_periodo"),
        F.stddev_samp("rec").alias("_sd"),
        F.count("g").alias("_g_n"), F.avg(finite_or_null(g)).alias("_g_mean"),
        F.count("v3").alias("_v_n"), F.avg(F.coalesce(F.col("v3"), F.lit(0.0))).alias("_v_mean"),
        F.avg("flx").alias("fluxo_liquido_medio"),
        F.avg(F.col("flx") / (F.col("rec") + F.lit(EPS))).alias("margem_media"),
        F.regr_slope(F.col("rec"), (-F.col("_rd")).cast("double")).alias("tendencia_receita"),
        F.count(F.when(up, 1)).alias("_rec_n"),
        F.count(F.when(g < -0.10, 1)).alias("_drops"),
        F.avg((F.col("flx") > 0).cast("double")).alias("consistencia_fluxo_positivo"),
    ).filter(F.col("num_meses") >= 3)
    mean = F.col("_mean")
    return agg.select(
        "ID",
        mean.alias("receita_mensal_media"),
        "receita_total_periodo",
        F.when(F.col("_g_n") > 0, F.col("_g_mean")).otherwise(F.lit(0.0)).alias("crescimento_mom_medio"),
        F.when(F.col("_v_n") > 0, F.col("_v_mean")).otherwise(F.col("_sd")).alias("volatilidade_receita"),
        "fluxo_liquido_medio", "margem_media", "tendencia_receita",
        F.when(mean > 0, F.col("_sd") / (mean + F.lit(EPS))).otherwise(F.lit(0.0)).alias("coef_variacao_receita"),
        (F.col("_rec_n") / (F.col("_drops") + F.lit(EPS))).alias("taxa_recuperacao"),
        "consistencia_fluxo_positivo",
        F.col("num_meses").cast("long").alias("num_meses"),
    )


def global_stats(df: DataFrame, exprs: dict) -> dict:
    """One aggregation over ``df`` returning a single small row (the fitted
    parameters); values are then used as literals, like a fitted scaler.
    Keeps plans flat: chained scalar subqueries would be re-optimised per
    reference."""
    row = df.agg(*[e.alias(k) for k, e in exprs.items()]).first()
    return {k: row[k] for k in exprs}


def stage_features_clean(feats: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """inf -> NULL, NULL -> column median, clip to [q01, q99], then robust
    scaling (x - median) / IQR with IQR 0 -> 1.  Exact linear percentiles."""
    cols = cols or [c for c in C.CLUSTER_FEATURES if c in feats.columns]
    x = feats.select("ID", *[finite_or_null(c).alias(c) for c in cols])
    med = column_percentiles(x, cols, [0.5])
    filled = x.select("ID", *[F.coalesce(F.col(c), F.lit(med[c][0] if med[c] else None).cast("double")).alias(c)
                              for c in cols])
    q = column_percentiles(filled, cols, [0.01, 0.99])

    def bound(c, i):
        return F.lit(q[c][i] if q[c] is not None else None).cast("double")
    clipped = filled.select("ID", *[F.least(F.greatest(F.col(c), bound(c, 0)), bound(c, 1)).alias(c)
                                    for c in cols])
    r = column_percentiles(clipped, cols, [0.25, 0.5, 0.75])
    out = []
    for c in cols:
        q25, q50, q75 = r[c] if r[c] is not None else (None, None, None)
        iqr = None if q25 is None else q75 - q25
        scale = 1.0 if (iqr is None or iqr == 0) else iqr
        out.append(((F.col(c) - F.lit(q50).cast("double")) / F.lit(scale)).alias(c))
    return clipped.select("ID", *out)


def cluster_stage_rules(profiles: DataFrame) -> DataFrame:
    """Map each cluster profile to a stage; percentiles are taken across the
    cluster profiles (revenue p25, flow p50, volatility p50)."""
    pct = {k: F.lit(v).cast("double") for k, v in global_stats(profiles, {
        "rev25": F.percentile("receita_media", F.lit(0.25)),
        "flx50": F.percentile("fluxo", F.lit(0.5)),
        "vol50": F.percentile("vol", F.lit(0.5))}).items()}
    rev, flx, gr, vol = F.col("receita_media"), F.col("fluxo"), F.col("crescimento"), F.col("vol")
    stage = (F.when((rev <= pct["rev25"]) & (vol > pct["vol50"]), F.lit(C.STAGES[0]))
             .when((flx > pct["flx50"]) & (gr > 0.02), F.lit(C.STAGES[1]))
             .when((flx > 0) & (vol < pct["vol50"]) & (F.abs(gr) < 0.05), F.lit(C.STAGES[2]))
             .when((flx < -1000) | (gr < -0.05), F.lit(C.STAGES[3]))
             .otherwise(F.lit(C.STAGES[4])))
    return profiles.withColumn("estagio", stage)


def cluster_profiles(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """Per cluster: mean unscaled revenue, growth, flow, consistency and
    volatility, and the stage assigned by the rules."""
    j = feats.join(labels.select("ID", "cluster_id"), "ID")
    prof = j.groupBy("cluster_id").agg(
        F.avg("receita_mensal_media").alias("receita_media"),
        F.avg("crescimento_mom_medio").alias("crescimento"),
        F.avg("fluxo_liquido_medio").alias("fluxo"),
        F.avg("consistencia_fluxo_positivo").alias("consist"),
        F.avg("volatilidade_receita").alias("vol"))
    return cluster_stage_rules(prof)


# ------------------------------------------------------ supervised features
def profile_features(base1: DataFrame, as_of: str) -> DataFrame:
    """Profile-derived features per profile row."""
    return base1.select(
        "ID", "DT_REFE", "VL_FATU", "VL_SLDO", "DT_ABRT", "DS_CNAE",
        age_years("DT_ABRT", as_of).alias("idade_anos"),
        sector_of("DS_CNAE").alias("setor"),
        size_of("VL_FATU").alias("porte"),
        F.coalesce((F.col("VL_SLDO") > 0).cast("int"), F.lit(0)).alias("saude_saldo"),
        F.log1p(F.coalesce(F.col("VL_FATU"), F.lit(0.0))).alias("faturamento_normalizado"),
        sector_cycle(sector_of("DS_CNAE")).alias("ciclo_setor_anos"),
        sector_capital_intensive(sector_of("DS_CNAE")).alias("capital_intensivo"),
    )


def behaviour_features(flows: DataFrame, edges: DataFrame) -> DataFrame:
    """Per company over all its flow months (companies with >= 2): trends,
    coefficients of variation, positive shares, means, counterparty
    diversification (distinct payers + distinct payees) and channels."""
    w = Window.partitionBy("ID").orderBy("year_month")
    m = flows.select("ID", "year_month", F.col("receita_mensal").alias("r"), F.col("fluxo_liquido").alias("fl"),
                     (F.row_number().over(w) - 1).cast("double").alias("x"))
    beh = m.groupBy("ID").agg(
        F.count(F.lit(1)).alias("num_meses_ativo"),
        F.regr_slope("r", "x").alias("receita_trend"), F.regr_slope("fl", "x").alias("fluxo_trend"),
        (F.stddev_samp("r") / (F.avg("r") + F.lit(EPS))).alias("receita_cv"),
        (F.stddev_samp("fl") / (F.abs(F.avg("fl")) + F.lit(EPS))).alias("fluxo_cv"),
        F.avg((F.col("r") > 0).cast("double")).alias("consistencia_receita"),
        F.avg((F.col("fl") > 0).cast("double")).alias("consistencia_fluxo"),
        F.avg("r").alias("receita_media"), F.avg("fl").alias("fluxo_medio"),
    ).filter(F.col("num_meses_ativo") >= 2)
    # partners: rows of the distinct pairs; channels: bits of their places in the fixed list
    places = F.when(F.col("channel").isNotNull(), F.lit(1 << len(C.CHANNELS)))
    for i, c in enumerate(C.CHANNELS):
        places = F.when(F.col("channel") == c, F.lit(1 << i)).otherwise(places)
    pairs = edges.groupBy("src", "dst").agg(F.bit_or(places).alias("bits"))
    legs = pairs.select(F.explode(F.array(F.struct(F.col("dst").alias("ID"), "bits"), F.struct(F.col("src").alias("ID"), "bits"))).alias("l")).select("l.*")
    rel = legs.groupBy("ID").agg(F.count(F.lit(1)).alias("diversificacao_contrapartes"),
                                 F.bit_count(F.coalesce(F.bit_or("bits"), F.lit(0))).alias("canais_utilizados"))
    return beh.join(rel, "ID", "left").select(
        "ID", "receita_trend", "fluxo_trend", "receita_cv", "fluxo_cv", "consistencia_receita",
        "consistencia_fluxo",
        F.coalesce(F.col("diversificacao_contrapartes"), F.lit(0)).cast("long").alias("diversificacao_contrapartes"),
        F.coalesce(F.col("canais_utilizados"), F.lit(0)).cast("long").alias("canais_utilizados"),
        "receita_media", "fluxo_medio", F.col("num_meses_ativo").cast("long").alias("num_meses_ativo"))


SUP_NUMERIC = ["VL_FATU", "VL_SLDO", "idade_anos", "saude_saldo", "faturamento_normalizado",
               "ciclo_setor_anos", "capital_intensivo", "receita_trend", "fluxo_trend", "receita_cv",
               "fluxo_cv", "consistencia_receita", "consistencia_fluxo", "diversificacao_contrapartes",
               "canais_utilizados", "receita_media", "fluxo_medio", "num_meses_ativo",
               "maturidade_relativa", "performance_vs_porte", "eficiencia_capital"]


def supervised_features(base1: DataFrame, flows: DataFrame, edges: DataFrame, as_of: str) -> DataFrame:
    """Profile features inner-joined with behaviour features on ID: one row
    per (ID, profile month), behaviour repeated.  Hybrid ratios, then
    +/-inf -> NULL, numeric NULL -> column median, opening date NULL -> mode."""
    prof = profile_features(base1, as_of)
    j = prof.join(stored(behaviour_features(flows, edges), "behaviour"), "ID", "inner")
    j = j.select("*",
                 (F.col("idade_anos") / F.when(F.col("ciclo_setor_anos") == 0, F.lit(1))
                  .otherwise(F.col("ciclo_setor_anos"))).alias("maturidade_relativa"),
                 F.try_divide(F.col("receita_media"), F.col("VL_FATU") / 12 + F.lit(EPS)).alias("performance_vs_porte"),
                 F.try_divide(F.col("fluxo_medio"), F.abs(F.col("VL_SLDO")) + F.lit(EPS)).alias("eficiencia_capital"))
    dbl = [c for c in SUP_NUMERIC if c not in ("saude_saldo", "ciclo_setor_anos", "capital_intensivo",
                                                "diversificacao_contrapartes", "canais_utilizados",
                                                "num_meses_ativo")]
    # the statistics read this several times, a few columns each
    j = stored(j.select(*[finite_or_null(c).alias(c) if c in dbl else F.col(c) for c in j.columns]), "supervised")
    # medians only fill NULLs: count them first (cheap), then run the exact
    # global percentile / mode only for the columns that need it
    stats = global_stats(j, {**{f"_n_{c}": F.count(F.when(F.col(c).isNull(), 1)) for c in SUP_NUMERIC},
                             "_dt_mode": F.mode("DT_ABRT", True)})
    need = [c for c in SUP_NUMERIC if stats[f"_n_{c}"]]
    stats.update({c: None for c in SUP_NUMERIC})
    stats.update({c: got[0] for c, got in column_percentiles(j, need, [0.5]).items() if got})
    out = []
    for c in j.columns:
        if c in dbl:
            out.append(F.coalesce(F.col(c), F.lit(stats[c]).cast("double")).alias(c))
        elif c in SUP_NUMERIC:
            out.append(F.coalesce(F.col(c), F.lit(stats[c]).cast(j.schema[c].dataType)).alias(c))
        elif c == "DT_ABRT":
            out.append(F.coalesce(F.col(c), F.lit(stats["_dt_mode"]).cast("date")).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def business_labels(sup: DataFrame) -> DataFrame:
    """Ordered rules -> training label (first match wins; NULL compares false)."""
    age, mat, size = F.col("idade_anos"), F.col("maturidade_relativa"), F.col("porte")
    cons, trend, flow, div = (F.col("consistencia_fluxo"), F.col("receita_trend"), F.col("fluxo_medio"),
                              F.col("diversificacao_contrapartes"))
    s = (F.when((age < 2) | (mat < 0.3) | ((size == "MICRO") & (age < 3)), F.lit(C.STAGES[0]))
         .when((trend > 0) & (cons > 0.6) & (flow > 0) & (mat >= 0.3) & (mat < 0.7) & (div >= 3), F.lit(C.STAGES[1]))
         .when((mat >= 0.7) & (cons > 0.7) & (F.abs(trend) < 1000) & (div >= 5) & (flow > 0), F.lit(C.STAGES[2]))
         .when((flow < 0) | (trend < -1000) | (cons < 0.3), F.lit(C.STAGES[3]))
         .otherwise(F.lit(C.STAGES[4])))
    return sup.withColumn("label", s)


def rule_stages(labelled: DataFrame) -> DataFrame:
    """One stage per company from the rule labels: the label of its latest
    profile row, with confidence = share of its profile rows carrying it."""
    per = labelled.filter(F.col("ID").isNotNull()).groupBy("ID", "label").agg(
        F.max("DT_REFE").alias("last"), F.count(F.lit(1)).alias("n"))  # a row a label of a company
    best = per.groupBy("ID").agg(F.max(F.struct("last", "label", "n")).alias("s"), F.sum("n").alias("rows"))
    return best.select("ID", F.col("s.label").alias("estagio"),
                       (F.col("s.n").cast("double") / F.col("rows").cast("double")).alias("confianca"))


# ----------------------------------------------------------- ensemble inputs
def company_profile(summary: DataFrame, sup: DataFrame, stages: DataFrame | None = None) -> DataFrame:
    """One row per company for benchmarking and the ensemble: the reporting
    summary (financial means, growth, volatility, margin, consistency) plus
    the latest supervised profile (age, maturity, sector, size, trends,
    diversification, channels) and optionally a stage."""
    w = Window.partitionBy("ID").orderBy(F.col("DT_REFE").desc())
    latest = sup.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).select(
        "ID", "idade_anos", "maturidade_relativa", "setor", "porte", "receita_trend", "fluxo_trend",
        "diversificacao_contrapartes", "canais_utilizados")
    s = summary.select("ID", "receita_media", "despesa_media", "fluxo_medio", "margem_media", "receita_total",
                       "crescimento_medio", "volatilidade_receita", "consistencia_fluxo")
    out = s.join(latest, "ID", "inner")
    if stages is not None:
        out = out.join(stages.select("ID", "estagio", "confianca"), "ID", "left")
    return out


def ensemble_features(df: DataFrame) -> DataFrame:
    """Model inputs: financial (NULL -> 0), age (NULL -> 5), maturity
    (NULL -> .5), one-hot over the fixed sector list, size ordinal, trends
    (NULL -> 0), diversification (NULL -> 0), channels (NULL -> 1)."""
    cols = [F.col("ID")]
    for c in C.ENSEMBLE_FINANCIAL:
        if c in df.columns:
            cols.append(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c))
    if "idade_anos" in df.columns:
        cols.append(F.coalesce(F.col("idade_anos"), F.lit(5.0)).alias("idade_anos"))
    if "maturidade_relativa" in df.columns:
        cols.append(F.coalesce(F.col("maturidade_relativa"), F.lit(0.5)).alias("maturidade_relativa"))
    if "setor" in df.columns:
        for s in sorted(C.SECTORS):
            cols.append((F.col("setor") == s).cast("double").alias(f"setor_{s}"))
    if "porte" in df.columns:
        cols.append(size_ordinal("porte").alias("porte_encoded"))
    for c in ("receita_trend", "fluxo_trend", "diversificacao_contrapartes"):
        if c in df.columns:
            cols.append(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c))
    if "canais_utilizados" in df.columns:
        cols.append(F.coalesce(F.col("canais_utilizados").cast("double"), F.lit(1.0)).alias("canais_utilizados"))
    if len(cols) == 1:
        cols.append(F.lit(0.0).alias("zero"))
    return df.select(*cols)


def ensemble_labels(df: DataFrame) -> DataFrame:
    """Ordered label rules; an absent column takes its default (age 5,
    money/growth/margin 0, consistency .5); a NULL value compares false."""
    def g(c, d):
        return F.col(c) if c in df.columns else F.lit(d)
    age, rev, flow = g("idade_anos", 5.0), g("receita_media", 0.0), g("fluxo_medio", 0.0)
    gr, cons, mar = g("crescimento_medio", 0.0), g("consistencia_fluxo", 0.5), g("margem_media", 0.0)
    s = (F.when((age < 2) | ((age < 3) & (rev < 50000)), F.lit(C.STAGES[0]))
         .when((gr > 0.1) & (cons > 0.6) & (flow > 0) & (mar > 0.05), F.lit(C.STAGES[1]))
         .when((F.abs(gr) < 0.05) & (cons > 0.7) & (flow > 0) & (age > 5), F.lit(C.STAGES[2]))
         .when((flow < -5000) | ((gr < -0.1) & (cons < 0.4)), F.lit(C.STAGES[3]))
         .otherwise(F.lit(C.STAGES[4])))
    return df.select("ID", s.alias("label"))
