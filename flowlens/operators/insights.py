"""Rule-based insight codes per company (stable codes, not prose).

Stage names are compared accent-insensitively so 'Início' and 'Inicio'
trigger the same rules."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import compact_array, fold_accents


def _num(df, c, default=0.0):
    return F.coalesce(F.col(c).cast("double"), F.lit(default)) if c in df.columns else F.lit(default)


def _stage(df):
    return fold_accents(F.col("estagio"))


def contextual_insights(df: DataFrame) -> DataFrame:
    """Per-stage messages by age, size, flow, consistency and revenue plus a
    confidence notice (< .6 low, > .9 high)."""
    st = _stage(df)
    age, flow, cons, rev = _num(df, "idade_anos"), _num(df, "fluxo_medio"), _num(df, "consistencia_fluxo"), _num(df, "receita_media")
    conf = _num(df, "confianca")
    size = F.coalesce(F.col("porte"), F.lit("MICRO")) if "porte" in df.columns else F.lit("MICRO")
    s, g, m, d, r = (st == "Inicio"), (st == "Crescimento"), (st == "Maturidade"), (st == "Declinio"), (st == "Reestruturacao")
    codes = compact_array(
        (s, "start_focus_validation"), (s & (age < 2), "start_young_company"), (s & (size == "MICRO"), "start_micro_programs"),
        (s & (flow < 0), "start_negative_flow_watch_burn"),
        (g, "growth_focus_scalability"), (g & (cons > 0.8), "growth_consistent_expand"),
        (g & (cons <= 0.8) & (cons < 0.6), "growth_inconsistent_review_costs"),
        (g & (rev > 100000), "growth_high_revenue_diversify"),
        (m, "maturity_focus_efficiency"), (m & (cons > 0.9), "maturity_very_stable_invest"),
        (m, "maturity_continuous_innovation"),
        (d, "decline_recovery_plan"), (d & (flow < -10000), "decline_renegotiate_debt"),
        (d & (cons < 0.3), "decline_daily_cash_control"),
        (r, "restructuring_monitor"), (r & (flow > 0), "restructuring_positive_flow"),
        (r & (cons > 0.5), "restructuring_consistency_improving"),
        (conf < 0.6, "model_confidence_low"), ((conf >= 0.6) & (conf > 0.9), "model_confidence_high"))
    return df.select("ID", "estagio", codes.alias("insights"))


def comparative_benchmarks(df: DataFrame) -> DataFrame:
    """Sector/size line and a revenue band (> 50k above, < 10k below)."""
    rev = _num(df, "receita_media")
    sec = F.coalesce(F.col("setor"), F.lit("OUTROS")) if "setor" in df.columns else F.lit("OUTROS")
    size = F.coalesce(F.col("porte"), F.lit("MICRO")) if "porte" in df.columns else F.lit("MICRO")
    codes = compact_array((F.lit(True), "sector_benchmark"), (rev > 50000, "revenue_above_peer_average"),
                          ((rev <= 50000) & (rev < 10000), "revenue_below_average"))
    return df.select("ID", sec.alias("setor"), size.alias("porte"), codes.alias("benchmarks"))


def actionable_recommendations(df: DataFrame) -> DataFrame:
    """Three fixed recommendations per stage plus two conditional ones
    (low consistency in growth/maturity; negative flow outside decline)."""
    st = _stage(df)
    cons, flow = _num(df, "consistencia_fluxo"), _num(df, "fluxo_medio")
    fixed = {"Inicio": ["weekly_cash_control", "track_traction_metrics", "seek_microcredit"],
             "Crescimento": ["executive_kpi_dashboard", "professionalise_processes", "working_capital_credit"],
             "Maturidade": ["innovation_programme", "adjacent_markets", "automation_digital"],
             "Declinio": ["daily_cash_tracking", "cut_non_essential_costs", "renegotiate_terms"],
             "Reestruturacao": ["ninety_day_plan", "transparent_communication", "focus_core_business"]}
    items = []
    for stage, recs in fixed.items():
        items += [(st == stage, r) for r in recs]
    items += [((cons < 0.4) & st.isin("Crescimento", "Maturidade"), "tighten_expense_control"),
              ((flow < 0) & (F.coalesce(st, F.lit("")) != "Declinio"), "cash_before_investment")]
    return df.select("ID", "estagio", compact_array(*items).alias("recommendations"))
