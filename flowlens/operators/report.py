"""Formatted report tables: every formatting rule is one projection over
the whole table (no per-row Python)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.formats import label_of, metric_value, polarity

DESCRIPTIONS = {
    "receita_mensal": "Money received by the company in the month",
    "despesa_mensal": "Money paid by the company in the month",
    "fluxo_liquido": "Monthly revenue minus monthly expense",
    "g_receita_mom": "Revenue change vs the previous month",
    "vol_receita_3m": "Standard deviation of revenue over three months",
    "consistencia_fluxo_positivo": "Share of months with positive net flow",
    "margem_media": "Average net flow relative to revenue",
    "tendencia_receita": "Slope of the linear revenue trend",
    "taxa_recuperacao": "Rebounds after strong revenue drops",
    "confianca": "Model confidence in the stage (0-1)",
}
DEFAULT_DESCRIPTION = "Company financial metric"


def format_report(df: DataFrame, keys: list[str], metrics: list[str] | None = None) -> DataFrame:
    """Keys plus one formatted text column per metric (unit-aware)."""
    metrics = metrics or [c for c in df.columns if c not in keys]
    return df.select(*keys, *[metric_value(m, F.col(m)).alias(m) for m in metrics])


def metric_cards(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Long table: keys, metric, label, numeric value, formatted value,
    polarity (positive/negative/neutral), unit and description."""
    metrics = [m for m in metrics if m in df.columns]
    cards = [F.struct(F.lit(m).alias("metric"), F.lit(label_of(m)).alias("label"),
                      F.col(m).cast("double").alias("value"), metric_value(m, F.col(m)).alias("formatted"),
                      polarity(m, F.col(m)).alias("polarity"), F.lit(C.METRIC_UNITS.get(m, "")).alias("unit"),
                      F.lit(DESCRIPTIONS.get(m, DEFAULT_DESCRIPTION)).alias("description"))
             for m in metrics]
    return df.select(*keys, F.explode(F.array(*cards)).alias("c")).select(*keys, "c.*")


def kpi_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Cards for stage, confidence, mean net flow and mean MoM growth when
    those columns are present (stage is reported as text)."""
    present = [m for m in C.KPI_METRICS if m in df.columns]
    cards = []
    for m in present:
        val = F.lit(None).cast("double") if m == "estagio" else F.col(m).cast("double")
        txt = F.col(m).cast("string") if m == "estagio" else metric_value(m, F.col(m))
        cards.append(F.struct(F.lit(m).alias("metric"), F.lit(label_of(m)).alias("label"), val.alias("value"),
                              txt.alias("formatted"), F.lit(C.METRIC_UNITS.get(m, "")).alias("unit")))
    return df.select(*keys, F.explode(F.array(*cards)).alias("c")).select(*keys, "c.*")


def display_names(columns: list[str], mapping: dict[str, str] | None = None) -> list[str]:
    out = []
    for c in columns:
        c2 = (mapping or {}).get(c, c)
        out.append(C.METRIC_LABELS.get(c2, c2.replace("_", " ").title()))
    return out


def rename_for_display(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Optional caller mapping, then standard labels, other names title-cased."""
    return df.toDF(*display_names(df.columns, mapping))
