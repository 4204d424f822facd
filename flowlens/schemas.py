"""Explicit schemas of the two source tables and the monthly fact table.

Months are carried as ``DateType`` month starts (the first of the month):
no time-zone ambiguity and the same type in every engine.
"""
from __future__ import annotations

from pyspark.sql import types as T

BASE1 = T.StructType([
    T.StructField("ID", T.StringType(), False),
    T.StructField("DT_REFE", T.DateType(), True),
    T.StructField("VL_FATU", T.DoubleType(), True),
    T.StructField("VL_SLDO", T.DoubleType(), True),
    T.StructField("DT_ABRT", T.DateType(), True),
    T.StructField("DS_CNAE", T.StringType(), True),
])

BASE2 = T.StructType([
    T.StructField("ID_PGTO", T.StringType(), True),
    T.StructField("ID_RCBE", T.StringType(), True),
    T.StructField("DT_REFE", T.DateType(), True),
    T.StructField("VL", T.DoubleType(), True),
    T.StructField("DS_TRAN", T.StringType(), True),
])

# Raw ledger as it arrives: amount and channel are free text.
BASE2_RAW = T.StructType([
    T.StructField("ID_PGTO", T.StringType(), True),
    T.StructField("ID_RCBE", T.StringType(), True),
    T.StructField("DT_REFE", T.TimestampType(), True),
    T.StructField("VL", T.StringType(), True),
    T.StructField("DS_TRAN", T.StringType(), True),
])

# Raw profile as it arrives: values may be text.
BASE1_RAW = T.StructType([
    T.StructField("ID", T.StringType(), True),
    T.StructField("DT_REFE", T.TimestampType(), True),
    T.StructField("VL_FATU", T.StringType(), True),
    T.StructField("VL_SLDO", T.StringType(), True),
    T.StructField("DT_ABRT", T.DateType(), True),
    T.StructField("DS_CNAE", T.StringType(), True),
])

FLOW_METRICS = ["receita_mensal", "despesa_mensal", "fluxo_liquido",
                "g_receita_mom", "vol_receita_3m"]
