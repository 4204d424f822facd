import datetime as dt

from pyspark.sql import types as T

from flowlens.schemas import BASE1, BASE2


def m(year, month):
    return dt.date(year, month, 1)


def ledger(spark, rows):
    """rows: (payer, receiver, date, value[, channel])"""
    out = [(r[0], r[1], r[2], float(r[3]), r[4] if len(r) > 4 else "PIX") for r in rows]
    return spark.createDataFrame(out, BASE2)


def profile(spark, rows):
    """rows: (id, date, revenue, balance, opened, activity)"""
    return spark.createDataFrame(rows, BASE1)


def edges(spark, rows):
    """rows: (src, dst, month, value[, n])"""
    schema = T.StructType([T.StructField("src", T.StringType()), T.StructField("dst", T.StringType()),
                           T.StructField("year_month", T.DateType()), T.StructField("channel", T.StringType()),
                           T.StructField("valor", T.DoubleType()), T.StructField("n", T.LongType())])
    return spark.createDataFrame([(r[0], r[1], r[2], "PIX", float(r[3]), int(r[4]) if len(r) > 4 else 1)
                                  for r in rows], schema)
