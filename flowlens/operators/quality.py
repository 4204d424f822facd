"""Data-quality checks on the two source tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C

CHECKS = ["duplicate_profile_key", "non_positive_amount", "self_payment",
          "channel_out_of_domain", "month_before_floor", "month_after_profile"]


def validate(base1: DataFrame, base2: DataFrame, date_floor: str = C.DATE_FLOOR) -> DataFrame:
    """Six checks -> rows ``(check, n_bad, failed)``; the build is ok iff no
    row failed.  The ledger checks share one aggregation pass; the profile
    contributes a duplicate count and its last month (scalar subquery)."""
    last_profile = base1.select(F.max("DT_REFE")).scalar()
    dup = (base1.groupBy("ID", "DT_REFE").count()
           .agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count") - 1)), F.lit(0))
                .cast("long").alias("n")))
    in_domain = F.coalesce(F.col("DS_TRAN").isin(C.CHANNELS), F.lit(False))
    floor = F.to_date(F.lit(date_floor))
    led = base2.agg(
        F.count(F.when(F.col("VL") <= 0, 1)).alias("non_positive_amount"),
        F.count(F.when(F.col("ID_PGTO") == F.col("ID_RCBE"), 1)).alias("self_payment"),
        F.count(F.when(~in_domain, 1)).alias("channel_out_of_domain"),
        F.count(F.when(F.col("DT_REFE") < floor, 1)).alias("month_before_floor"),
        F.count(F.when(F.col("DT_REFE") > last_profile, 1)).alias("month_after_profile"),
    )
    rows = dup.select(F.lit(CHECKS[0]).alias("check"), F.col("n").alias("n_bad")).unionByName(
        led.select(F.expr(
            "stack(5, 'non_positive_amount', non_positive_amount, 'self_payment', self_payment, "
            "'channel_out_of_domain', channel_out_of_domain, 'month_before_floor', month_before_floor, "
            "'month_after_profile', month_after_profile) AS (check, n_bad)")))
    return rows.select("check", F.col("n_bad").cast("long").alias("n_bad"),
                       (F.col("n_bad") > 0).alias("failed"))
