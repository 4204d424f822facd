"""Exact percentiles by rank selection, for groups of any size.

``F.percentile`` keeps a value -> count map of a whole group in one task.
Here values are reduced to distinct ones with counts, split into buckets at
approximate quantiles (as many as the largest group needs), and only the
buckets that hold a wanted rank are ranked.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Distinct values of a bucket, about: what one task ranks.
BUCKET_VALUES = 50_000


def exact_percentiles(rows: DataFrame, keys: list[str], value: str, fractions: list[float],
                      bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """keys, n (non-null values), q0, q1, ...: the linearly interpolated
    percentile at each fraction.  Groups without a value have no row."""
    v = F.col(value)
    distinct = rows.filter(v.isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    sizes = distinct.groupBy(*keys).agg(F.sum("_c").alias("n"), F.count(F.lit(1)).alias("_d"))
    largest = sizes.agg(F.max("_d")).first()[0] or 0
    buckets = max(1, math.ceil(largest / bucket_values))
    group = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]

    def named(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})

    def joined(left: DataFrame, right: DataFrame, *more) -> DataFrame:
        on = [*group, *more]
        out = left.join(named(right), on) if on else left.crossJoin(right)  # one row a group
        return out.drop(*[f"_k{i}" for i in range(len(keys))])

    placed = distinct.withColumn("_bk", F.lit(0))
    if buckets > 1:
        cuts = [i / buckets for i in range(1, buckets)]
        bounds = distinct.groupBy(*keys).agg(F.percentile_approx(value, cuts, 10 * buckets).alias("_b"))
        placed = joined(distinct, bounds).withColumn("_bk", F.size(F.filter("_b", lambda x: x < v))).drop("_b")
    per = placed.groupBy(*keys, "_bk").agg(F.sum("_c").alias("_bc"))
    earlier = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)  # a row a bucket
    per = per.withColumn("_before", F.coalesce(F.sum("_bc").over(earlier), F.lit(0)))
    per = joined(per, sizes.drop("_d"))
    spots = [F.lit(f) * (F.col("n") - 1) for f in fractions]
    low, high = [F.floor(s) for s in spots], [F.ceil(s) for s in spots]
    held = F.lit(False)
    for r in (*low, *high):
        held = held | ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_bc")))
    per = per.filter(held).select(*keys, F.col("_bk").alias("_pk"), "_before", "n")
    wanted = joined(placed, per, F.col("_bk") == F.col("_pk"))
    upto = F.col("_before") + F.sum("_c").over(
        Window.partitionBy(*keys, "_bk").orderBy(v).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wanted = wanted.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("_c"))

    def at(rank):
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_upto")), v.cast("double")))

    picks = [x for i in range(len(fractions)) for x in (at(low[i]).alias(f"_l{i}"), at(high[i]).alias(f"_h{i}"))]
    out = wanted.groupBy(*keys, "n").agg(*picks)
    return out.select(*keys, "n", *[
        F.when(low[i] == high[i], F.col(f"_l{i}"))
        .otherwise((high[i] - spots[i]) * F.col(f"_l{i}") + (spots[i] - low[i]) * F.col(f"_h{i}")).alias(f"q{i}")
        for i in range(len(fractions))])


def column_percentiles(df: DataFrame, cols: list[str], fractions: list[float]) -> dict[str, list | None]:
    """Percentiles of whole columns: one small row a column comes to the driver;
    None for a column without a value."""
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("x")).select("x.*")
    got = {r["column"]: [r[f"q{i}"] for i in range(len(fractions))]
           for r in exact_percentiles(long, ["column"], "value", fractions).collect()}
    return {c: got.get(c) for c in cols}
