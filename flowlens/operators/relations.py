"""Counterparty relations over the shared ``edges_month`` pre-aggregate.

All operators handle every company at once.  Company-level totals are
computed with a separate aggregation and joined back (no window over a
company key that may be hot); top-k per company uses ``row_number <= k``,
which Spark plans with a partial ``WindowGroupLimit`` before the shuffle,
so a hub company with millions of counterparties ships only k rows per
map partition.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_month(edges: DataFrame) -> F.Column:
    """Dataset-wide last month (scalar subquery)."""
    return edges.select(F.max("year_month")).scalar()


def month_window(edges: DataFrame, months_window: int, last=None) -> DataFrame:
    if last is None:
        last = last_month(edges)
    elif not isinstance(last, F.Column):
        last = F.to_date(F.lit(str(last)))  # 'yyyy-MM-dd' text or a date
    first = F.add_months(last, -(months_window - 1))
    return edges.filter((F.col("year_month") >= first) & (F.col("year_month") <= last))


def directed_legs(edges: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Each edge seen from both companies: direction 'in' (company received
    from counterparty) and 'out' (company paid counterparty)."""
    extra = extra or []
    return edges.select(*extra, F.explode(F.array(
        F.struct(F.col("dst").alias("company_id"), F.col("src").alias("counterparty"),
                 F.lit("in").alias("direction"), F.col("valor").alias("valor")),
        F.struct(F.col("src").alias("company_id"), F.col("dst").alias("counterparty"),
                 F.lit("out").alias("direction"), F.col("valor").alias("valor")),
    )).alias("l")).select(*extra, "l.*")


def relation_importance(edges: DataFrame, months_window: int = 12, last=None) -> DataFrame:
    """Per (company, counterparty, direction) over the last N months ending at
    the dataset-wide last month: value, distinct months, share of the
    company's total, monthly frequency and score = 0.6*share + 0.4*freq."""
    legs = directed_legs(month_window(edges, months_window, last), ["year_month"])
    pair = legs.groupBy("company_id", "direction", "counterparty").agg(
        F.sum("valor").alias("valor"), F.countDistinct("year_month").alias("meses"))
    comp = legs.groupBy("company_id", "direction").agg(
        F.sum("valor").alias("_tot"), F.countDistinct("year_month").alias("_n_meses"))
    j = pair.join(comp, ["company_id", "direction"])
    share = F.try_divide(F.col("valor"), F.col("_tot"))
    freq = F.col("meses") / F.greatest(F.lit(1), F.col("_n_meses"))
    return j.select("counterparty", "valor", "meses", share.alias("share"),
                    freq.alias("freq_mensal"),
                    (F.lit(0.6) * share + F.lit(0.4) * freq).alias("score"),
                    "company_id", "direction")


def top_relations(importance: DataFrame, companies: DataFrame, k: int = 10) -> DataFrame:
    """Top k counterparties per company and direction by score (ties by
    counterparty id), only for companies present in the profile."""
    w = Window.partitionBy("company_id", "direction").orderBy(F.col("score").desc(), F.col("counterparty"))
    ranked = importance.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    ids = companies.select(F.col("ID").alias("company_id")).distinct()
    return ranked.join(ids, "company_id", "left_semi").withColumn("rank", F.col("rank").cast("long"))


def concentration_hhi(importance: DataFrame) -> DataFrame:
    """HHI of counterparties received-from (in) and paid-to (out) over the
    same window; NULL when the company has no payment in that direction."""
    sq = F.col("share") * F.col("share")
    return importance.groupBy("company_id").agg(
        F.sum(F.when(F.col("direction") == "in", sq)).alias("hhi_in"),
        F.sum(F.when(F.col("direction") == "out", sq)).alias("hhi_out"))


def ego_edges_by_month(edges: DataFrame, year_month=None, direction: str = "both",
                       top_n: int = 15) -> DataFrame:
    """For one month (default: the last): edges (src, dst, value) touching
    each company, by direction, top_n heaviest per company."""
    return ego_edges(edges, year_month, 1, direction, top_n, None).withColumnRenamed("weight", "valor")


def ego_edges(edges: DataFrame, year_month=None, months_window: int = 3,
              direction: str = "both", top_n: int = 25, channels: list[str] | None = None) -> DataFrame:
    """Ego-network edges of every company: months window ending at
    ``year_month`` (default: last month), optional channel filter ('TODOS' or
    None = all), direction in/out/both; Σ value by (src, dst); the top_n
    heaviest edges per ego (ties by src, dst)."""
    win = month_window(edges, months_window, year_month)
    if channels and "TODOS" not in [c.upper() for c in channels]:
        win = win.filter(F.upper(F.trim(F.col("channel"))).isin([c.upper() for c in channels]))
    pair = win.groupBy("src", "dst").agg(F.sum("valor").alias("weight"))
    sides = []
    if direction in ("in", "both"):
        sides.append(F.struct(F.col("dst").alias("ego")))
    if direction in ("out", "both"):
        sides.append(F.struct(F.col("src").alias("ego")))
    if direction == "both":
        # a self-loop would be the same edge twice for one ego
        exploded = pair.select("src", "dst", "weight", F.explode(F.array_distinct(F.array(*sides))).alias("e"))
    else:
        exploded = pair.select("src", "dst", "weight", F.explode(F.array(*sides)).alias("e"))
    w = Window.partitionBy("ego").orderBy(F.col("weight").desc(), "src", "dst")
    return (exploded.select(F.col("e.ego").alias("ego"), "src", "dst", "weight")
            .withColumn("edge_rank", F.row_number().over(w))
            .filter(F.col("edge_rank") <= top_n)
            .withColumn("edge_rank", F.col("edge_rank").cast("long")))
