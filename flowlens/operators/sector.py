"""Sector / peer benchmarking for all companies at once.

Input: one row per company with ``setor``, ``porte``, the metrics and
optionally ``estagio``.  Group statistics are exact linear percentiles by rank
selection over the grouping sets (sector x size, sector, all).

Peer ranks are exact but skew-proof: values are first reduced to distinct
values per group (partial aggregation), split into approximate-quantile
buckets, ranked inside (group, bucket) and offset by the counts of the
higher buckets -- a sector holding a third of all companies is spread
over many tasks instead of one window partition.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.percentiles import BUCKET_VALUES, exact_percentiles
from ..functions.columns import banded_ge, compact_array, finite_or_null


def rank_counts(df: DataFrame, keys: list[str], value: str, buckets: int | None = None) -> DataFrame:
    """For every row of ``df``: among the non-null ``value``s of its group,
    how many are strictly greater (``n_gt``), how many are <= (``n_le``) and
    how many exist (``n_total``).  Returns keys + value + the three counts,
    one row per distinct (keys, value)."""
    dv = (df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
          .agg(F.count(F.lit(1)).alias("_c")))
    if buckets is None:  # as many as the largest group needs
        largest = dv.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        buckets = max(2, math.ceil(largest / BUCKET_VALUES))
    qs = [i / buckets for i in range(1, buckets)]
    bounds = dv.groupBy(*keys).agg(F.percentile_approx(value, qs, 10000).alias("_b"))
    v = F.col(value)
    b = dv.join(bounds, keys).select(*keys, value, "_c",
                                     F.size(F.filter("_b", lambda x: x < v)).alias("_bk"))
    per_bucket = b.groupBy(*keys, "_bk").agg(F.sum("_c").alias("_bc"))
    wk = Window.partitionBy(*keys).orderBy(F.col("_bk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*keys)
    offs = per_bucket.select(*keys, "_bk",
                             F.coalesce(F.sum("_bc").over(wk), F.lit(0)).alias("_above"),
                             F.sum("_bc").over(wt).alias("n_total"))
    wdesc = Window.partitionBy(*keys, "_bk").orderBy(v.desc()).rowsBetween(Window.unboundedPreceding, -1)
    wasc = Window.partitionBy(*keys, "_bk").orderBy(v.asc()).rowsBetween(Window.unboundedPreceding, 0)
    inb = b.select(*keys, value, "_bk",
                   F.coalesce(F.sum("_c").over(wdesc), F.lit(0)).alias("_gt_in"),
                   F.sum("_c").over(wasc).alias("_le_in"))
    j = inb.join(offs, keys + ["_bk"])
    return j.select(*keys, value, (F.col("_above") + F.col("_gt_in")).alias("n_gt"),
                    (F.col("n_total") - F.col("_above") - F.col("_gt_in")).alias("n_le"), "n_total")


def sector_metrics(companies: DataFrame) -> DataFrame:
    """Per (sector, size) and per sector (size 'TODOS'): revenue and margin
    quartiles, median growth and consistency, company count and healthy
    share; groups with fewer than 3 companies report the whole dataset."""
    has = set(companies.columns)
    mar = F.col("margem_media") if "margem_media" in has else F.lit(None).cast("double")
    gro = F.col("crescimento_medio") if "crescimento_medio" in has else F.lit(None).cast("double")
    con = F.col("consistencia_fluxo") if "consistencia_fluxo" in has else F.lit(None).cast("double")
    healthy = (F.avg(F.col("estagio").isin(C.HEALTHY_STAGES).cast("double")) if "estagio" in has
               else F.lit(0.5))
    metrics = {"rev": F.col("receita_media"), "mar": mar, "gro": gro, "con": con}
    # the three grouping sets: sector and size, sector, all
    nothing = F.lit(None).cast("string")
    sets = F.array(*[F.struct(F.lit(k).alias("_gid"), sector.alias("setor"), size.alias("porte")) for k, sector, size in (
        (0, F.col("setor"), F.col("porte")), (1, F.col("setor"), F.lit(C.ALL_SIZES)), (2, nothing, nothing))])
    values = F.array(*[F.struct(F.lit(m).alias("metric"), finite_or_null(c).cast("double").alias("value")) for m, c in metrics.items()])
    long = companies.select(F.explode(sets).alias("g"), values.alias("v")).select("g.*", F.explode("v").alias("m")).select(
        "_gid", "setor", "porte", "m.metric", "m.value")
    exact = exact_percentiles(long, ["_gid", "setor", "porte", "metric"], "value", [0.25, 0.5, 0.75])
    three = F.array("q0", "q1", "q2")
    exact = exact.groupBy("_gid", "setor", "porte").agg(
        F.max(F.when(F.col("metric") == "rev", three)).alias("_rev"), F.max(F.when(F.col("metric") == "mar", three)).alias("_mar"),
        F.max(F.when(F.col("metric") == "gro", F.col("q1"))).alias("crescimento_p50"),
        F.max(F.when(F.col("metric") == "con", F.col("q1"))).alias("fluxo_consistencia_p50"))
    totals = companies.withColumn("_g", F.explode(sets)).groupBy("_g").agg(
        F.count(F.lit(1)).alias("empresas_total"), healthy.alias("empresas_saudaveis_pct")).select("_g.*", "empresas_total", "empresas_saudaveis_pct")
    right = exact.withColumnsRenamed({"_gid": "_x", "setor": "_y", "porte": "_z"})
    g = totals.join(right, (F.col("_gid") == F.col("_x")) & F.col("setor").eqNullSafe(F.col("_y")) & F.col("porte").eqNullSafe(F.col("_z")),
                    "left").drop("_x", "_y", "_z")
    stat_cols = [c for c in g.columns if c not in ("setor", "porte", "_gid")]
    grow = g.filter("_gid = 2").first() or {c: None for c in stat_cols}  # whole-dataset fallback (one row)
    gstruct = {c: F.lit(grow[c]) for c in stat_cols}
    part = g.filter("_gid < 2")
    small = F.col("empresas_total") < 3

    def pick(c):
        return F.when(small, gstruct[c].cast(g.schema[c].dataType)).otherwise(F.col(c))
    rev, mr = pick("_rev"), pick("_mar")
    no_mar = "margem_media" not in has
    return part.select(
        "setor", "porte",
        rev[0].alias("receita_p25"), rev[1].alias("receita_p50"), rev[2].alias("receita_p75"),
        *[(F.lit(0.0) if no_mar else mr[i]).alias(n) for i, n in enumerate(["margem_p25", "margem_p50", "margem_p75"])],
        (F.lit(0.0) if "crescimento_medio" not in has else pick("crescimento_p50")).alias("crescimento_p50"),
        (F.lit(0.0) if "consistencia_fluxo" not in has else pick("fluxo_consistencia_p50")).alias("fluxo_consistencia_p50"),
        pick("empresas_total").cast("long").alias("empresas_total"),
        pick("empresas_saudaveis_pct").alias("empresas_saudaveis_pct"))


def peer_ranking(companies: DataFrame, metrics: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Long table (ID, metric): rank among peers (1 + #strictly greater),
    percentile trunc(100 * share of peer values <= own), quartile label,
    total non-null peer values and the peer-group size.  Peers are the same
    sector and size, or the whole sector when that group has < 5 members.
    NULL own value -> rank 1, percentile 0; no non-null peer value -> rank 1,
    total 1, percentile 50, no quartile."""
    metrics = [m for m in (metrics or C.PEER_METRICS) if m in companies.columns]
    size_n = companies.groupBy("setor", "porte").agg(F.count(F.lit(1)).alias("_n_sp"))
    sec_n = companies.groupBy("setor").agg(F.count(F.lit(1)).alias("_n_s"))
    base = (companies.join(size_n, ["setor", "porte"]).join(sec_n, "setor")
            .withColumn("_wide", F.col("_n_sp") < 5))
    long = base.select("ID", "setor", "porte", "_wide", "_n_sp", "_n_s", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), finite_or_null(F.col(m).cast("double")).alias("value")) for m in metrics
    ])).alias("m")).select("ID", "setor", "porte", "_wide", "_n_sp", "_n_s", "m.metric", "m.value")
    long = long.withColumn("_grp", F.when(F.col("_wide"), F.lit(C.ALL_SIZES)).otherwise(F.col("porte")))
    # group key: (metric, setor, grp) where grp = porte or 'TODOS' for the sector-wide group
    narrow = long.filter(~F.col("_wide"))
    wide_src = long.select("metric", "setor", F.lit(C.ALL_SIZES).alias("_grp"), "value")
    rc_narrow = rank_counts(narrow.select("metric", "setor", "_grp", "value"), ["metric", "setor", "_grp"], "value", buckets)
    rc_wide = rank_counts(wide_src, ["metric", "setor", "_grp"], "value", buckets)
    counts = rc_narrow.unionByName(rc_wide)
    totals = (narrow.select("metric", "setor", "_grp", "value").unionByName(wide_src)
              .groupBy("metric", "setor", "_grp").agg(F.count("value").alias("_tot")))
    j = (long.join(totals, ["metric", "setor", "_grp"], "left")
         .join(counts.drop("n_total"), ["metric", "setor", "_grp", "value"], "left"))
    tot = F.coalesce(F.col("_tot"), F.lit(0))
    none = tot == 0
    rank = F.when(none | F.col("value").isNull(), F.lit(1)).otherwise(F.col("n_gt") + 1)
    pct = (F.when(none, F.lit(50)).when(F.col("value").isNull(), F.lit(0))
           .otherwise(F.floor(F.col("n_le").cast("double") / tot.cast("double") * 100)))
    quart = F.when(none, F.lit(None).cast("string")).otherwise(banded_ge(pct, C.QUARTILES, C.QUARTILE_LAST))
    return j.select("ID", "setor", "porte", "metric", "value",
                    rank.cast("long").alias("rank"),
                    F.when(none, F.lit(1)).otherwise(tot).cast("long").alias("total"),
                    pct.cast("long").alias("percentile"), quart.alias("quartile"),
                    F.when(F.col("_wide"), F.col("_n_s")).otherwise(F.col("_n_sp")).cast("long").alias("peer_count"))


def competitive_score(ranking: DataFrame) -> DataFrame:
    """Mean of the available percentiles (50 if none) and the market
    position band (80/60/40/20)."""
    s = ranking.groupBy("ID").agg(F.avg("percentile").alias("_s"), F.max("peer_count").alias("peer_count"))
    score = F.coalesce(F.col("_s"), F.lit(50.0))
    return s.select("ID", score.alias("competitive_score"),
                    banded_ge(score, C.MARKET_POSITIONS, C.MARKET_POSITION_LAST).alias("market_position"),
                    "peer_count")


def swot(companies: DataFrame, ranking: DataFrame, metrics: DataFrame) -> DataFrame:
    """Rule-based SWOT code lists per company.  A metric missing from the
    ranking counts as percentile 0 for the thresholds (so low growth fires
    when growth is absent)."""
    p = ranking.groupBy("ID").pivot("metric", C.PEER_METRICS).agg(F.first("percentile"))
    p = p.select("ID", *[F.col(m).alias(f"_pct_{m}") for m in C.PEER_METRICS])
    j = (companies.join(p, "ID", "left")
         .join(metrics.select("setor", "porte", "empresas_saudaveis_pct"), ["setor", "porte"], "left")
         .join(ranking.groupBy("ID").agg(F.max("peer_count").alias("peer_count")), "ID", "left"))

    def pc(m):
        return F.coalesce(F.col(f"_pct_{m}").cast("double"), F.lit(0.0))
    cons = F.col("consistencia_fluxo") if "consistencia_fluxo" in companies.columns else F.lit(0.0)
    flow = F.col("fluxo_medio") if "fluxo_medio" in companies.columns else F.lit(0.0)
    hs = F.col("empresas_saudaveis_pct")
    return j.select(
        "ID",
        compact_array((pc("receita_media") > 70, "revenue_above_p70"),
                      (pc("margem_media") > 70, "margin_above_most_peers"),
                      (cons > 0.8, "predictable_cash_flow")).alias("strengths"),
        compact_array((pc("crescimento_medio") < 30, "growth_below_sector"),
                      (flow < 0, "negative_cash_flow")).alias("weaknesses"),
        compact_array((hs > 0.6, "expanding_sector"),
                      (F.col("porte").isin("MICRO", "PEQUENA"), "room_to_grow_in_size")).alias("opportunities"),
        compact_array((hs < 0.3, "sector_in_difficulty"),
                      (F.col("peer_count") > 100, "high_competition")).alias("threats"))


def competitive_analysis(companies: DataFrame, buckets: int = 32, ranking: DataFrame | None = None,
                         metrics: DataFrame | None = None) -> DataFrame:
    """One row per company: sector, size, group metrics, competitive score,
    market position and SWOT lists."""
    rk = peer_ranking(companies, buckets=buckets) if ranking is None else ranking
    met = sector_metrics(companies) if metrics is None else metrics
    sc = competitive_score(rk)
    sw = swot(companies, rk, met)
    return (companies.select("ID", "setor", "porte")
            .join(met.select("setor", "porte", "receita_p50", "margem_p50", "empresas_total",
                             "empresas_saudaveis_pct"), ["setor", "porte"], "left")
            .join(sc, "ID", "left").join(sw, "ID", "left"))


def sector_evolution(history: DataFrame) -> DataFrame:
    """Per (sector, month): mean revenue, margin and consistency and the
    number of companies; with more than one month in the sector, the
    revenue pct-change and margin difference vs the previous month row."""
    g = history.groupBy("setor", "year_month").agg(
        F.avg("receita_media").alias("receita_media"), F.avg("margem_media").alias("margem_media"),
        F.avg("consistencia_fluxo").alias("consistencia_fluxo"), F.count("ID").alias("empresas_ativas"))
    w = Window.partitionBy("setor").orderBy("year_month")
    n = F.count(F.lit(1)).over(Window.partitionBy("setor"))
    prev_r = F.lag("receita_media").over(w)
    from ..functions.columns import pct_change
    return g.select("setor", "year_month", "receita_media", "margem_media", "consistencia_fluxo",
                    "empresas_ativas",
                    F.when(n > 1, pct_change(F.col("receita_media"), prev_r)).alias("receita_trend"),
                    F.when(n > 1, F.col("margem_media") - F.lag("margem_media").over(w)).alias("margem_trend"))


def sector_history(f: DataFrame) -> DataFrame:
    """Company-month metrics for the sector evolution: revenue, margin
    (flow/revenue, 0 when revenue is ~0) and positive-flow indicator."""
    from ..functions.columns import sector_of
    r, fl = F.col("receita_mensal"), F.col("fluxo_liquido")
    return f.select("ID", "year_month", sector_of("DS_CNAE").alias("setor"), r.alias("receita_media"),
                    F.when(F.abs(r) > 1e-9, fl / r).otherwise(F.lit(0.0)).alias("margem_media"),
                    (fl > 0).cast("double").alias("consistencia_fluxo"))
