"""Weighted PageRank over any edge table (src, dst, weight), iterated as
join + aggregate on Spark.

Semantics follow the usual power iteration: out-weight-normalised
transitions, damping ``alpha``, teleport and dangling-node mass spread
uniformly, convergence when Σ|Δ| < N * tol.  Transitions are a table bucketed
by source, each iteration's ranks one bucketed by node into as many buckets: a
join reads both as they lie, and an iteration exchanges the contributions only
(combined by receiver before the exchange).  The tables lie in the session's
checkpoint folder, so the plan does not grow (a step reads the ranks twice) and
a lost executor costs one iteration; the change and the next dangling mass are
one aggregate over them.  The ego-network operator keeps the analysed system's
effective uniform 1/N; this operator is the optional real ranking.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bucketed, checkpoint_dir


def transitions(edges: DataFrame, parts: int, names: list[str]) -> DataFrame:
    """src, dst, p of positive weights, bucketed by src."""
    e = edges.groupBy("src", "dst").agg(F.sum("weight").alias("w")).filter(F.col("w") > 0)
    out_w = e.groupBy("src").agg(F.sum("w").alias("_out"))
    return bucketed(e.join(out_w, "src").select("src", "dst", (F.col("w") / F.col("_out")).alias("p")).repartition(parts, "src"), "src", parts, names)


def step(trans: DataFrame, ranks: DataFrame, base: float, alpha: float) -> DataFrame:
    """node_id, dangling, change, r after a step; ``ranks`` lies by node_id as ``trans`` by src."""
    contrib = (trans.join(ranks.select(F.col("node_id").alias("src"), "r").hint("merge"), "src")
               .groupBy(F.col("dst").alias("node_id")).agg(F.sum(F.col("p") * F.col("r")).alias("c")))
    new = F.lit(base) + F.lit(alpha) * F.coalesce(F.col("c"), F.lit(0.0))
    return ranks.join(contrib.hint("merge"), "node_id", "left").select(
        "node_id", "dangling", F.abs(new - F.col("r")).alias("change"), new.alias("r"))


def pagerank(edges: DataFrame, alpha: float = 0.85, max_iter: int = 100, tol: float = 1e-6) -> DataFrame:
    """Ranks (node_id, pagerank) for every node of the weighted graph."""
    spark = edges.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names: list[str] = []
    try:
        trans = transitions(edges, parts, names)
        sources = trans.select(F.col("src").alias("node_id")).distinct().withColumn("_out", F.lit(True))
        nodes = (trans.select(F.col("dst").alias("node_id")).distinct().join(sources, "node_id", "full")
                 .select("node_id", F.col("_out").isNull().alias("dangling")).checkpoint())
        n, dangling_nodes = nodes.agg(F.count(F.lit(1)), F.count_if("dangling")).first()
        if n == 0:
            return spark.createDataFrame([], "node_id string, pagerank double")
        start = nodes.select("node_id", "dangling", F.lit(0.0).alias("change"), F.lit(1.0 / n).alias("r"))
        ranks = bucketed(start.repartition(parts, "node_id"), "node_id", parts, names)
        dangling = dangling_nodes / n
        for _ in range(max_iter):
            ranks = bucketed(step(trans, ranks, (1.0 - alpha) / n + alpha * dangling / n, alpha), "node_id", parts, names)
            change, dangling = ranks.agg(F.sum("change"), F.coalesce(F.sum(F.when(F.col("dangling"), F.col("r"))), F.lit(0.0))).first()
            if change < n * tol:
                break
        return ranks.select("node_id", F.col("r").alias("pagerank")).checkpoint()
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
