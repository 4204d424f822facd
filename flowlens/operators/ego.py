"""Ego-network node metrics, summaries and display attributes.

Every ego network is a star (each edge touches the ego), so betweenness,
connectivity, redundancy and clustering have closed forms computed with
plain aggregates -- no per-company graph library and no sampling.
Groups are bounded by ``top_n`` edges per ego.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _node_legs(ego_edges: DataFrame) -> DataFrame:
    return ego_edges.select("ego", F.explode(F.array(
        F.struct(F.col("src").alias("node_id"), F.lit(0.0).alias("in_w"), F.col("weight").alias("out_w"),
                 (F.col("dst") == F.col("ego")).alias("pays_ego"), F.lit(False).alias("paid_by_ego")),
        F.struct(F.col("dst").alias("node_id"), F.col("weight").alias("in_w"), F.lit(0.0).alias("out_w"),
                 F.lit(False).alias("pays_ego"), (F.col("src") == F.col("ego")).alias("paid_by_ego")),
    )).alias("l")).select("ego", "l.*")


def ego_nodes(ego_edges: DataFrame) -> DataFrame:
    """Per ego and node: weighted in/out degree, strength, role, PageRank
    (uniform 1/N: the analysed system's solver is unavailable, so its
    fallback is the effective behaviour) and exact betweenness.

    Star closed form: betweenness(ego) = (P*R - B) / ((n-1)(n-2)) with P
    payers, R receivers, B nodes that are both; 0 for other nodes; 0 if n<=2.
    """
    nodes = _node_legs(ego_edges).groupBy("ego", "node_id").agg(
        F.sum("in_w").alias("in_w"), F.sum("out_w").alias("out_w"),
        F.max(F.col("pays_ego").cast("int")).alias("_p"), F.max(F.col("paid_by_ego").cast("int")).alias("_r"))
    per_ego = Window.partitionBy("ego")
    n = F.count(F.lit(1)).over(per_ego)
    is_ego = F.col("node_id") == F.col("ego")
    P = F.sum(F.when(~is_ego, F.col("_p")).otherwise(0)).over(per_ego)
    R = F.sum(F.when(~is_ego, F.col("_r")).otherwise(0)).over(per_ego)
    B = F.sum(F.when(~is_ego, F.col("_p") * F.col("_r")).otherwise(0)).over(per_ego)
    btw = F.when(is_ego & (n > 2), (P * R - B).cast("double") / ((n - 1) * (n - 2)).cast("double")).otherwise(F.lit(0.0))
    role = (F.when(is_ego, F.lit("ego")).when(F.col("_p") == 1, F.lit("payer_to_ego"))
            .when(F.col("_r") == 1, F.lit("receiver_from_ego")).otherwise(F.lit("neighbor")))
    return nodes.select(
        "ego", "node_id", role.alias("role"), "in_w", "out_w",
        (F.col("in_w") + F.col("out_w")).alias("strength"),
        (F.lit(1.0) / n.cast("double")).alias("pagerank"),
        btw.alias("betweenness"))


def ego_summary(ego_edges: DataFrame, companies: DataFrame) -> DataFrame:
    """n nodes, n edges and density m/(n(n-1)) (denominator 1 when n<=1)
    for every company; a company without edges gets 0, 0, 0."""
    legs = ego_edges.select("ego", F.explode(F.array("src", "dst")).alias("node"))
    nn = legs.groupBy("ego").agg(F.countDistinct("node").alias("n_nodes"))
    ne = ego_edges.groupBy("ego").agg(F.count(F.lit(1)).alias("n_edges"))
    ids = companies.select(F.col("ID").alias("ego")).distinct()
    j = ids.join(nn, "ego", "left").join(ne, "ego", "left")
    n = F.coalesce(F.col("n_nodes"), F.lit(0))
    m = F.coalesce(F.col("n_edges"), F.lit(0))
    possible = F.when(n > 1, n * (n - 1)).otherwise(F.lit(1))
    return j.select("ego", n.cast("long").alias("n_nodes"), m.cast("long").alias("n_edges"),
                    (m.cast("double") / possible.cast("double")).alias("density"))


def _scale(v, lo_v, hi_v, lo, hi, flat):
    return F.when(hi_v <= lo_v, F.lit(flat)).otherwise(
        F.lit(lo) + (v - lo_v) / (hi_v - lo_v) * F.lit(hi - lo))


def network_scaled(ego_edges: DataFrame, nodes: DataFrame, node_range=(30.0, 80.0),
                   edge_range=(2.0, 8.0), flat_node=None, flat_edge=4.0) -> DataFrame:
    """Display attributes as one long table: node size = min-max scaled
    strength, edge width = min-max scaled weight (per ego), edge flow
    direction and the most important (heaviest, first) edge."""
    flat_node = (node_range[0] + node_range[1]) / 2 if flat_node is None else flat_node
    pe = Window.partitionBy("ego")
    nd = nodes.select(
        "ego", F.lit("node").alias("element"), "node_id", F.lit(None).cast("string").alias("src"),
        F.lit(None).cast("string").alias("dst"), F.col("strength").alias("value"),
        _scale(F.col("strength"), F.min("strength").over(pe), F.max("strength").over(pe),
               node_range[0], node_range[1], flat_node).alias("scaled"),
        F.col("role").alias("kind"), F.lit(False).alias("most_important"))
    first = Window.partitionBy("ego").orderBy(F.col("weight").desc(), "src", "dst")
    ed = ego_edges.select(
        "ego", F.lit("edge").alias("element"), F.lit(None).cast("string").alias("node_id"), "src", "dst",
        F.col("weight").alias("value"),
        _scale(F.col("weight"), F.min("weight").over(pe), F.max("weight").over(pe),
               edge_range[0], edge_range[1], flat_edge).alias("scaled"),
        F.when(F.col("src") == F.col("ego"), F.lit("out")).otherwise(F.lit("in")).alias("kind"),
        (F.row_number().over(first) == 1).alias("most_important"))
    return nd.unionByName(ed)


def critical_relationship(ego_edges: DataFrame) -> DataFrame:
    """Heaviest edge per ego: whether the ego pays or receives, the partner
    and the value."""
    w = Window.partitionBy("ego").orderBy(F.col("weight").desc(), "src", "dst")
    top = ego_edges.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
    pays = F.col("src") == F.col("ego")
    return top.select("ego", F.when(pays, F.lit("pays")).otherwise(F.lit("receives")).alias("direction"),
                      F.when(pays, F.col("dst")).otherwise(F.col("src")).alias("partner"),
                      F.col("weight").alias("valor"))


def relationships_table(ego_edges: DataFrame, rows: int = 15) -> DataFrame:
    """The heaviest ``rows`` edges per ego with partner, direction and a
    high-risk flag (weight above the 80th percentile of the ego's edges)."""
    pe = Window.partitionBy("ego")
    w = Window.partitionBy("ego").orderBy(F.col("weight").desc(), "src", "dst")
    t = (ego_edges.withColumn("_p80", F.percentile(F.col("weight"), F.lit(0.8)).over(pe))
         .withColumn("position", F.row_number().over(w).cast("long"))
         .filter(F.col("position") <= rows))
    pays = F.col("src") == F.col("ego")
    return t.select("ego", "position",
                    F.when(pays, F.lit("out")).otherwise(F.lit("in")).alias("direction"),
                    F.when(pays, F.col("dst")).otherwise(F.col("src")).alias("partner"),
                    "weight", (F.col("weight") > F.col("_p80")).alias("high_risk"))


def network_resilience(ego_edges: DataFrame, companies: DataFrame) -> DataFrame:
    """Resilience of each company's ego network (closed forms on a star; P and
    R count payers and receivers by edges, whatever their weight):
    connectivity 1 (n>=2), redundancy min(1, R/(n-1)), degree centrality
    (P+R)/(n-1) (1 when n<=1), clustering 0;
    score = .3*connectivity + .3*redundancy + .2*(1-centrality) + .2*clustering.
    Companies without a network get zeros."""
    nodes = _node_legs(ego_edges).groupBy("ego", "node_id").agg(
        F.max("pays_ego").alias("payer"), F.max("paid_by_ego").alias("receiver"))
    other = F.col("node_id") != F.col("ego")
    g = nodes.groupBy("ego").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(other & F.col("receiver")).alias("R"),
        F.count_if(other & F.col("payer")).alias("P"))
    n = F.col("n")
    conn = F.when(n >= 2, F.lit(1.0)).otherwise(F.lit(0.0))
    red = F.when(n > 1, F.least(F.lit(1.0), F.col("R").cast("double") / (n - 1).cast("double"))).otherwise(F.lit(0.0))
    cent = F.when(n > 1, (F.col("P") + F.col("R")).cast("double") / (n - 1).cast("double")).otherwise(F.lit(1.0))
    clus = F.lit(0.0)
    score = F.lit(0.3) * conn + F.lit(0.3) * red + F.lit(0.2) * (F.lit(1.0) - cent) + F.lit(0.2) * clus
    res = g.select("ego", score.alias("resilience_score"), red.alias("redundancy"),
                   conn.alias("connectivity"), clus.alias("clustering"), cent.alias("degree_centrality"))
    ids = companies.select(F.col("ID").alias("ego")).distinct()
    return ids.join(res, "ego", "left").select(
        "ego", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in
                 ["resilience_score", "redundancy", "connectivity", "clustering", "degree_centrality"]])
