"""Resilience of every node of a general payment graph.

* Paths of at most two edges are counted, not listed: a node's two-edge paths
  are the out-degrees of its receivers, less the ways straight back.
* Triangles are found on edges directed from the end of lower degree to that
  of higher degree.  A list then holds at most sqrt(2 * edges) neighbours, hubs
  included, and is cut into blocks of ``LIST_NODES`` by a hash of the neighbour,
  so that the two lists of an edge meet block by block.
* Connectivity is 1 where the graph is connected (2 nodes or more), else 0: a
  star's value, and the least that node connectivity of a connected graph can
  be.  Labels spread in as many rounds as the graph is wide.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Neighbours in a block of a list, about.
LIST_NODES = 5_000


def undirected(edges: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), both ways, without loops."""
    one = edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def triangles(adj: DataFrame) -> DataFrame:
    """(node, triangles) of the nodes of ``undirected`` pairs that are in any."""
    checkpoint_dir(adj.sparkSession)
    degree = adj.groupBy("a").agg(F.count(F.lit(1)).alias("d"))
    ends = adj.filter("a < b").join(degree.withColumnRenamed("d", "da"), "a").join(degree.select(F.col("a").alias("b"), F.col("d").alias("db")), "b")
    up = F.struct("da", "a") < F.struct("db", "b")
    directed = ends.select(F.when(up, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("v")).checkpoint()
    longest = directed.groupBy("u").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    blocks = max(1, math.ceil(longest / LIST_NODES))
    lists = directed.groupBy("u", F.pmod(F.xxhash64("v"), F.lit(blocks)).alias("block")).agg(F.collect_list("v").alias("list"))
    # an edge needs a block of both lists: one without neighbours in it closes no triangle there
    common = (directed.join(lists, "u").select("u", "v", "block", F.col("list").alias("mine"))
              .join(lists.select(F.col("u").alias("v"), "block", "list"), ["v", "block"])
              .select("u", "v", F.array_intersect("mine", "list").alias("w")).filter(F.size("w") > 0))
    found = common.select(F.explode(F.concat(
        F.array(F.struct(F.col("u").alias("node"), F.size("w").cast("long").alias("n")), F.struct(F.col("v").alias("node"), F.size("w").cast("long").alias("n"))),
        F.transform("w", lambda w: F.struct(w.alias("node"), F.lit(1).cast("long").alias("n"))))).alias("t")).select("t.*")
    return found.groupBy("node").agg(F.sum("n").alias("triangles"))


def connected(adj: DataFrame) -> bool:
    """Whether the graph of ``undirected`` pairs is one component."""
    checkpoint_dir(adj.sparkSession)
    label = adj.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")).checkpoint()
    while True:
        near = adj.join(label.select(F.col("a").alias("b"), F.col("l").alias("lb")), "b").groupBy("a").agg(F.min("lb").alias("lb"))
        after = label.join(near, "a").select("a", "l", F.least("l", "lb").alias("m")).checkpoint()
        counts = after.agg(F.count_if(F.col("m") < F.col("l")).alias("moved"), F.count_distinct("m").alias("parts")).first()
        if not counts["moved"]:
            return counts["parts"] == 1
        label = after.select("a", F.col("m").alias("l"))


def graph_resilience(edges: DataFrame) -> DataFrame:
    """node, resilience_score, redundancy, connectivity, clustering,
    degree_centrality of every node of (src, dst) rows; repeated rows are one
    edge, loops and rows without an end are left out, an empty table gives no row.

    redundancy = min(1, simple directed paths of at most 2 edges / (n - 1));
    degree centrality = (in + out) / (n - 1); clustering of the undirected
    graph; score = .3 connectivity + .3 redundancy + .2 (1 - centrality) + .2 clustering.
    """
    checkpoint_dir(edges.sparkSession)
    one = edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct().checkpoint()
    adj = undirected(one).checkpoint()
    legs = one.select(F.explode(F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")),
                                        F.struct(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("l")).select("l.*")
    nodes = legs.groupBy("node").agg(F.sum("o").alias("out"), F.sum("i").alias("in")).checkpoint()
    n = nodes.count()
    if n == 0:
        return edges.sparkSession.createDataFrame([], "node string, resilience_score double, redundancy double, connectivity double, "
                                                      "clustering double, degree_centrality double")
    linked = 1.0 if connected(adj) else 0.0
    # v -> m -> w: out(m) ways on, but not back to v
    on = one.join(nodes.select(F.col("node").alias("dst"), F.col("out").alias("next")), "dst").groupBy(F.col("src").alias("node")).agg(F.sum("next").alias("two"))
    back = one.join(one.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_semi").groupBy(F.col("src").alias("node")).agg(
        F.count(F.lit(1)).alias("back"))
    degree = adj.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("d"))
    g = nodes.join(on, "node", "left").join(back, "node", "left").join(degree, "node").join(triangles(adj), "node", "left")
    paths = F.col("out") + F.coalesce("two", F.lit(0)) - F.coalesce("back", F.lit(0))
    redundancy = F.least(F.lit(1.0), paths.cast("double") / F.lit(float(n - 1)))
    centrality = (F.col("in") + F.col("out")).cast("double") / F.lit(float(n - 1))
    pairs = F.col("d") * (F.col("d") - 1)
    clustering = F.when(pairs > 0, 2.0 * F.coalesce("triangles", F.lit(0)).cast("double") / pairs.cast("double")).otherwise(0.0)
    score = F.lit(0.3) * F.lit(linked) + F.lit(0.3) * redundancy + F.lit(0.2) * (F.lit(1.0) - centrality) + F.lit(0.2) * clustering
    return g.select("node", score.alias("resilience_score"), redundancy.alias("redundancy"), F.lit(linked).alias("connectivity"),
                    clustering.alias("clustering"), centrality.alias("degree_centrality"))
