import itertools
import random

import pytest
from pyspark.sql import functions as F

from flowlens.operators import graph as GR
from flowlens.operators import pagerank as PR
from flowlens.operators import relations as RL
from flowlens.operators import risk as RK
from flowlens.plans import catalog
from flowlens.plans.context import by_month, context
from tests.helpers import edges, m

SF2 = "/root/testdata/sf0.01"


def brute_resilience(pairs):
    one = {(a, b) for a, b in pairs if a is not None and b is not None and a != b}
    near = {}
    for a, b in one:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    n = len(near)
    seen, todo = set(), [next(iter(near))]
    while todo:
        x = todo.pop()
        if x not in seen:
            seen.add(x)
            todo += near[x]
    linked = 1.0 if len(seen) == n else 0.0
    out = {}
    for v in near:
        paths = sum((v, w) in one for w in near) + sum((v, x) in one and (x, w) in one for x in near for w in near if w != v and x != w)
        cent = sum(v in e for e in one) / (n - 1)
        d = len(near[v])
        clus = sum(b in near[a] for a, b in itertools.combinations(near[v], 2)) / (d * (d - 1) / 2) if d > 1 else 0.0
        red = min(1.0, paths / (n - 1))
        out[v] = (0.3 * linked + 0.3 * red + 0.2 * (1 - cent) + 0.2 * clus, red, linked, clus, cent)
    return out


@pytest.mark.parametrize("list_nodes", [5_000, 3])
@pytest.mark.parametrize("parts", [1, 2])
def test_graph_resilience_equals_brute_force(spark, monkeypatch, list_nodes, parts):
    monkeypatch.setattr(GR, "LIST_NODES", list_nodes)
    rng = random.Random(parts)
    names = [f"N{i:02d}" for i in range(24)]
    pairs = [tuple(rng.choices(names, k=2)) for _ in range(70)] + [("HUB", x) for x in names] + [(x, "HUB") for x in names[:9]]
    pairs += pairs[:10] + [(None, "N01"), ("N01", None), ("N03", "N03")]
    if parts == 2:
        pairs += [("X", "Y"), ("Y", "X"), ("Y", "Z")]
    got = {r[0]: tuple(r)[1:] for r in GR.graph_resilience(spark.createDataFrame(pairs, "src string, dst string").repartition(5)).collect()}
    want = brute_resilience(pairs)
    assert set(got) == set(want)
    for v, x in want.items():
        assert got[v] == pytest.approx(x, abs=1e-12), v


def test_resilience_of_no_edges(spark):
    assert GR.graph_resilience(spark.createDataFrame([("A", "A")], "src string, dst string")).count() == 0


def test_companies_leave_the_rank_join_after_different_blocks(spark):
    ctx = context(spark, SF2)
    got = RK.diversification_targets(RL.month_window(ctx.edges, 2), 5, top_m=6, fanout=1, with_block=True)
    blocks = {r["block"]: r["n"] for r in got.groupBy("block").agg(F.count_distinct("company_id").alias("n")).collect()}
    assert {1, 2, 3} <= set(blocks), blocks


def test_a_complete_graph_reads_no_block(spark):
    rows = [(a, b, m(2020, 1), 1.0) for a, b in itertools.combinations("ABCDEFG", 2)]
    assert RK.diversification_targets(edges(spark, rows), 5).count() == 0


def test_month_windows_read_their_months_only(spark):
    rows = [(f"A{i}", f"B{i}", m(2020, 1 + i % 12), float(i)) for i in range(60)]
    df = by_month(edges(spark, rows))
    win = RL.month_window(df, 2)
    plan = win._jdf.queryExecution().executedPlan().toString()
    # the subquery for the last month reads no column; the scan of the data is pruned by it
    scans = [line.split("PartitionFilters: [")[1] for line in plan.splitlines() if "PartitionFilters" in line and "struct<>" not in line]
    assert len(scans) == 1 and "year_month" in scans[0].split("]")[0] and "subquery" in scans[0].lower(), plan
    assert {r["year_month"] for r in win.collect()} == {m(2020, 11), m(2020, 12)}
    at = RL.month_window(df, 3, "2020-05-01")
    assert {r["year_month"] for r in at.collect()} == {m(2020, 3), m(2020, 4), m(2020, 5)}
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, edges(spark, rows).collect()))


def test_an_iteration_of_pagerank_has_one_exchange(spark):
    rows = [(f"A{i % 9}", f"B{i % 7}", float(i)) for i in range(60)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = []
    trans = PR.transitions(spark.createDataFrame(rows, "src string, dst string, weight double"), parts, names)
    ranks = trans.select(F.col("src").alias("node_id")).union(trans.select("dst")).distinct().select(
        "node_id", F.lit(False).alias("dangling"), F.lit(0.0).alias("change"), F.lit(0.1).alias("r"))
    ranks = PR.bucketed(ranks.repartition(parts, "node_id"), "node_id", parts, names)
    for _ in range(2):
        df = PR.step(trans, ranks, 0.1, 0.85)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "Exchange hashpartitioning(dst" in plan, plan
        ranks = PR.bucketed(df, "node_id", parts, names)
    assert ranks.count() == 16
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_registered_queries_of_earlier_months_are_not_empty(spark):
    for name in ("relation_importance_at", "ego_network_at", "diversification_targets_recent", "network_resilience_graph", "pagerank_steps"):
        assert catalog.QUERIES[name](spark, SF2).count() > 0, name
