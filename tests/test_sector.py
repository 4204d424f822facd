import random

from flowlens.operators import sector as SC


def _companies(spark, rows):
    return spark.createDataFrame(rows, "ID string, setor string, porte string, receita_media double, "
                                       "margem_media double, crescimento_medio double, consistencia_fluxo double, "
                                       "fluxo_medio double, estagio string")


def test_peer_fallback_ties_and_nulls(spark):
    rows = []
    # sector S1: size A has 2 companies (<5 -> whole sector), size B has 5
    rows += [(f"a{i}", "S1", "A", float(v), None, 0.1, 0.5, 1.0, "Maturidade") for i, v in enumerate([10, 20])]
    rows += [(f"b{i}", "S1", "B", float(v), 1.0, 0.1, 0.5, 1.0, "Declínio") for i, v in enumerate([5, 20, 20, 30, 40])]
    rows += [("n0", "S2", "A", None, None, None, None, None, None)]
    rk = {(r.ID, r.metric): r for r in SC.peer_ranking(_companies(spark, rows), buckets=2).collect()}
    # a1 = 20 among the whole sector [10,20,5,20,20,30,40]: 2 greater -> rank 3; <= : 5/7
    r = rk[("a1", "receita_media")]
    assert (r.rank, r.total, r.percentile, r.peer_count) == (3, 7, int(5 / 7 * 100), 7)
    # b1 = 20 within size B [5,20,20,30,40]: rank 3, <= 3/5
    r = rk[("b1", "receita_media")]
    assert (r.rank, r.percentile, r.peer_count) == (3, 60, 5)
    # null own value -> rank 1, percentile 0
    r = rk[("a0", "margem_media")]
    assert (r.rank, r.percentile) == (1, 0)
    # all-null metric in the group -> rank 1, total 1, percentile 50, no quartile
    r = rk[("n0", "receita_media")]
    assert (r.rank, r.total, r.percentile, r.quartile) == (1, 1, 50, None)


def test_percentile_trunc(spark):
    rows = [(f"c{i}", "S", "A", float(i), 0.0, 0.0, 0.0, 0.0, "Maturidade") for i in range(100)]
    rk = {(r.ID, r.metric): r for r in SC.peer_ranking(_companies(spark, rows)).collect()}
    assert rk[("c28", "receita_media")].percentile == 28  # trunc(0.29 * 100) in double


def test_rank_counts_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["g1", "g2"]),
             float(rnd.choice([1, 2, 2, 3, 5, 8, 8, 8, 13])) if rnd.random() > .1 else None)
            for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.v): (r.n_gt, r.n_le, r.n_total) for r in SC.rank_counts(df, ["g"], "v", buckets=3).collect()}
    for (g, v), res in got.items():
        vals = [x for gg, x in rows if gg == g and x is not None]
        assert res == (sum(x > v for x in vals), sum(x <= v for x in vals), len(vals))


def test_sector_metrics_small_group_falls_back(spark):
    rows = [(f"x{i}", "S", "A", float(i), 0.0, 0.0, 0.0, 0.0, "Maturidade") for i in range(2)]
    rows += [(f"y{i}", "T", "B", float(10 + i), 0.0, 0.0, 0.0, 0.0, "Declínio") for i in range(4)]
    met = {(r.setor, r.porte): r for r in SC.sector_metrics(_companies(spark, rows)).collect()}
    assert met[("S", "A")].empresas_total == 6 and met[("T", "B")].empresas_total == 4
    assert met[("T", "TODOS")].empresas_saudaveis_pct == 0.0
