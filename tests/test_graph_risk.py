import itertools
import random

import pytest

from flowlens.operators import ego as EG
from flowlens.operators import relations as RL
from flowlens.operators import risk as RK
from helpers import edges, m, profile


def _ego(spark, rows, direction="both", top_n=25):
    e = edges(spark, rows)
    return RL.ego_edges(e, m(2020, 1), 1, direction, top_n, None)


def test_star_ego_betweenness_density_roles(spark):
    # ego E: payers P1, P2, X (both); receivers R1, R2, X -> P=3, R=3, B=1, n=6
    rows = [("P1", "E", m(2020, 1), 5), ("P2", "E", m(2020, 1), 4), ("X", "E", m(2020, 1), 3),
            ("E", "R1", m(2020, 1), 2), ("E", "R2", m(2020, 1), 1), ("E", "X", m(2020, 1), 6)]
    ee = _ego(spark, rows).filter("ego = 'E'")
    nodes = {r.node_id: r for r in EG.ego_nodes(ee).filter("ego = 'E'").collect()}
    n = 6
    assert abs(nodes["E"].betweenness - (3 * 3 - 1) / ((n - 1) * (n - 2))) < 1e-12
    assert nodes["X"].role == "payer_to_ego" and nodes["R1"].role == "receiver_from_ego"
    assert all(nodes[k].betweenness == 0.0 for k in nodes if k != "E")
    assert abs(nodes["E"].pagerank - 1 / 6) < 1e-12
    comp = profile(spark, [("E", m(2020, 1), 1.0, 1.0, None, "x")])
    s = EG.ego_summary(ee, comp).collect()[0]
    assert (s.n_nodes, s.n_edges) == (6, 6) and abs(s.density - 6 / 30) < 1e-12


def test_two_nodes(spark):
    ee = _ego(spark, [("A", "B", m(2020, 1), 1)]).filter("ego = 'A'")
    nodes = {r.node_id: r for r in EG.ego_nodes(ee).collect()}
    assert nodes["A"].betweenness == 0.0
    comp = profile(spark, [("A", m(2020, 1), 1.0, 1.0, None, "x")])
    assert EG.ego_summary(ee, comp).collect()[0].density == 0.5


def test_top_n_and_ties(spark):
    rows = [("A", d, m(2020, 1), 1.0) for d in ["C", "B", "D"]]
    ee = _ego(spark, rows, "out", 2).filter("ego = 'A'").orderBy("edge_rank").collect()
    assert [r.dst for r in ee] == ["B", "C"]


def _conc(spark, shares):
    rows = [(f"P{i}", "C", m(2020, 1), s * 100) for i, s in enumerate(shares)]
    pairs = RK.pair_volumes(edges(spark, rows))
    comp = profile(spark, [("C", m(2020, 1), 1.0, 1.0, None, "x"), ("Z", m(2020, 1), 1.0, 1.0, None, "x")])
    return {(r.company_id, r.direction): r for r in RK.concentration_metrics(pairs, comp).collect()}


def test_concentration_levels(spark):
    assert _conc(spark, [.51, .49])[("C", "in")].concentration_risk == "CRÍTICO"
    assert _conc(spark, [.5, .31, .19])[("C", "in")].concentration_risk == "ALTO"
    r = _conc(spark, [.25, .25, .25, .25])
    assert r[("C", "in")].concentration_risk == "MÉDIO" and abs(r[("C", "in")].hhi - 0.25) < 1e-12
    z = r[("Z", "in")]
    assert (z.hhi, z.num_partners, z.concentration_risk) == (0.0, 0, "BAIXO")


def test_one_month_partner_volatility_term(spark):
    # Q has two payments in a single month with one partner: vol term .5
    e = edges(spark, [("Q", "A", m(2020, 1), 10.0, 2)])
    prof = {r.partner_id: r for r in RK.node_profile(e).collect()}
    assert abs(prof["Q"].risk_score - min(1.0, 0.5 + 0.3 * 1.0 + 0.2)) < 1e-12


def test_scenario_tie_lower_id_wins(spark):
    rows = [("B", "C", m(2020, 1), 5.0), ("A", "C", m(2020, 1), 5.0), ("C", "D", m(2020, 1), 1.0)]
    for parts in (1, 7):
        e = edges(spark, rows).repartition(parts)
        sc = {r.scenario: r for r in RK.risk_scenarios(RK.counterparty_loss_impact(RK.pair_volumes(e)))
              .filter("company_id = 'C'").collect()}
        assert sc["top_payer_loss"].affected_companies == "A"


def test_overall_cap_and_uncapped_class(spark):
    # single partner both ways: HHI 1/1 -> 30+30, scenarios CRÍTICO x3? -> capped at 100
    rows = [("P", "C", m(2020, 1), 10.0), ("C", "P", m(2020, 1), 10.0), ("Q", "C", m(2020, 1), 0.001)]
    pairs = RK.pair_volumes(edges(spark, rows))
    sc = RK.risk_scenarios(RK.counterparty_loss_impact(pairs))
    comp = profile(spark, [("C", m(2020, 1), 1.0, 1.0, None, "x")])
    r = RK.risk_report(pairs, sc, comp).collect()[0]
    assert r.overall_risk_score == 100.0 and r.risk_classification == "CRÍTICO"


def _brute_div(rows, k=5):
    adj = {}
    touch_vals, touch_months, part_vol = {}, {}, {}
    for s, d, mo, v, n in rows:
        adj.setdefault(s, set()).add(d)
        adj.setdefault(d, set()).add(s)
        for node, other in ((s, d), (d, s)):
            touch_vals.setdefault(node, []).extend([v / n] * n)
            touch_months.setdefault(node, {}).setdefault(mo, 0.0)
            touch_months[node][mo] += v
            part_vol.setdefault(node, {}).setdefault(other, 0.0)
            part_vol[node][other] += v
    import statistics

    def risk(q):
        if len(touch_vals[q]) < 2:
            return 0.8
        mv = list(touch_months[q].values())
        vol = 0.5 if len(mv) < 2 else min(0.5, statistics.stdev(mv) / (statistics.mean(mv) + 1e-6) / 10)
        tot = sum(part_vol[q].values())
        top = max(part_vol[q].values()) / tot
        return min(1.0, vol + 0.3 * top + 0.2 / max(1, len(part_vol[q])))

    out = {}
    for c in adj:
        cands = set().union(*[adj[p] for p in adj[c]]) - adj[c] - {c}
        key = sorted(cands, key=lambda q: (risk(q), -(sum(touch_vals[q]) / len(touch_vals[q])), q))
        out[c] = key[:k]
    return out


@pytest.mark.parametrize("top_m,fanout", [(3, 2), (64, 50), (1, 1), (4, 8)])
def test_diversification_matches_brute_force(spark, top_m, fanout):
    rnd = random.Random(7)
    nodes = [f"N{i:02d}" for i in range(30)]
    rows = []
    for i in range(90):
        s, d = rnd.sample(nodes, 2)
        rows.append((s, d, m(2020, rnd.randint(1, 4)), float(rnd.randint(1, 500)), 1))
    rows += [("HUB", n, m(2020, 1), 7.0, 1) for n in nodes[:20]]  # a hub
    e = edges(spark, rows)
    got = {}
    for r in RK.diversification_targets(e, 5, top_m=top_m, fanout=fanout).collect():
        got.setdefault(r.company_id, []).append((r.rank, r.partner_id))
    got = {c: [p for _, p in sorted(v)] for c, v in got.items()}
    want = {c: v for c, v in _brute_div(rows).items() if v}
    assert got == want


def test_partners_with_zero_amounts_count(spark):
    rows = [("P1", "C", m(2020, 1), 10.0), ("P2", "C", m(2020, 1), 0.0), ("C", "S", m(2020, 1), 0.0)]
    e = edges(spark, rows)
    comp = profile(spark, [("C", m(2020, 1), 1.0, 1.0, None, "x")])
    got = {r.direction: r for r in RK.concentration_metrics(RK.pair_volumes(e), comp).collect()}
    assert (got["in"].num_partners, got["both"].num_partners) == (2, 3)
    assert (got["out"].num_partners, got["out"].concentration_risk) == (0, "BAIXO")  # the total is zero
    net = EG.network_resilience(RL.ego_edges(e, None, 3, "both", 25), comp).first()
    # nodes C, P1, P2, S: one receiver of three others, all three linked with the ego
    assert abs(net.redundancy - 1 / 3) < 1e-12 and abs(net.degree_centrality - 1.0) < 1e-12


def test_scenarios_carry_codes(spark):
    e = edges(spark, [("P1", "C", m(2020, 1), 10.0), ("C", "S", m(2020, 1), 4.0)])
    got = {r.scenario: r for r in RK.risk_scenarios(RK.counterparty_loss_impact(RK.pair_volumes(e))).filter("company_id = 'C'").collect()}
    assert set(got) == {"top_payer_loss", "top_payee_loss", "top_partners_joint_loss"}
    assert got["top_payer_loss"].description == "loss_cuts_receipts"
    assert got["top_partners_joint_loss"].mitigation_strategies[-1] == "contingency_plan"


def _random_rows(nodes, n, hub=0):
    rnd = random.Random(11)
    names = [f"N{i:03d}" for i in range(nodes)]
    rows = [(*rnd.sample(names, 2), m(2020, rnd.randint(1, 4)), float(rnd.randint(1, 500)), 1) for _ in range(n)]
    return rows + [("HUB", x, m(2020, 1), 7.0, 1) for x in names[:hub]]


@pytest.mark.parametrize("listed", [0, 300, 10**9])
def test_diversification_by_masks_and_by_lists(spark, monkeypatch, listed):
    """By bit masks alone (rounds of one word, then two), by both ways, and by lists alone."""
    monkeypatch.setattr(RK, "LISTED_ROWS", listed)
    monkeypatch.setattr(RK, "LISTED_PER_PAIR", 0)
    monkeypatch.setattr(RK, "MASKS", (1, 2))
    rows = _random_rows(220, 260, hub=30)
    got = {}
    for r in RK.diversification_targets(edges(spark, rows), 5, top_m=6, fanout=1).collect():
        got.setdefault(r.company_id, []).append((r.rank, r.partner_id))
    assert {c: [p for _, p in sorted(v)] for c, v in got.items()} == {c: v for c, v in _brute_div(rows).items() if v}


def test_short_blocks_do_not_make_more_rounds(spark, monkeypatch):
    """300 blocks of one candidate were 300 rounds of several jobs each."""
    rounds = []
    for name in ("_by_masks", "_by_lists"):
        plain = getattr(RK, name)
        monkeypatch.setattr(RK, name, lambda *a, plain=plain: rounds.append(1) or plain(*a))
    rows = _random_rows(300, 200)
    got = RK.diversification_targets(edges(spark, rows), 5, top_m=1, fanout=1, with_block=True).collect()
    assert len(rounds) <= 2
    n = len({r[0] for r in rows} | {r[1] for r in rows})
    assert got and max(r.block for r in got) == n
