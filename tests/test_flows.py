import math

from pyspark.sql import functions as F

from flowlens.operators import flows as FL
from flowlens.operators import features as FT
from flowlens.operators import quality as QA
from helpers import ledger, m, profile


def _flows(spark, rows):
    return {(r.ID, r.year_month): r for r in FL.monthly_flows(ledger(spark, rows)).collect()}


def test_growth_edges(spark):
    # revenue of A: 0 (only pays), 5, 0 (only pays), 0 (only pays)
    rows = [("A", "B", m(2020, 1), 3), ("X", "A", m(2020, 2), 5), ("A", "B", m(2020, 3), 2),
            ("A", "B", m(2020, 4), 1)]
    f = _flows(spark, rows)
    g = [f[("A", m(2020, i))].g_receita_mom for i in (1, 2, 3, 4)]
    assert g[0] is None and g[1] == math.inf and g[2] == -1.0 and g[3] is None
    v = [f[("A", m(2020, i))].vol_receita_3m for i in (1, 2, 3, 4)]
    assert v[0] is None and v[1] is None and v[2] is not None


def test_gap_month_uses_previous_row(spark):
    rows = [("X", "A", m(2020, 1), 10), ("X", "A", m(2020, 2), 20), ("X", "A", m(2020, 5), 30)]
    f = _flows(spark, rows)
    assert abs(f[("A", m(2020, 5))].g_receita_mom - 0.5) < 1e-12


def test_outer_join_semantics(spark):
    rows = [("A", "B", m(2020, 1), 7.0), ("B", "A", m(2020, 2), 4.0)]
    f = _flows(spark, rows)
    a1 = f[("A", m(2020, 1))]
    assert (a1.receita_mensal, a1.despesa_mensal, a1.fluxo_liquido) == (0.0, 7.0, -7.0)


def test_no_flow_profile_row_is_zero(spark):
    b1 = profile(spark, [("C", m(2020, 1), 1e6, 10.0, None, "X")])
    fl = FL.monthly_flows(ledger(spark, [("A", "B", m(2020, 1), 1.0)]))
    r = FL.f_empresa_mes(b1, fl).collect()[0]
    assert [r.receita_mensal, r.despesa_mensal, r.fluxo_liquido, r.g_receita_mom, r.vol_receita_3m] == [0.0] * 5


def test_tail_lag_not_counting_outside_window(spark):
    # 14 monthly rows; drop at row 2, rise at row 3; window of 12 starts at row 3
    rev = [100, 50, 80] + [80] * 11
    rows = [("X", "A", m(2020 + (i // 12), i % 12 + 1), v) for i, v in enumerate(rev)]
    f = FL.monthly_flows(ledger(spark, rows))
    feats = FT.stage_features(f, 12).collect()[0]
    assert feats.num_meses == 12 and feats.taxa_recuperacao == 0.0
    feats14 = FT.stage_features(f, 14).collect()[0]
    assert abs(feats14.taxa_recuperacao - 1 / (1 + 1e-6)) < 1e-9


def test_short_history_excluded(spark):
    rows = [("X", "A", m(2020, 1), 1), ("X", "A", m(2020, 2), 2), ("Y", "B", m(2020, 1), 3)]
    f = FL.monthly_flows(ledger(spark, rows))
    ids = {r.ID for r in FT.stage_features(f, 12).collect()}
    assert "A" not in ids  # 2 rows < 3
    beh = {r.ID for r in FT.behaviour_features(f, FL.edges_month(ledger(spark, rows))).collect()}
    assert "A" in beh and "B" not in beh  # 2 rows kept, 1 row dropped


def test_dirty_ledger_each_check_fires_once(spark):
    b1 = profile(spark, [("A", m(2025, 3), 1.0, 1.0, None, "X"), ("A", m(2025, 3), 1.0, 1.0, None, "X"),
                         ("B", m(2025, 5), 1.0, 1.0, None, "X")])
    b2 = ledger(spark, [("A", "B", m(2025, 4), 0.0), ("C", "C", m(2025, 4), 1.0),
                        ("A", "B", m(2025, 4), 1.0, None), ("A", "B", m(2025, 1), 1.0),
                        ("A", "B", m(2025, 9), 1.0)])
    res = {r.check: r.n_bad for r in QA.validate(b1, b2).collect()}
    assert res == {"duplicate_profile_key": 1, "non_positive_amount": 1, "self_payment": 1,
                   "channel_out_of_domain": 1, "month_before_floor": 1, "month_after_profile": 1}
