from pyspark.sql import functions as F

from flowlens.operators import stages as ST
from flowlens.plans import catalog
from flowlens.plans.context import context

SF1 = "/root/testdata/sf0.001"


def test_choose_k_rules():
    # the bend 100-60-50 ends at k = 4; the best silhouette (3) is next to it and wins
    trials = list(zip([2, 3, 4, 5, 6], [100, 60, 50, 45, 42], [0.3, 0.5, 0.4, 0.2, 0.1]))
    assert ST.choose_k(trials) == 3
    assert ST.choose_k([(2, 10.0, 0.2)]) == 2
    # elbow 5 (99-98-20 bends most), silhouette 2 is too far: the elbow
    assert ST.choose_k(list(zip([2, 3, 4, 5, 6], [100, 99, 98, 20, 19], [0.9, 0.2, 0.1, 0.1, 0.1]))) == 5
    # an elbow beyond five is cut to five
    assert ST.choose_k(list(zip(range(2, 9), [70, 60, 50, 40, 30, 20, 19], [0.9] + [0.1] * 6))) == 5


def test_split_and_folds_are_stratified(spark):
    rows = [(f"E{i}", lab) for lab, n in (("a", 1), ("b", 2), ("c", 10), ("d", 997)) for i in range(n)]
    df = ST.with_order_in_label(spark.createDataFrame(rows, "ID string, label string").repartition(4), "label", ["ID"])
    got = df.withColumn("test", ST.in_test(F.col("label_rank"), F.col("label_rows"), 0.2)).collect()
    per = {}
    for r in got:
        per.setdefault(r.label, []).append(r)
    for lab, n in (("a", 1), ("b", 2), ("c", 10), ("d", 997)):
        assert sorted(r.label_rank for r in per[lab]) == list(range(1, n + 1))
        assert {r.label_rows for r in per[lab]} == {n}
        assert sum(r.test for r in per[lab]) == {"a": 0, "b": 1, "c": 2, "d": 199}[lab]


def test_ensemble_probabilities(spark):
    ctx = context(spark, SF1)
    pred, info, xs = ST.stage_ensemble(catalog._profile(ctx), folds=2, rf_trees=10, rf_depth=4,
                                       gb_rounds=3, gb_depth=2)
    probs = [c for c in pred.columns if c.startswith("prob_")]
    rows = pred.collect()
    assert rows
    for r in rows:
        s = sum(r[c] for c in probs)
        assert abs(s - 1.0) < 1e-9
        assert 0.0 <= r.incerteza <= 1.0 + 1e-9
        assert r.confianca >= r.segunda_opcao_prob - 1e-12
    w = {r.item: r.value for r in info.filter(F.col("metric") == "weight").collect()}
    assert abs(w["rf"] + w["gb"] - 1.0) < 1e-12
    ex = ST.explain_prediction(pred, info, xs, 3)
    assert ex.select("feature").distinct().count() <= 3


def test_partitions_of_a_fit():
    # 60,000 companies were two tasks, 4.8 million rows were 96 that each sent all open nodes' statistics
    assert ST._model_partitions(60_000, 12, ST.ENSEMBLE_TASK_ROWS) == 12
    assert ST._model_partitions(60_000, 12) == 2
    assert ST._model_partitions(4_800_000, 12) == 24
    assert ST._model_partitions(1_000, 12) == 1
    assert ST._model_partitions(0, 12) == 1
