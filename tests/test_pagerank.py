import numpy as np

from flowlens.operators.pagerank import pagerank


def _power(nodes, edges, alpha=0.85, tol=1e-12):
    idx = {n: i for i, n in enumerate(nodes)}
    n = len(nodes)
    W = np.zeros((n, n))
    for s, d, w in edges:
        W[idx[s], idx[d]] += w
    out = W.sum(axis=1)
    x = np.full(n, 1.0 / n)
    for _ in range(1000):
        dang = x[out == 0].sum()
        P = np.divide(W, out[:, None], out=np.zeros_like(W), where=out[:, None] > 0)
        nx_ = (1 - alpha) / n + alpha * (x @ P + dang / n)
        if np.abs(nx_ - x).sum() < tol:
            x = nx_
            break
        x = nx_
    return {k: x[i] for k, i in idx.items()}


def test_pagerank_matches_power_iteration(spark):
    edges = [("A", "B", 3.0), ("B", "C", 1.0), ("C", "A", 2.0), ("A", "C", 1.0), ("D", "A", 5.0), ("C", "E", 1.0)]
    df = spark.createDataFrame(edges, "src string, dst string, weight double")
    got = {r.node_id: r.pagerank for r in pagerank(df, tol=1e-12, max_iter=200).collect()}
    want = _power(sorted({e[0] for e in edges} | {e[1] for e in edges}), edges)
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k] - want[k]) < 1e-8
    assert abs(sum(got.values()) - 1.0) < 1e-9
