import random

import pytest
from pyspark.sql import functions as F

from flowlens.functions.percentiles import column_percentiles, exact_percentiles


@pytest.mark.parametrize("bucket_values", [50_000, 7])
def test_exact_percentiles_equal_the_builtin(spark, bucket_values):
    rng = random.Random(1)
    rows = [(k, g, rng.choice([None, float(rng.randint(0, 40)), rng.uniform(-5, 5)]))
            for k, g, n in (("a", "x", 400), ("a", None, 61), ("b", "x", 1), ("c", "y", 2)) for _ in range(n)]
    rows += [("d", "y", None), ("e", "z", 3.0), ("e", "z", 3.0)]
    df = spark.createDataFrame(rows, "k string, g string, v double").repartition(5)
    fs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    want = {(r.k, r.g): (r.n, r.p) for r in df.groupBy("k", "g").agg(
        F.count("v").alias("n"), F.percentile("v", F.array(*map(F.lit, fs))).alias("p")).collect() if r.n}
    got = {(r.k, r.g): (r.n, [r[f"q{i}"] for i in range(len(fs))])
           for r in exact_percentiles(df, ["k", "g"], "v", fs, bucket_values).collect()}
    assert set(got) == set(want)
    for key, (n, p) in want.items():
        assert got[key][0] == n and all(abs(x - y) < 1e-12 for x, y in zip(got[key][1], p))
    whole = df.agg(F.percentile("v", F.array(*map(F.lit, fs))).alias("p")).first().p
    assert all(abs(x - y) < 1e-12 for x, y in zip(column_percentiles(df, ["v"], fs)["v"], whole))
    assert column_percentiles(df.where("k = 'd'"), ["v"], fs) == {"v": None}
