from flowlens.operators import flows as FL
from flowlens.operators import risk as RK
from flowlens.sources.adapter import load_bases

SF1 = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_same_result_for_any_partitioning(spark):
    b = load_bases(spark, SF1)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for parts in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            led = b.base2.repartition(int(parts))
            e = FL.edges_month(led)
            pairs = RK.pair_volumes(e)
            out.append((_rows(FL.monthly_flows(led)),
                        _rows(RK.risk_report(pairs, RK.risk_scenarios(RK.counterparty_loss_impact(pairs)), b.base1))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]
