from pyspark.sql import functions as F

from flowlens.operators import features as FT
from flowlens.plans.context import Context
from flowlens.sources.adapter import load_bases
from helpers import m

SF1 = "/root/testdata/sf0.001"


def test_profile_months_of_suppliers_are_spread_over_tasks(spark):
    """A small supplier file is one split: all company months came out of one task."""
    sizes = [r["count"] for r in load_bases(spark, SF1).base1.groupBy(F.spark_partition_id()).count().collect()]
    # sf0.001 has few suppliers: what counts is that they do not lie together
    assert len(sizes) > 1 and max(sizes) < sum(sizes)


def test_shared_frames_are_read_back_by_column(spark):
    ctx = Context(spark, SF1)
    plan = ctx.base2.select("VL")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ReadSchema: struct<VL:double>" in plan, plan
    assert "ID_RCBE" not in plan
    assert sorted(map(tuple, ctx.base1.collect()), key=str) == sorted(map(tuple, ctx.bases.base1.collect()), key=str)


def test_rule_stages_read_the_labels_once(spark):
    rows = [("A", m(2020, 1), "x"), ("A", m(2020, 2), "x"), ("A", m(2020, 3), "y"), ("B", None, "y"), ("B", m(2020, 1), "x"),
            ("C", None, "y"), (None, m(2020, 1), "x")]
    df = FT.rule_stages(spark.createDataFrame(rows, "ID string, DT_REFE date, label string"))
    got = {r["ID"]: (r["estagio"], r["confianca"]) for r in df.collect()}
    assert got == {"A": ("y", 1 / 3), "B": ("x", 0.5), "C": ("y", 1.0)}
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
