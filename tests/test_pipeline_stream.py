import tempfile

from pyspark.sql import functions as F

from flowlens.operators import flows as FL
from flowlens.plans.pipeline import BuildConfig, build_all
from flowlens.sources.adapter import AS_OF, load_bases
from flowlens.streaming import flows as SF

SF1 = "/root/testdata/sf0.001"


def test_build_all_writes_every_sink(spark):
    b = load_bases(spark, SF1)
    out = tempfile.mkdtemp(prefix="flowlens-build-", dir="/tmp")
    paths = build_all(spark, b.base1, b.base2,
                      BuildConfig(out_dir=out, as_of=AS_OF, date_floor="1990-01-01", run_ensemble=False, strict=False))  # the ledger has zero amounts
    for name in ["f_empresa_mes", "estagio_unsupervised", "estagio", "sector_analysis", "relations_latest"]:
        assert spark.read.parquet(paths[name]).count() > 0, name
    st = spark.read.parquet(paths["estagio_unsupervised"])
    assert st.filter(~F.col("estagio").isin("Início", "Crescimento", "Maturidade", "Declínio",
                                            "Reestruturação")).count() == 0
    assert st.filter((F.col("confianca") < 0) | (F.col("confianca") > 1)).count() == 0


def _totals(df):
    return {(r.ID, r.year_month): (round(r.receita_mensal, 6), round(r.despesa_mensal, 6)) for r in df.collect()}


def test_streaming_totals_match_batch_across_a_restart(spark):
    b = load_bases(spark, SF1)
    root = tempfile.mkdtemp(prefix="flowlens-stream-", dir="/tmp")
    led = b.base2.withColumn("_part", F.pmod(F.xxhash64("ID_PGTO", "ID_RCBE", "DT_REFE"), F.lit(3))).persist()
    assert SF.latest_snapshot(spark, f"{root}/snapshot") is None
    for parts in ([0, 1], [2]):  # the stream ends after the first two files and is started anew for the third
        for p in parts:
            led.filter(F.col("_part") == p).drop("_part").write.mode("append").parquet(f"{root}/ledger")
        SF.run_monthly_flows(spark, f"{root}/ledger", f"{root}/snapshot", f"{root}/ckpt").awaitTermination(300)
    assert len(SF.snapshot_versions(spark, f"{root}/snapshot")) > 1
    snap = SF.latest_snapshot(spark, f"{root}/snapshot")
    batch = _totals(FL.monthly_flows(b.base2))
    assert _totals(snap) == batch
    assert SF.flows_from_snapshot(snap).count() == len(batch)
    led.unpersist()
