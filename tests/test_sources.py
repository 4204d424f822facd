import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from flowlens.plans import pipeline
from flowlens.plans.pipeline import BuildConfig, build_all
from flowlens.schemas import BASE1, BASE2
from flowlens.sources import publish as PB
from flowlens.sources.adapter import AS_OF, load_bases
from flowlens.sources.declared import SchemaError, classified, read_declared

SF1 = "/root/testdata/sf0.001"


def _folder():
    return tempfile.mkdtemp(prefix="flowlens-sources-", dir="/tmp")


CSV = """ID_PGTO,ID_RCBE,DT_REFE,VL,DS_TRAN
E1,E2,2001-05-01,10.5,PIX
E1,E3,yesterday,1,TED
E2,E3,2001-05-01,much,PIX
E2,E3,soon,NaN,PIX
E4,E5,2001-06-01
E4,E5,2001-06-01,1,PIX,more
,E5,,,
"E6, Inc.",E1, 2001-07-01 , 7 ,SISTEMICO
"""


def test_a_type_broken_csv_ends_in_good_rows_and_rejects(spark):
    root = _folder()
    with open(f"{root}/in.csv", "w") as f:
        f.write(CSV)
    good, bad = read_declared(spark, f"{root}/in.csv", BASE2, f"{root}/out")
    assert good.columns == BASE2.names and dict(good.dtypes) == {f.name: f.dataType.simpleString() for f in BASE2}
    rows = {tuple(r) for r in good.collect()}
    assert rows == {("E1", "E2", dt.date(2001, 5, 1), 10.5, "PIX"), (None, "E5", None, None, None),
                    ("E6, Inc.", "E1", dt.date(2001, 7, 1), 7.0, "SISTEMICO")}
    rejects = [(r["reasons"], r["record"]) for r in bad.collect()]
    assert sorted(r for r, _ in rejects) == [["DT_REFE"], ["DT_REFE", "VL"], ["VL"], ["record"], ["record"]]
    assert {x for r, x in rejects if r == ["record"]} == {"E4,E5,2001-06-01", "E4,E5,2001-06-01,1,PIX,more"}
    assert json.loads(next(x for r, x in rejects if r == ["VL"]))["VL"] == "much"
    assert good.count() + bad.count() == len(CSV.splitlines()) - 1


def test_json_and_typed_sources_and_missing_columns(spark):
    root = _folder()
    with open(f"{root}/in.json", "w") as f:
        f.write('{"ID": "1", "DT_REFE": "2001-05-01", "VL_FATU": 5, "extra": 1}\n{"ID": null, "VL_FATU": "6"}\n{"ID": "2", "VL_SLDO": \n')
    good, bad = read_declared(spark, f"{root}/in.json", BASE1, f"{root}/out", "json")
    assert [tuple(r) for r in good.collect()] == [("1", dt.date(2001, 5, 1), 5.0, None, None, None)]
    assert sorted(r["reasons"] for r in bad.collect()) == [["ID"], ["record"]]  # ID is declared as not null
    b = load_bases(spark, SF1)
    b.base2.withColumn("record", F.lit(1)).write.parquet(f"{root}/typed")  # a column more, with a clashing name
    good, bad = read_declared(spark, f"{root}/typed", BASE2, f"{root}/out2", "parquet")
    assert bad.count() == 0 and good.exceptAll(b.base2).count() == 0 and good.count() == b.base2.count()
    with pytest.raises(SchemaError, match="DS_TRAN"):
        read_declared(spark, f"{root}/typed", BASE2, f"{root}/out3", "parquet", raw=b.base2.drop("DS_TRAN"))
    good, bad = read_declared(spark, "", BASE2, f"{root}/out4", raw=b.base2_raw.limit(0))
    assert good.count() == bad.count() == 0
    raw = b.base2_raw
    assert classified(raw, BASE2).where("size(reasons) > 0").count() == raw.where("VL = 'n/a'").count() > 0


def test_a_build_killed_between_two_sinks_leaves_the_earlier_one(spark, monkeypatch):
    root = _folder()
    b = load_bases(spark, SF1)
    cfg = BuildConfig(out_dir=root, as_of=AS_OF, date_floor="1990-01-01", run_ensemble=False, strict=False)

    class Killed(Exception):
        pass

    def die(*_):
        raise Killed

    # models are tested elsewhere: a plain stage keeps these builds short
    monkeypatch.setattr(pipeline.ST, "stage_unsupervised", lambda f: f.select(
        "ID", F.lit("Maturidade").alias("estagio"), F.lit(1.0).alias("confianca")))
    monkeypatch.setattr(pipeline.ST, "stage_supervised", lambda s: (_ for _ in ()).throw(ValueError("no labels")))
    assert PB.published_paths(spark, root) == {}
    first = build_all(spark, b.base1, b.base2, cfg)
    assert PB.published_paths(spark, root) == first
    before = {n: spark.read.parquet(p).count() for n, p in first.items()}
    with monkeypatch.context() as m:
        m.setattr(pipeline.SC, "competitive_analysis", die)
        with pytest.raises(Killed):
            build_all(spark, b.base1, b.base2.where("DT_REFE > '1995-01-01'"), cfg)
    assert PB.published_paths(spark, root) == first
    assert {n: PB.read_published(spark, root, n).count() for n in first} == before
    # a manifest without its end mark is none; its number is not taken again
    spark.createDataFrame([("base1", "nowhere")], "name string, path string").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(f"{root}/_manifests/v=00000001")
    assert PB.published_versions(spark, root) == [0] and PB.published_paths(spark, root) == first
    assert PB.publish(spark, root, {"base1": first["base1"]}) == 2
    assert PB.published_paths(spark, root) == {"base1": first["base1"]} and PB.published_paths(spark, root, 0) == first
    with pytest.raises(LookupError):
        PB.published_paths(spark, root, 1)


def test_one_month_is_overwritten(spark):
    path = f"{_folder()}/t"
    spark.createDataFrame([(m, i) for m in ("2001-01", "2001-02") for i in range(5)], "month string, v long").write.partitionBy("month").parquet(path)
    PB.overwrite_partitions(spark.createDataFrame([("2001-02", 9), ("2001-03", 1)], "month string, v long"), path, ["month"])
    got = {r["month"]: r["n"] for r in spark.read.parquet(path).groupBy("month").agg(F.count("*").alias("n")).collect()}
    assert {str(k)[:7]: n for k, n in got.items()} == {"2001-01": 5, "2001-02": 1, "2001-03": 1}
