from pyspark.sql import functions as F

from flowlens.functions import columns as COLS
from flowlens.functions import formats as FMT
from flowlens.operators import insights as INS


def _one(spark, values, expr, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_size_bounds(spark):
    got = _one(spark, [359999.99, 360000.0, 4.8e6, 3e8, -1.0, None], COLS.size_of)
    assert got == ["MICRO", "PEQUENA", "MEDIA", "GRANDE", "MICRO", "MICRO"]


def test_sector_quirks(spark):
    got = _one(spark, ["ATIVIDADE", "QUÍMICA", None, "SOFTWARE", "PESCA"], COLS.sector_of, "string")
    assert got == ["TECNOLOGIA", "OUTROS", "OUTROS", "TECNOLOGIA", "OUTROS"]


def test_text_prefix(spark):
    got = _one(spark, ["AB C-D", "-x", None, "a;b"], COLS.text_prefix_sector, "string")
    assert got == ["AB C", "OUTROS", "OUTROS", "A"]


def test_age(spark):
    df = spark.createDataFrame([("2000-09-01",), (None,), ("2030-01-01",)], "d string")
    got = [r[0] for r in df.select(COLS.age_years(F.to_date("d"), "2001-09-01")).collect()]
    assert abs(got[0] - 365 / 365.25) < 1e-12 and got[1] == 5.0 and got[2] == 0.0


def test_brl_format(spark):
    got = _one(spark, [0.0, None, 999.5, 1500.0, 2.5e6, -1500.0], FMT.brl)
    assert got == ["R$ 0", "R$ 0", "R$ 1.000", "R$ 1,5K", "R$ 2,5M", "R$ -1,5K"]


def test_percent_and_number(spark):
    assert _one(spark, [0.125, None], FMT.percent) == ["12,5%", "0,0%"]
    assert _one(spark, [1234.5678, None], lambda c: FMT.number_br(c, 2)) == ["1.234,57", "-"]


def test_stage_accents_same_codes(spark):
    df = spark.createDataFrame([("a", "Início", 1.0, 0.0, 0.5, 1000.0, "MICRO", 0.7),
                                ("b", "Inicio", 1.0, 0.0, 0.5, 1000.0, "MICRO", 0.7)],
                               "ID string, estagio string, idade_anos double, fluxo_medio double, "
                               "consistencia_fluxo double, receita_media double, porte string, confianca double")
    rows = {r.ID: r.insights for r in INS.contextual_insights(df).collect()}
    assert rows["a"] == rows["b"] and "start_young_company" in rows["a"]
    recs = {r.ID: r.recommendations for r in INS.actionable_recommendations(df).collect()}
    assert recs["a"] == recs["b"] and len(recs["a"]) == 3
