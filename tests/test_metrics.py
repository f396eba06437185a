"""Dashboard metrics X9-X12 and the dashboard texts."""

import datetime as dt

import pytest

from indicata.operators import dashboard as DB
from indicata.operators import metrics as MT

D = dt.date


def frame(spark, values, col="m", serie="s"):
    data = [(serie, D(2026, mo, 1), v) for mo, v in values]
    return spark.createDataFrame(data, f"serie string, mes_ref date, {col} double")


def test_x9_latest_non_null(spark):
    long = MT.to_long(frame(spark, [(5, 100.0), (6, 110.0), (7, None)]), ("serie",), ["m"])
    r = MT.latest_metric(long, ("serie",)).first()
    assert (r.valor, r.mes_ref) == (110.0, D(2026, 6, 1))


def test_x10_all_null_keeps_the_pair(spark):
    long = MT.to_long(frame(spark, [(6, None), (7, None)]), ("serie",), ["m"])
    from indicata.functions import format_reference
    r = MT.latest_metric(long, ("serie",)).withColumn("ref", format_reference("mes_ref")).first()
    assert (r.valor, r.mes_ref, r.ref) == (None, None, "Sem referência")


def test_x11_change_skips_nulls(spark):
    long = MT.to_long(frame(spark, [(4, 4.5), (5, 4.2), (6, None)]), ("serie",), ["m"])
    r = MT.latest_metric_change(long, ("serie",)).first()
    assert r.valor == 4.2 and r.mes_ref == D(2026, 5, 1)
    assert r.variacao == pytest.approx(-0.3)


def test_single_observation_has_no_change(spark):
    long = MT.to_long(frame(spark, [(4, 4.5), (5, None)]), ("serie",), ["m"])
    r = MT.latest_metric_change(long, ("serie",)).first()
    assert (r.valor, r.variacao) == (4.5, None)


def test_x12_last_n_months(spark):
    df = frame(spark, [(3, 3.0), (1, 1.0), (2, 2.0)], col="valor")
    out = MT.last_n(df.drop("serie"), 2).orderBy("mes_ref")
    assert [r.valor for r in out.collect()] == [2.0, 3.0]
    assert MT.last_n(df, None).count() == 3
    per_series = MT.last_n(df, 2, ("serie",))
    assert sorted(r.valor for r in per_series.collect()) == [2.0, 3.0]


def test_missing_by_column_only_columns_with_gaps(spark):
    df = spark.createDataFrame([(1.0, None), (None, float("nan")), (3.0, 1.0)], "a double, b double")
    got = {r.coluna: r.valores_ausentes for r in MT.missing_by_column(df).collect()}
    assert got == {"a": 1, "b": 2}


def test_cards_and_insights(spark):
    wide = spark.createDataFrame(
        [(D(2026, 5, 1), 4.5, 6.0, 5.0), (D(2026, 6, 1), 4.2, 6.5, -1.0)],
        "mes_ref date, ipca_12m double, dollar_medio_mes double, juros_real_estimado double")
    long = MT.to_long(wide, (), ["ipca_12m", "dollar_medio_mes", "juros_real_estimado"])
    latest = MT.latest_metric_change(long, ())
    cards = {r.metric: (r.rotulo, r.valor_texto, r.variacao_texto) for r in DB.metric_cards(latest).collect()}
    assert cards["ipca_12m"] == ("IPCA 12 meses · 06/2026", "4.20%", "-0.30 p.p.")
    assert cards["dollar_medio_mes"] == ("Dólar médio · 06/2026", "R$ 6.50", "+0.50")
    texts = {r.regra: r.texto for r in DB.insight_sentences(latest).collect()}
    assert texts["ipca_12m"] == "O IPCA em 12 meses desacelerou 0.30 p.p. na última observação."
    assert texts["juros_real_estimado"] == "O juro real anual estimado está negativo, em -1.00%."
    assert texts["dollar_medio_mes"] == "O dólar médio subiu R$ 0.50 frente ao mês anterior."


def test_quality_checks_fail_when_they_should(spark):
    from indicata.operators import quality as Q
    df = spark.createDataFrame([(1, None), (1, 2.0), (2, 3.0)], "k int, v double")
    assert [(r.coluna, r.nulos, r.aprovado) for r in Q.not_null(df, ("k", "v")).orderBy("coluna").collect()] == [
        ("k", 0, True), ("v", 1, False)]
    r = Q.unique(df, ("k",), "t").first()
    assert (r.duplicadas, r.aprovado) == (1, False)
    got = {r.checagem: (r.esperado, r.obtido, r.aprovado)
           for r in Q.reconcile({"a": (3, df), "b": (4, df), "c": (2, df)}).collect()}
    assert got == {"a": (3, 3, True), "b": (4, 3, False), "c": (2, 3, False)}
    assert {r.checagem: r.aprovado for r in Q.reconcile({"c": (2, df)}, at_least=True).collect()} == {"c": True}
