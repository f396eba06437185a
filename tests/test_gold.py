"""Monthly aggregates, the wide gold table, and the left-join rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from indicata.operators import gold as G
from indicata.operators import monthly as M
from indicata.plans import silver as S
from tests.e2e_fixture import FIXTURE, GOLD, yearly


def bronze(spark, kind):
    name, values = FIXTURE[kind]
    return spark.createDataFrame([(name, dt.date.fromisoformat(d), v) for d, v in values],
                                 "serie string, data date, valor double")


def build_gold(spark, drop_month=None):
    rate = S.silver_rate(bronze(spark, "rate"), dedup=False)
    infl = S.silver_inflation(bronze(spark, "inflation"), dedup=False)
    if drop_month:
        infl = infl.filter(F.col("data") != F.lit(drop_month).cast("date"))
    return G.gold_wide(M.monthly_rate(rate), M.monthly_inflation(infl), M.monthly_fx(S.silver_fx(bronze(spark, "fx"), dedup=False)),
                       M.monthly_level(S.silver_plain(bronze(spark, "level"), dedup=False)),
                       M.monthly_ratio(S.silver_plain(bronze(spark, "ratio"), dedup=False)))


def test_e2e_silver_values(spark):
    rate = S.silver_rate(bronze(spark, "rate"), dedup=False).orderBy("data").collect()
    assert [r.taxa_anualizada for r in rate] == [yearly(v) for v in (0.05, 0.03, 0.06)]
    assert [r.variacao_pp for r in rate] == [None, -0.02, 0.03]
    assert [r.media_movel_30d for r in rate] == [0.05, 0.04, 0.0467]
    assert [r.volatilidade_30d for r in rate] == [None, 0.014142, 0.015275]
    fx = S.silver_fx(bronze(spark, "fx"), dedup=False).orderBy("data").collect()
    assert [r.variacao_abs for r in fx] == [None, 0.2, -0.1]
    assert [r.variacao_pct for r in fx] == [None, 4.0, -1.9231]
    assert [r.media_movel_30d for r in fx] == [5.0, 5.1, 5.1]
    infl = S.silver_inflation(bronze(spark, "inflation"), dedup=False).orderBy("data").collect()
    assert [r.acumulado_12m for r in infl] == [0.4, 0.65]


def test_e2e_gold_values(spark):
    gold = build_gold(spark)
    assert gold.count() == 2
    march = gold.filter(F.col("mes_ref") == F.lit("2024-03-01").cast("date")).collect()
    assert len(march) == 1
    for row in gold.collect():
        expected = GOLD[row.mes_ref.isoformat()]
        for col, value in expected.items():
            assert row[col] == pytest.approx(value, abs=1e-9), col


def test_month_missing_on_the_right_gives_nulls(spark):
    gold = build_gold(spark, drop_month="2024-04-01")
    april = gold.filter(F.col("mes_ref") == F.lit("2024-04-01").cast("date")).first()
    assert april.ipca_12m is None and april.juros_real_estimado is None
    assert april.selic_media_mes == pytest.approx(0.06)


def test_month_only_on_the_right_is_absent(spark):
    extra = spark.createDataFrame([("ipca", dt.date(2024, 5, 1), 0.5)], "serie string, data date, valor double")
    infl = S.silver_inflation(bronze(spark, "inflation").unionByName(extra), dedup=False)
    rate = S.silver_rate(bronze(spark, "rate"), dedup=False)
    joined = G.gold_left_join_two(M.monthly_rate(rate), M.monthly_inflation(infl))
    assert sorted(r.mes_ref.month for r in joined.collect()) == [3, 4]


def test_monthly_fx_keeps_min_but_gold_does_not(spark):
    fx_m = M.monthly_fx(S.silver_fx(bronze(spark, "fx"), dedup=False))
    assert "dollar_min_mes" in fx_m.columns
    assert "dollar_min_mes" not in build_gold(spark).columns


def test_gold_joins_need_no_extra_shuffle_of_the_monthly_sides(spark):
    plan = build_gold(spark)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_monthly_aggregates_keep_full_precision(spark):
    rows = [("s", dt.date(2024, 3, 1), 1000.123456), ("s", dt.date(2024, 3, 2), 3e-09)]
    df = spark.createDataFrame(rows, "serie string, data date, valor double")
    assert M.monthly_level(df.filter("valor > 1")).first().pib_valor_mes == 1000.123456
    assert M.monthly_ratio(df.filter("valor < 1")).first().inadimplencia_media_mes == 3e-09
