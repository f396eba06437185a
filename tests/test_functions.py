import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from indicata.functions import (annualize, fisher_real_rate, format_delta, format_metric,
                                format_reference, fx_trend, inflation_pressure, rate_level,
                                rounded, with_calendar_parts)
from indicata.functions.numeric import comparable, comparison_rounding, unrounded


def one(spark, expr, value, typ="double"):
    df = spark.createDataFrame([(value,)], f"x {typ}")
    return df.select(expr(F.col("x")).alias("y")).first().y


def test_rounding_is_half_up_and_rounds_once(spark):
    assert one(spark, lambda c: rounded(c, 2), 0.125) == 0.13
    assert one(spark, lambda c: rounded(c, 2), -0.125) == -0.13
    assert one(spark, lambda c: rounded(c, 4), 1.00004999999999) == 1.0
    assert one(spark, lambda c: rounded(c, 4), None) is None
    assert one(spark, unrounded, 1 / 3) == 1 / 3


def test_comparison_rounding_is_opt_in(spark):
    with comparison_rounding():
        inside = rounded(F.col("x"), 4)
    assert spark.createDataFrame([(1.00004999999999,)], "x double").select(inside.alias("y")).first().y == 1.0001
    assert one(spark, lambda c: rounded(c, 4), 1.00004999999999) == 1.0


def test_annualize_252_business_days(spark):
    for daily in (0.0275, 0.0533, 0.0):
        assert one(spark, annualize, daily) == pytest.approx(round((1 + daily / 100) ** 252 - 1, 6), abs=1e-12)


def test_fisher_real_rate(spark):
    df = spark.createDataFrame([(13.25, 4.75), (2.0, 7.9), (None, 1.0), (5.0, -100.0)], "a double, b double")
    got = [r.y for r in df.select(fisher_real_rate("a", "b").alias("y")).collect()]
    assert got[0] == pytest.approx(round((1.1325 / 1.0475 - 1) * 100, 4), abs=1e-9)
    assert got[1] == pytest.approx(round((1.02 / 1.079 - 1) * 100, 4), abs=1e-9)
    assert got[2] is None
    assert got[3] is None  # division by zero gives NULL, not an error


def test_labels_and_null_fall_through(spark):
    df = spark.createDataFrame([(5.0,), (8.0,), (12.0,), (15.0,), (None,)], "v double")
    assert [r.l for r in df.select(rate_level("v").alias("l")).collect()] == [
        "baixo", "moderado", "alto", "muito_alto", "muito_alto"]
    df = spark.createDataFrame([(-0.1,), (0.2,), (0.4,), (0.8,)], "v double")
    assert [r.l for r in df.select(inflation_pressure("v").alias("l")).collect()] == [
        "deflacao", "controlada", "moderada", "elevada"]
    df = spark.createDataFrame([(None,), (0.1,), (-0.1,), (0.05,)], "v double")
    assert [r.l for r in df.select(fx_trend("v").alias("l")).collect()] == [
        "estavel", "alta", "queda", "estavel"]


def test_calendar_parts_sunday_is_one(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 1, 7),)], "data date")
    got = with_calendar_parts(df, weekday=True).collect()
    assert [(r.ano, r.mes, r.trimestre, r.dia_semana) for r in got] == [(2024, 1, 1, 3), (2024, 1, 1, 1)]


def test_formatting(spark):
    df = spark.createDataFrame([(dt.date(2026, 5, 1), 4.2, -0.3), (None, None, None), (None, 0.125, 0.0)],
                               "m date, v double, c double")
    out = df.select(format_reference("m").alias("r"), format_metric("v", "R$ ", " mi").alias("t"),
                    format_delta("c", " p.p.").alias("d")).collect()
    assert (out[0].r, out[0].t, out[0].d) == ("05/2026", "R$ 4.20 mi", "-0.30 p.p.")
    assert (out[1].r, out[1].t, out[1].d) == ("Sem referência", "Sem dados", None)
    assert (out[2].t, out[2].d) == ("R$ 0.13 mi", "+0.00 p.p.")


def test_huge_and_non_finite_values_pass_through(spark):
    assert one(spark, annualize, 30.0) > 1e28  # (1.3)^252, no cast failure under ANSI
    for f in (lambda c: rounded(c, 4), lambda c: comparable(c, 4)):
        assert math.isnan(one(spark, f, float("nan")))
        assert one(spark, f, float("inf")) == float("inf")
        assert one(spark, f, 1e30) == 1e30
    assert one(spark, format_metric, 1e17) == "100000000000000000.00"
    assert one(spark, format_metric, 1e300) == "1.0E300"
