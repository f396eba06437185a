"""Monthly aggregates of the silver tables (partial + final hash aggregation).

``keys`` are extra grouping keys (e.g. ``("serie",)``); with no keys the
month is the only key, as in the reference's wide table. Aggregates keep
full precision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.functions.calendar import month_start
from indicata.functions.numeric import DIGITS_COMPARED, unrounded


# Digits of money amounts that a comparison looks at (they are large).
COMPARED_MONEY = {"pib_valor_mes": 2}


def _by_month(df: DataFrame, keys: Sequence[str]):
    return df.groupBy(*keys, month_start("data").alias("mes_ref"))


def monthly_rate(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return _by_month(silver, keys).agg(
        unrounded(F.avg("valor")).alias("selic_media_mes"),
        F.max("valor").alias("selic_max_mes"),
        F.min("valor").alias("selic_min_mes"),
        unrounded(F.avg("taxa_anualizada") * F.lit(100.0)).alias("selic_anualizada_mes"),
    )


def monthly_inflation(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return _by_month(silver, keys).agg(
        unrounded(F.sum("valor")).alias("ipca_acumulado_mes"),
        F.max("acumulado_12m").alias("ipca_12m"),
    )


def monthly_fx(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Average, max and min; the min is kept here but not in the wide table."""
    return _by_month(silver, keys).agg(
        unrounded(F.avg("valor")).alias("dollar_medio_mes"),
        F.max("valor").alias("dollar_max_mes"),
        F.min("valor").alias("dollar_min_mes"),
    )


def monthly_average(silver: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Plain monthly series (level, ratio): the mean of the month, NULLs ignored."""
    return _by_month(silver, keys).agg(unrounded(F.avg("valor"), COMPARED_MONEY.get(name, DIGITS_COMPARED)).alias(name))


def monthly_level(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return monthly_average(silver, "pib_valor_mes", keys)


def monthly_ratio(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return monthly_average(silver, "inadimplencia_media_mes", keys)


def monthly_plain(silver: DataFrame, names: dict[str, str]) -> DataFrame:
    """Several plain series in one pass: ``{serie: column}``, a mean for each;
    months in which none of them has a row are absent."""
    known = silver.filter(F.col("serie").isin(*names))
    return _by_month(known, ()).agg(*[
        unrounded(F.avg(F.when(F.col("serie") == serie, F.col("valor"))),
                  COMPARED_MONEY.get(name, DIGITS_COMPARED)).alias(name)
        for serie, name in names.items()])
