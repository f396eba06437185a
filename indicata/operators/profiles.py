"""Profiles of a layer: date range, counts, rounded means, label counts.

``keys`` groups the profile (per series); with no keys it is global, as in
the reference's manual checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.functions.numeric import rounded, unrounded


def _base(df: DataFrame):
    return [F.min("data").alias("data_inicio"), F.max("data").alias("data_fim"),
            F.count(F.lit(1)).alias("total_linhas")]


def profile_rate(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return silver.groupBy(*keys).agg(
        *_base(silver),
        rounded(F.avg("valor"), 2).alias("selic_media"),
        F.count_distinct("nivel_taxa").alias("niveis_distintos"),
    )


def profile_inflation(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return silver.groupBy(*keys).agg(
        *_base(silver),
        rounded(F.avg("acumulado_12m"), 2).alias("inflacao_12m_media"),
    )


def profile_fx(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return silver.groupBy(*keys).agg(
        *_base(silver),
        rounded(F.avg("valor"), 2).alias("dolar_medio"),
        rounded(F.max("valor"), 2).alias("dolar_max"),
    )


def profile_bronze(bronze: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Total rows, first and last date, NULL values (NaN is not NULL here)."""
    return bronze.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.min("data").alias("primeira_data"),
        F.max("data").alias("ultima_data"),
        F.count_if(F.col("valor").isNull()).alias("valores_nulos"),
    )


def label_distribution(silver: DataFrame, label: str, count_name: str = "ocorrencias",
                       mean_name: str = "media") -> DataFrame:
    """Rows and mean value per label (sort by the mean at the edge)."""
    return silver.groupBy(label).agg(
        F.count(F.lit(1)).alias(count_name),
        unrounded(F.avg("valor")).alias(mean_name),
    )


def distinct_values(df: DataFrame, column) -> DataFrame:
    return df.select(column).distinct()


def row_counts(tables: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """``{name: (layer, df)}`` -> one row per table with its row count.

    One aggregation over a union that has no columns of the tables: of written
    tables only the footers are read, and a task sends one count, not rows.
    """
    parts = [df.select(F.lit(name).alias("tabela"), F.lit(layer).alias("camada"), F.lit(1).alias("um"))
             for name, (layer, df) in tables.items()]
    none = next(iter(tables.values()))[1].sparkSession.createDataFrame(
        [(name, layer, 0) for name, (layer, _) in tables.items()], "tabela string, camada string, um int")
    out = none
    for p in parts:
        out = out.unionByName(p)
    return out.groupBy("tabela", "camada").agg(F.sum("um").alias("linhas"))
