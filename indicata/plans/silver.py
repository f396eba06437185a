"""Silver layer: one pure ``DataFrame -> DataFrame`` function per kind.

Input is bronze (``serie, data, valor`` plus audit columns). Each function
optionally keeps the newest ingestion per (series, date), filters invalid
values, adds calendar parts and computes the kind's window indicators for
every series at once (windows partitioned by series). No output ordering
is imposed; sort at the edge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.functions.calendar import with_calendar_parts
from indicata.functions.labels import (
    PRESSURE_BANDS, PRESSURE_TOP, RATE_LEVEL_BANDS, RATE_LEVEL_TOP, TREND_DOWN, TREND_UP,
    fx_trend, inflation_pressure, rate_level,
)
from indicata.functions.numeric import annualize, is_valid_number
from indicata.operators import windows as W
from indicata.operators.dedup import latest_per_key

RATE_COLUMNS = ("data", "valor", "variacao_pp", "taxa_anualizada", "media_movel_30d",
                "volatilidade_30d", "acumulado_ano", "nivel_taxa", "ano", "mes", "trimestre",
                "dia_semana")
FX_COLUMNS = ("data", "valor", "variacao_abs", "variacao_pct", "media_movel_30d", "max_30d",
              "min_30d", "tendencia", "ano", "mes", "trimestre")
INFLATION_COLUMNS = ("data", "valor", "variacao_pp", "acumulado_12m", "acumulado_ano", "pressao",
                     "ano", "mes", "trimestre")


def deduplicate(bronze: DataFrame, keys: Sequence[str] = ("serie",),
                tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest ingestion per (keys, data). A bronze table without the columns
    that decide the winner is an error: pass ``dedup=False`` or another
    ``tie_break`` where none is needed."""
    missing = [c for c in ("_ingested_at", *tie_break) if c not in bronze.columns]
    if missing:
        raise ValueError(f"de-duplication needs {missing}")
    return latest_per_key(bronze, (*keys, "data"), ("_ingested_at",), tie_break)


def _prepare(bronze: DataFrame, keys: Sequence[str], dedup: bool, tie_break: Sequence[str]) -> DataFrame:
    return deduplicate(bronze, keys, tie_break) if dedup else bronze


def valid_rate(df: DataFrame, upper_bound: float = 100.0) -> DataFrame:
    """Not NULL, not NaN, strictly between 0 and ``upper_bound``."""
    v = F.col("valor")
    return df.filter(is_valid_number(v) & (v > 0) & (v < upper_bound))


def valid_fx(df: DataFrame) -> DataFrame:
    """Not NULL, not NaN, positive."""
    v = F.col("valor")
    return df.filter(is_valid_number(v) & (v > 0))


def valid_inflation(df: DataFrame) -> DataFrame:
    """Not NULL, not NaN (negative months are deflation, kept)."""
    return df.filter(is_valid_number("valor"))


def _project(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.select(*keys, *columns)


def silver_rate(bronze: DataFrame, keys: Sequence[str] = ("serie",), *, dedup: bool = True,
                tie_break: Sequence[str] = ("_seq",), bands=RATE_LEVEL_BANDS,
                top: str = RATE_LEVEL_TOP, upper_bound: float = 100.0) -> DataFrame:
    """Policy-rate silver: valid values in (0, upper_bound), daily change,
    annualized rate, 30-row moving average and volatility, year-to-date
    average, level label and calendar parts (with weekday)."""
    df = _prepare(bronze, keys, dedup, tie_break)
    v = F.col("valor")
    df = with_calendar_parts(valid_rate(df, upper_bound), weekday=True)
    w = W.series_window(keys, ("ano", "data"))
    df = df.withColumns({
        "variacao_pp": W.change(v, w),
        "taxa_anualizada": annualize(v),
        "media_movel_30d": W.moving_avg(v, w, 30),
        "volatilidade_30d": W.moving_stddev(v, w, 30),
        "acumulado_ano": W.ytd(F.avg, v, keys),
        "nivel_taxa": rate_level(v, bands, top),
    })
    return _project(df, keys, RATE_COLUMNS)


def silver_fx(bronze: DataFrame, keys: Sequence[str] = ("serie",), *, dedup: bool = True,
              tie_break: Sequence[str] = ("_seq",), up: float = TREND_UP,
              down: float = TREND_DOWN) -> DataFrame:
    """FX silver: valid positive values, absolute and percent change,
    30-row moving average / max / min, trend label from the rounded change."""
    df = _prepare(bronze, keys, dedup, tie_break)
    v = F.col("valor")
    df = with_calendar_parts(valid_fx(df))
    w = W.series_window(keys, ("ano", "data"))
    df = df.withColumns({
        "variacao_abs": W.change(v, w),
        "variacao_pct": W.pct_change(v, w),
        "media_movel_30d": W.moving_avg(v, w, 30),
        "max_30d": W.moving_max(v, w, 30),
        "min_30d": W.moving_min(v, w, 30),
    })
    df = df.withColumn("tendencia", fx_trend("variacao_abs", up, down))
    return _project(df, keys, FX_COLUMNS)


def silver_inflation(bronze: DataFrame, keys: Sequence[str] = ("serie",), *, dedup: bool = True,
                     tie_break: Sequence[str] = ("_seq",), bands=PRESSURE_BANDS,
                     top: str = PRESSURE_TOP) -> DataFrame:
    """Inflation silver: valid values (negative allowed), change, 12-row sum
    (plain sum, not compounded), year-to-date sum and pressure label."""
    df = _prepare(bronze, keys, dedup, tie_break)
    v = F.col("valor")
    df = with_calendar_parts(valid_inflation(df))
    w = W.series_window(keys, ("ano", "data"))
    df = df.withColumns({
        "variacao_pp": W.change(v, w),
        "acumulado_12m": W.rolling_sum(v, w, 12),
        "acumulado_ano": W.ytd(F.sum, v, keys),
        "pressao": inflation_pressure(v, bands, top),
    })
    return _project(df, keys, INFLATION_COLUMNS)


def silver_plain(bronze: DataFrame, keys: Sequence[str] = ("serie",), *, dedup: bool = True,
                 tie_break: Sequence[str] = ("_seq",)) -> DataFrame:
    """Monthly series without indicators: keys, date and value only.

    No value filter: a NULL value survives to silver and is ignored later
    by ``avg`` (as in the reference). A NaN is stored as NULL, so it is
    treated like any other missing value instead of turning averages into NaN."""
    df = _prepare(bronze, keys, dedup, tie_break)
    v = F.col("valor")
    return df.select(*keys, "data", F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v).alias("valor"))


SILVER_BUILDERS = {
    "rate": silver_rate,
    "fx": silver_fx,
    "inflation": silver_inflation,
    "plain": silver_plain,
}
