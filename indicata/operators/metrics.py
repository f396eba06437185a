"""Dashboard metrics as set-based DataFrame operators.

The reference computes these in pandas on the driver for one table of a
dozen rows. Here they run for every (series, metric) pair at once: the
wide table is unpivoted to ``(keys, metric, mes_ref, valor)`` and each
metric becomes a grouped aggregation or a rank-limited window, so nothing
is collected and no group is gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicata.functions.formatting import format_reference


def to_long(df: DataFrame, keys: Sequence[str], metrics: Sequence[str],
            time_col: str = "mes_ref") -> DataFrame:
    """Wide -> long ``(keys, time_col, metric, valor)``; NULL values are kept."""
    return df.unpivot([*keys, time_col], list(metrics), "metric", "valor")


def valid_metric_rows(long: DataFrame) -> DataFrame:
    """Observations of a metric that are not NULL (NaN counts as missing too)."""
    v = F.col("valor")
    return long.filter(v.isNotNull() & ~F.isnan(v))


def _present(time_col: str) -> F.Column:
    v = F.col("valor")
    return F.when(v.isNotNull() & ~F.isnan(v), F.col(time_col))


def latest_metric(long: DataFrame, keys: Sequence[str], time_col: str = "mes_ref") -> DataFrame:
    """Latest non-null value of each (keys, metric) and its reference.

    A pair with no value at all is kept with NULL value and NULL reference.
    One partial+final aggregation; ``max_by`` ignores rows whose ordering
    is NULL, i.e. the missing observations.
    """
    present = _present(time_col)
    return (long.groupBy(*keys, "metric")
                .agg(F.max_by("valor", present).alias("valor"),
                     F.max(present).alias(time_col)))


def latest_metric_change(long: DataFrame, keys: Sequence[str], time_col: str = "mes_ref") -> DataFrame:
    """Latest non-null value, its change to the previous non-null value, and
    the reference. The change is NULL with a single observation.

    Rows are ranked with present values first, newest first; keeping rank
    <= 2 lets Catalyst apply a ``WindowGroupLimit`` before the shuffle, so at
    most two rows per pair and map task are shuffled.
    """
    v = F.col("valor")
    missing = (v.isNull() | F.isnan(v)).cast("int")
    w = Window.partitionBy(*keys, "metric").orderBy(missing.asc(), F.col(time_col).desc())
    top2 = long.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= 2)
    present = _present(time_col)
    out = top2.groupBy(*keys, "metric").agg(
        F.max_by("valor", present).alias("valor"),
        F.min_by("valor", present).alias("_prev"),
        F.count(present).alias("_n"),
        F.max(present).alias(time_col),
    )
    change = F.when(F.col("_n") == 2, F.col("valor") - F.col("_prev"))
    return out.select(*keys, "metric", "valor", change.alias("variacao"), time_col)


def last_n(df: DataFrame, n: int | None, keys: Sequence[str] = (), time_col: str = "mes_ref") -> DataFrame:
    """The ``n`` newest rows (of each key); ``None`` keeps everything.

    Without keys this is a top-k (``TakeOrderedAndProject``); with keys a
    rank-limited window. Output order is not part of the result; sort at
    the edge.
    """
    if n is None:
        return df
    if not keys:
        return df.orderBy(F.col(time_col).desc()).limit(n)
    w = Window.partitionBy(*keys).orderBy(F.col(time_col).desc())
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= n).drop("_rk")


def newest_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """``ORDER BY order DESC LIMIT n`` with a unique tie-break in ``order``."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def missing_by_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count of missing values (NULL or NaN) per column, only columns that have any.

    One aggregation pass computes every count; the single result row is
    then unpivoted to ``(coluna, valores_ausentes)``.
    """
    cols = list(columns or df.columns)
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}
    counts = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c) if c in floating else F.col(c).isNull())
                      .alias(c) for c in cols])
    long = counts.unpivot([], cols, "coluna", "valores_ausentes")
    return long.filter(F.col("valores_ausentes") > 0)


def latest_reference(df: DataFrame, time_col: str = "mes_ref") -> DataFrame:
    """Newest reference month and its ``MM/yyyy`` label."""
    return df.agg(F.max(time_col).alias(time_col)).withColumn(
        "referencia", format_reference(F.col(time_col)))
