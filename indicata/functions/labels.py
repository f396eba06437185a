"""Threshold labels (rate level, inflation pressure, FX trend).

Thresholds are parameters; the defaults are the reference's. A NULL input
falls through to the last label, exactly like a ``when`` chain with an
``otherwise``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference for right results).
# Rate level: below 6 baixo, below 10 moderado, below 14 alto, else muito_alto.
RATE_LEVEL_BANDS = ((6.0, "baixo"), (10.0, "moderado"), (14.0, "alto"))
RATE_LEVEL_TOP = "muito_alto"
# Inflation pressure: below 0 deflacao, below 0.3 controlada, below 0.6 moderada, else elevada.
PRESSURE_BANDS = ((0.0, "deflacao"), (0.3, "controlada"), (0.6, "moderada"))
PRESSURE_TOP = "elevada"
# FX trend on the rounded daily change: above 0.05 alta, below -0.05 queda, else estavel.
TREND_UP = 0.05
TREND_DOWN = -0.05
TREND_LABELS = ("alta", "queda", "estavel")


def classify_below(c: Column | str, bands: Sequence[tuple[float, str]], top: str) -> Column:
    """``when(c < t1, l1).when(c < t2, l2)...otherwise(top)``."""
    x = F.col(c) if isinstance(c, str) else c
    expr = None
    for threshold, label in bands:
        cond = x < F.lit(float(threshold))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(top) if expr is None else expr.otherwise(top)


def scaled_bands(bands: Sequence[tuple[float, str]], divisor: float) -> tuple[tuple[float, str], ...]:
    """Same labels, thresholds divided by ``divisor`` (for a rescaled series)."""
    return tuple((t / divisor, label) for t, label in bands)


def rate_level(c: Column | str, bands=RATE_LEVEL_BANDS, top: str = RATE_LEVEL_TOP) -> Column:
    return classify_below(c, bands, top)


def inflation_pressure(c: Column | str, bands=PRESSURE_BANDS, top: str = PRESSURE_TOP) -> Column:
    return classify_below(c, bands, top)


def fx_trend(change: Column | str, up: float = TREND_UP, down: float = TREND_DOWN) -> Column:
    x = F.col(change) if isinstance(change, str) else change
    rising, falling, flat = TREND_LABELS
    return F.when(x > F.lit(up), rising).when(x < F.lit(down), falling).otherwise(flat)
