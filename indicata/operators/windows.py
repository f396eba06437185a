"""Window indicators over an ordered series.

All windows are partitioned by the series key, never global (a global
``Window.orderBy`` runs in one task). Frames are row frames, as in the
reference: "30 days" means the last 30 observations. Windows are ordered
by ``(ano, data)``: the same order as ``data``, and it lets the
year-to-date window (partitioned by series and year) reuse the sort of
the series window, so the whole silver stage sorts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from indicata.functions.numeric import DIGITS_VALUE, rounded


def series_window(keys: Sequence[str], order: Sequence[str] = ("data",)) -> WindowSpec:
    """Series order; silver passes ``("ano", "data")`` to share one sort with year-to-date."""
    return Window.partitionBy(*keys).orderBy(*order)


def trailing(w: WindowSpec, rows: int) -> WindowSpec:
    """The current row and the ``rows - 1`` before it."""
    return w.rowsBetween(-(rows - 1), Window.currentRow)


def year_to_date_window(keys: Sequence[str], year_col: str = "ano", order: str = "data") -> WindowSpec:
    """From the first observation of the year up to the current one (explicit ROWS frame)."""
    return (Window.partitionBy(*keys, year_col).orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def change(value: Column | str, w: WindowSpec, digits: int = DIGITS_VALUE) -> Column:
    """Difference to the previous observation; NULL on the first one."""
    v = _c(value)
    return rounded(v - F.lag(v, 1).over(w), digits)


def pct_change(value: Column | str, w: WindowSpec, digits: int = DIGITS_VALUE) -> Column:
    """Percent change to the previous observation; NULL on the first one and when it was 0."""
    v = _c(value)
    prev = F.lag(v, 1).over(w)
    return rounded(F.try_divide(v - prev, prev) * F.lit(100.0), digits)


def moving(fn, value: Column | str, w: WindowSpec, rows: int, digits: int = DIGITS_VALUE) -> Column:
    """``fn`` (avg, max, min, stddev, sum) over the trailing ``rows`` observations."""
    return rounded(fn(_c(value)).over(trailing(w, rows)), digits)


def moving_avg(value, w, rows=30, digits=DIGITS_VALUE) -> Column:
    return moving(F.avg, value, w, rows, digits)


def moving_max(value, w, rows=30, digits=DIGITS_VALUE) -> Column:
    return moving(F.max, value, w, rows, digits)


def moving_min(value, w, rows=30, digits=DIGITS_VALUE) -> Column:
    return moving(F.min, value, w, rows, digits)


def moving_stddev(value, w, rows=30, digits=6) -> Column:
    """Sample standard deviation; NULL while the frame holds one row."""
    return moving(F.stddev_samp, value, w, rows, digits)


def rolling_sum(value, w, rows=12, digits=DIGITS_VALUE) -> Column:
    return moving(F.sum, value, w, rows, digits)


def ytd(fn, value: Column | str, keys: Sequence[str], digits: int = DIGITS_VALUE,
        year_col: str = "ano") -> Column:
    """Running ``fn`` from January 1st; restarts every year (lag does not)."""
    return rounded(fn(_c(value)).over(year_to_date_window(keys, year_col)), digits)
