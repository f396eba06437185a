"""Numeric column builders: rounding, annualization, Fisher rate.

Every builder takes and returns a ``Column`` so it stays inside whole-stage
codegen; nothing here runs Python per row.

Rounding is Spark's ``round`` and aggregates that the reference leaves
unrounded stay unrounded. Two engines that add in another order differ in the
last bits, so a comparison of whole results needs one more step: inside
``comparison_rounding()`` (used by the registered queries alone) the builders
round through ``comparable`` instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference for right results):
#   business days per year used to annualize a daily rate: 252
#   rounding of changes, moving statistics and sums: 4 digits
#   rounding of volatility and annualized rate: 6 digits
BUSINESS_DAYS_PER_YEAR = 252
DIGITS_VALUE = 4
DIGITS_FINE = 6

# Digits compared of aggregates that are unrounded otherwise.
DIGITS_COMPARED = 8

_comparing: ContextVar[bool] = ContextVar("comparing", default=False)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@contextmanager
def comparison_rounding() -> Iterator[None]:
    """Columns built inside round as an SQL engine can repeat (see ``comparable``)."""
    token = _comparing.set(True)
    try:
        yield
    finally:
        _comparing.reset(token)


def comparable(c: Column | str, digits: int) -> Column:
    """Round half-up through ``decimal(38,10)``, for comparisons only.

    Values within a few bits of a tie then round alike in both engines; a
    value that does not fit (or is not finite) stays as it is.
    """
    x = _col(c)
    return F.coalesce(F.round(x.try_cast("decimal(38,10)"), digits).cast("double"), x)


def rounded(c: Column | str, digits: int) -> Column:
    """The value rounded to ``digits``."""
    return comparable(c, digits) if _comparing.get() else F.round(_col(c), digits)


def unrounded(c: Column | str, compared: int = DIGITS_COMPARED) -> Column:
    """An aggregate in full precision (cut to ``compared`` digits in a comparison)."""
    return comparable(c, compared) if _comparing.get() else _col(c)


def annualize(rate: Column | str, periods: int = BUSINESS_DAYS_PER_YEAR,
              digits: int = DIGITS_FINE) -> Column:
    """Compound a per-period percentage rate: ``(1 + r/100)^periods - 1``."""
    r = _col(rate)
    return rounded(F.pow(F.lit(1.0) + r / F.lit(100.0), F.lit(float(periods))) - F.lit(1.0), digits)


def fisher_real_rate(nominal_pct: Column | str, inflation_pct: Column | str,
                     digits: int = DIGITS_VALUE) -> Column:
    """Fisher real rate in percent: ``((1+a/100)/(1+b/100) - 1) * 100``.

    NULL when either side is NULL, and NULL (not an error) when the
    inflation side is exactly -100 %.
    """
    a = _col(nominal_pct)
    b = _col(inflation_pct)
    ratio = F.try_divide(F.lit(1.0) + a / F.lit(100.0), F.lit(1.0) + b / F.lit(100.0))
    return rounded((ratio - F.lit(1.0)) * F.lit(100.0), digits)


def is_valid_number(c: Column | str) -> Column:
    """True for values that are neither NULL nor NaN."""
    x = _col(c)
    return x.isNotNull() & ~F.isnan(x)
