"""Text formatting of references, metrics and deltas, as Spark columns.

Numbers are rounded half-up from their shortest decimal form (0.125 is shown
as 0.13 and 2.675 as 2.68), as a reader expects and SQL engines do; a formatter
that rounds the binary value would show 0.12 and 2.67.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicata.functions.numeric import rounded

# Fixed values (must equal the reference for right results).
NO_REFERENCE = "Sem referência"
NO_DATA = "Sem dados"
REFERENCE_PATTERN = "MM/yyyy"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def two_decimals(c: Column | str) -> Column:
    """Text of a number with exactly two decimals, NULL stays NULL; a number
    beyond 36 digits (or not finite) is shown as it is."""
    x = rounded(c, 2)
    return F.coalesce(x.try_cast("decimal(38,2)").cast("string"), x.cast("string"))


def format_reference(c: Column | str) -> Column:
    """``MM/yyyy`` of a date, ``Sem referência`` when missing."""
    return F.coalesce(F.date_format(_col(c), REFERENCE_PATTERN), F.lit(NO_REFERENCE))


def format_metric(c: Column | str, prefix: str = "", suffix: str = "") -> Column:
    """``prefix + value(2 decimals) + suffix``, ``Sem dados`` when missing."""
    body = F.concat(F.lit(prefix), two_decimals(c), F.lit(suffix))
    return F.coalesce(body, F.lit(NO_DATA))


def format_delta(c: Column | str, suffix: str = "") -> Column:
    """Signed change with two decimals (``+0.12 p.p.``); NULL when missing."""
    x = _col(c)
    sign = F.when(x >= 0, F.lit("+")).otherwise(F.lit(""))
    return F.concat(sign, two_decimals(x), F.lit(suffix))
