"""Calendar parts and month truncation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ntz_literal(value: dt.datetime | dt.date) -> Column:
    """A ``timestamp_ntz`` literal built from text.

    ``F.lit(datetime)`` goes through the Python and session time zones; a
    text literal cast to ``timestamp_ntz`` is the same wall-clock value in
    every session.
    """
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def month_start(c: Column | str) -> Column:
    """First day of the month as a DATE (``trunc(c, 'MM')``)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.trunc(F.to_date(x), "MM")


def with_calendar_parts(df: DataFrame, date_col: str = "data", weekday: bool = False) -> DataFrame:
    """Add ``ano``, ``mes``, ``trimestre`` and optionally ``dia_semana``.

    ``dia_semana`` is Spark's ``dayofweek``: Sunday = 1 ... Saturday = 7.
    """
    d = F.col(date_col)
    cols = {"ano": F.year(d), "mes": F.month(d), "trimestre": F.quarter(d)}
    if weekday:
        cols["dia_semana"] = F.dayofweek(d)
    return df.withColumns(cols)
