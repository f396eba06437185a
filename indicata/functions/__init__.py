"""Column-level builders (pure ``Column -> Column`` functions)."""

from indicata.functions.calendar import month_start, with_calendar_parts
from indicata.functions.formatting import format_delta, format_metric, format_reference, two_decimals
from indicata.functions.labels import fx_trend, inflation_pressure, rate_level
from indicata.functions.numeric import (annualize, comparable, fisher_real_rate, is_valid_number,
                                        rounded, unrounded)

__all__ = [
    "annualize", "comparable", "fisher_real_rate", "format_delta", "format_metric", "format_reference",
    "fx_trend", "inflation_pressure", "is_valid_number", "month_start", "rate_level",
    "rounded", "two_decimals", "unrounded", "with_calendar_parts",
]
