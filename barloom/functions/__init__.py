"""Column expressions: each takes columns and returns a column."""

from barloom.functions.calendar import (
    in_previous_period,
    in_years,
    on_days,
    period_columns,
    period_label,
)
from barloom.functions.labels import mfi_label, return_label, rsi_label
from barloom.functions.prices import daily_return, ratio, typical_price

__all__ = [
    "daily_return",
    "in_previous_period",
    "in_years",
    "mfi_label",
    "on_days",
    "period_columns",
    "period_label",
    "ratio",
    "return_label",
    "rsi_label",
    "typical_price",
]
