"""Price arithmetic. Division goes through ``ratio``: NULL on a zero divisor,
whether or not the session runs in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom)


def daily_return() -> Column:
    """Open-to-close move of one bar, in percent."""
    return ratio(F.col("Close") - F.col("Open"), F.col("Open")) * 100


def typical_price() -> Column:
    return (F.col("High") + F.col("Low") + F.col("Close")) / 3
