"""Row filters shared by the operators. ``None`` means no restriction; an empty
list selects nothing."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import in_years
from barloom.schema import as_date, as_list, check_range


def select_bars(
    bars: DataFrame,
    companies: str | Iterable[str] | None = None,
    years: int | Iterable[int] | None = None,
) -> DataFrame:
    """Bars of the given companies and years."""
    if companies is not None:
        bars = bars.filter(F.col("company_name").isin(as_list(companies)))
    if years is not None:
        bars = bars.filter(in_years(years))
    return bars


def between_dates(bars: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Bars from ``start`` to ``end``, both included."""
    start, end = check_range(start, end)
    return bars.filter(F.col("Date").between(F.lit(start), F.lit(end)))


def before_date(bars: DataFrame, start: date | str) -> DataFrame:
    """Bars strictly before ``start``."""
    return bars.filter(F.col("Date") < F.lit(as_date(start)))
