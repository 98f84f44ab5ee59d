"""Aggregates by calendar period and between two dates."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import on_days, period_columns
from barloom.functions.prices import ratio
from barloom.operators.filters import select_bars
from barloom.operators.returns import with_daily_return
from barloom.schema import check_range


def average_prices(bars: DataFrame, period: str) -> DataFrame:
    """``Avg_Open`` and ``Avg_Close`` per company and period."""
    return bars.groupBy(*period_columns(period), "company_name").agg(
        F.avg("Open").alias("Avg_Open"), F.avg("Close").alias("Avg_Close")
    )


def average_return(
    bars: DataFrame,
    period: str,
    companies: str | Iterable[str] | None = None,
    years: int | Iterable[int] | None = None,
) -> DataFrame:
    """Mean daily return per company and period, as ``Avg_Return_<period>``."""
    return (
        with_daily_return(select_bars(bars, companies, years))
        .groupBy(*period_columns(period), "company_name")
        .agg(F.avg("Daily_Return").alias(f"Avg_Return_{period}"))
    )


def range_change(bars: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Change of the close from one date to another, absolute and in percent.

    Only companies with a close on both dates have a row; the scan reads only
    those two dates.
    """
    start, end = check_range(start, end)

    def close_on(day: date):
        return F.max(F.when(F.col("Date") == F.lit(day), F.col("Close")))

    change = F.col("end_close") - F.col("start_close")
    return (
        bars.filter(on_days([start, end]))
        .groupBy("company_name")
        .agg(close_on(start).alias("start_close"), close_on(end).alias("end_close"))
        .filter("start_close IS NOT NULL AND end_close IS NOT NULL")
        .withColumn("absolute_change", change)
        .withColumn("percentage_change", ratio(change, F.col("start_close")) * 100)
    )
