"""Daily returns and returns over a past period."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.calendar import in_previous_period
from barloom.functions.prices import daily_return, ratio
from barloom.operators.filters import select_bars
from barloom.schema import named

# Parts that the bars of a year are dealt to, by company and date.
SLICES = 64


def with_daily_return(bars: DataFrame) -> DataFrame:
    """Adds ``Daily_Return``, in percent."""
    return bars.withColumn("Daily_Return", daily_return())


def daily_return_series(
    bars: DataFrame,
    companies: str | Iterable[str] | None = None,
    years: int | Iterable[int] | None = None,
) -> DataFrame:
    """``(Date, Daily_Return, company_name, year)`` of the selected bars."""
    return with_daily_return(select_bars(bars, companies, years)).select(
        "Date", "Daily_Return", "company_name", F.year("Date").alias("year")
    )


def highest_daily_return(bars: DataFrame, *, per_year: bool = True) -> DataFrame:
    """Bars whose return is the highest of their year, or of the table; ties
    are all kept.

    The table is read once. Each task keeps the bars that no other of its year
    and slice beats; the slices, taken from company and date, spread a year of
    equal returns over many tasks. The highest of what is left, one row per
    calendar year, is what makes the broadcast safe at any size of ``bars``.
    """
    keys = ["Year"] if per_year else []
    returns = with_daily_return(bars)
    if per_year:
        returns = returns.withColumn("Year", F.year("Date"))
    slices = F.pmod(F.xxhash64("company_name", "Date"), F.lit(SLICES))
    best = Window.partitionBy(*keys, "_slice").orderBy(F.desc("Daily_Return"))
    whole = returns.dropna(subset=[*keys, "Daily_Return"]).withColumn("_slice", slices)
    left = whole.withColumn("_place", F.rank().over(best)).filter("_place = 1")
    # The digest takes every column of the few rows left, so that both uses of them read one shuffle.
    digest = F.bit_xor(F.xxhash64(*map(named, bars.columns)))
    highest = left.groupBy(*keys).agg(F.max("Daily_Return").alias("Daily_Return"), digest.alias("_digest"))
    same = F.broadcast(highest.filter(F.col("_digest").isNotNull()))
    return left.join(same, [*keys, "Daily_Return"], "left_semi").select(returns.columns)


def return_rate(bars: DataFrame, start: date | str, period: str) -> DataFrame:
    """Return of every company over the year, month or week before ``start``.

    A fraction: last close against first open, first and last by ``Date``.
    """
    opening = F.min_by("Open", "Date")
    closing = F.max_by("Close", "Date")
    return (
        bars.filter(in_previous_period(start, period))
        .groupBy("company_name")
        .agg(ratio(closing - opening, opening).alias("Return_Rate"))
    )
