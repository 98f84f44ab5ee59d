"""Labelled and wide results for reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import period_columns
from barloom.functions.labels import mfi_label, return_label, rsi_label
from barloom.operators.filters import select_bars
from barloom.operators.indicators import money_flow_index, rsi
from barloom.operators.returns import return_rate, with_daily_return
from barloom.schema import as_list, check_price_type


def rsi_signal(
    bars: DataFrame,
    companies: str | Iterable[str] | None = None,
    years: int | Iterable[int] | None = None,
    window_size: int = 14,
) -> DataFrame:
    """RSI with ``signal``: overbought, oversold or neutral."""
    return rsi(bars, companies, years, window_size).withColumn("signal", rsi_label(F.col("RSI")))


def mfi_signal(
    bars: DataFrame,
    companies: str | Iterable[str] | None = None,
    years: int | Iterable[int] | None = None,
) -> DataFrame:
    """Money flow index with ``signal``: overbought, oversold or neutral."""
    flows = money_flow_index(bars, companies, years)
    return flows.withColumn("signal", mfi_label(F.col("Money_Flow_Index")))


def return_rate_labelled(bars: DataFrame, start: date | str, period: str) -> DataFrame:
    """Return rates with ``label``: highest, negative, positive or none.

    The highest rate is a scalar subquery, one number for the whole table.
    """
    rates = return_rate(bars, start, period)
    highest = rates.agg(F.max(F.nanvl("Return_Rate", F.lit(None)))).scalar()
    return rates.withColumn("label", return_label(F.col("Return_Rate"), highest))


def _wide(df: DataFrame, keys: list[Column], columns: dict[str, Column]) -> DataFrame:
    """One aggregate per wide column; the columns asked for bound their number."""
    aggregates = [value.alias(name) for name, value in columns.items()]
    if not aggregates:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*aggregates)


def price_series_wide(
    bars: DataFrame,
    companies: Sequence[str],
    price_type: str = "Close",
    years: int | Iterable[int] | None = None,
) -> DataFrame:
    """One row per date, one ``"<company> <price type>"`` column per company."""
    check_price_type(price_type)
    columns = {
        f"{name} {price_type}": F.max(F.when(F.col("company_name") == name, F.col(price_type)))
        for name in as_list(companies)
    }
    return _wide(select_bars(bars, companies, years), [F.col("Date")], columns)


def average_return_wide(
    bars: DataFrame,
    companies: Sequence[str],
    period: str,
    years: int | Iterable[int] | None = None,
) -> DataFrame:
    """One row per period, one ``"<company> Avg_Return"`` column per company."""
    columns = {
        f"{name} Avg_Return": F.avg(F.when(F.col("company_name") == name, F.col("Daily_Return")))
        for name in as_list(companies)
    }
    returns = with_daily_return(select_bars(bars, companies, years))
    return _wide(returns, period_columns(period), columns)
