"""RSI, Bollinger bands and the money flow index.

RSI and money flow start afresh each January, so their windows are per company
and year: 366 bars in a partition if each day has one bar, and one company's
history is spread over the cluster. Bars without company or date belong to no
year and are left out.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.frames import YEAR, by_date_in_year, dated, newest_first, tie_order, with_year
from barloom.functions.prices import ratio, typical_price
from barloom.operators.filters import before_date, select_bars
from barloom.operators.windows import latest_days
from barloom.schema import check_count, check_price_type


def _index(gains: Column, losses: Column) -> Column:
    """Gains against losses on a scale of 0 to 100; NULL without losses."""
    return 100 - ratio(F.lit(100), 1 + ratio(gains, losses))


def rsi(
    bars: DataFrame,
    companies: str | Iterable[str] | None = None,
    years: int | Iterable[int] | None = None,
    window_size: int = 14,
) -> DataFrame:
    """Adds ``RSI`` over the current bar and ``window_size`` bars before it.

    The first bar of a year has no move and counts as zero gain and loss.
    """
    check_count("window_size", window_size)
    frame = by_date_in_year().rowsBetween(-window_size, Window.currentRow)
    move = F.col("_move")
    moves = with_year(select_bars(bars, companies, years)).withColumn(
        "_move", F.col("Close") - F.lag("Close").over(by_date_in_year())
    )

    def mean(amount: Column) -> Column:
        return F.sum(amount).over(frame) / window_size

    gains = mean(F.when(move > 0, move).otherwise(0.0))
    losses = mean(F.when(move < 0, -move).otherwise(0.0))
    return moves.withColumn("RSI", _index(gains, losses)).drop("_move", YEAR)


def bollinger_bands(
    bars: DataFrame,
    start: date | str,
    n: int,
    price_type: str = "Close",
    companies: str | Iterable[str] | None = None,
    *,
    unique_days: bool = False,
) -> DataFrame:
    """Bands over the ``n`` latest dates before ``start``.

    The mean and deviation at a date cover that date and the *newer* ones kept,
    so the newest date stands alone; one bar has no deviation. Adds ``rank``,
    ``moving_average``, ``std_dev``, ``upper_band`` and ``lower_band``. Where
    dates repeat, all bars of a date count and share their values, and the
    newest ``n + 1`` bars of a company are returned; bars of one day follow each
    other by Open, High, Low, Close and Volume, NULL first.

    Each day is first summed up in every task, so a window holds one row per
    day however many bars it has. Where a company has one bar a day, say
    ``unique_days``: bars are then ranked as they are, in a single shuffle.
    """
    check_price_type(price_type)
    chosen = select_bars(bars, companies)
    centre, spread = F.col("moving_average"), 2 * F.col("std_dev")
    if unique_days:
        found = latest_days(chosen, start, n).withColumns(
            {
                "moving_average": F.avg(price_type).over(newest_first()),
                "std_dev": F.stddev_samp(price_type).over(newest_first()),
            }
        )
    else:
        check_count("n", n)
        before = dated(before_date(chosen, start))
        ties = [F.asc_nulls_first(name) for name in tie_order(before)]
        row = F.row_number().over(newest_first().orderBy(F.desc("Date"), *ties))
        newest = before.withColumn("_row", row).filter(F.col("_row") <= n + 1).drop("_row")
        found = newest.join(_days_back(before, n, price_type), ["company_name", "Date"])
        found = found.select(*bars.columns, "rank", "moving_average", "std_dev")
    return found.withColumns({"upper_band": centre + spread, "lower_band": centre - spread})


def _days_back(bars: DataFrame, n: int, price_type: str) -> DataFrame:
    """``(company_name, Date, rank, moving_average, std_dev)`` of the ``n`` latest dates.

    Sums run over days, as differences from the newest day's mean, which keeps
    their squares small.
    """
    days = bars.groupBy("Date", "company_name").agg(
        F.count(price_type).alias("_n"), F.avg(price_type).alias("_mean"), F.var_pop(price_type).alias("_var")
    )
    latest = days.withColumn("rank", F.row_number().over(newest_first())).filter(F.col("rank") <= n)
    placed = latest.withColumn("_from", F.first("_mean", ignorenulls=True).over(newest_first()))
    off, known = F.col("_mean") - F.col("_from"), F.col("_n")

    def total(amount: Column) -> Column:
        return F.sum(F.coalesce(amount, F.lit(0.0))).over(newest_first())

    sums = placed.withColumns(
        {"_bars": F.sum("_n").over(newest_first()), "_sum": total(known * off), "_squares": total(known * (F.col("_var") + off * off))}
    )
    mean = ratio(F.col("_sum"), F.col("_bars"))
    variance = ratio(F.greatest(F.col("_squares") - F.col("_sum") * mean, F.lit(0.0)), F.col("_bars") - 1)
    deviation = F.when(F.col("_bars") > 1, F.sqrt(variance))
    return sums.select(
        "company_name", "Date", "rank", (F.col("_from") + mean).alias("moving_average"), deviation.alias("std_dev")
    )


def money_flow_index(
    bars: DataFrame,
    companies: str | Iterable[str] | None = None,
    years: int | Iterable[int] | None = None,
) -> DataFrame:
    """Adds ``Money_Flow_Index``, cumulative from the start of the year.

    NULL until the typical price first falls; a NaN input shows as 50.
    """
    price, before = F.col("_price"), F.col("_before")
    flow = price * F.col("Volume")
    prices = (
        with_year(select_bars(bars, companies, years))
        .withColumn("_price", typical_price())
        .withColumn("_before", F.lag("_price").over(by_date_in_year()))
    )

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, flow).otherwise(0.0)).over(by_date_in_year())

    return (
        prices.withColumn("_index", _index(total(price > before), total(price < before)))
        .withColumn("Money_Flow_Index", F.when(F.isnan("_index"), 50.0).otherwise(F.col("_index")))
        .drop("_price", "_before", "_index", YEAR)
    )
