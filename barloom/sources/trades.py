"""Daily bars from a table of trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.schema import BARS


def bars_from_trades(
    trades: DataFrame,
    *,
    symbol: Column,
    day: Column,
    price: Column,
    quantity: Column,
    order_by: Sequence[str],
    unique_order: bool = False,
) -> DataFrame:
    """Roll trades up to one bar per symbol and day.

    ``order_by`` names the columns that put a day's trades in order; ties are
    broken by price, so the result does not depend on row order. The whole
    roll-up is one aggregation that combines on the map side: however many
    trades a symbol has, at most one row per day and map task is shuffled.
    Date conditions on the result pass through it to the scan of ``trades``.

    Spark aggregates over a struct of columns by sorting. Where one number
    orders the trades without ties (a trade id), say ``unique_order``: the
    roll-up then runs as a hash aggregation, in about half the time.
    """
    if unique_order and len(order_by) != 1:
        raise ValueError("unique_order takes exactly one order column")
    ordered = F.struct(*order_by, price.alias("price"))
    if unique_order:
        opening = F.min_by("trade.price", f"trade.{order_by[0]}")
        closing = F.max_by("trade.price", f"trade.{order_by[0]}")
    else:
        opening = F.min("trade").getField("price")
        closing = F.max("trade").getField("price")
    return (
        trades.select(
            symbol.alias("company_name"),
            F.to_date(day).alias("Date"),
            ordered.alias("trade"),
            quantity.alias("quantity"),
        )
        .groupBy("Date", "company_name")  # sorting by a number first is quicker
        .agg(
            opening.alias("Open"),
            F.max("trade.price").alias("High"),
            F.min("trade.price").alias("Low"),
            closing.alias("Close"),
            F.sum("quantity").cast("bigint").alias("Volume"),
        )
        .select(BARS.names)
    )
