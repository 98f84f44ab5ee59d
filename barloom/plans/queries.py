"""Every operator as a query over the given tables.

Bars are derived from all rows of a table: from ``lineitem`` by status (few
symbols, many trades in each bar) and by supplier (many symbols, about one trade
in each bar), and from ``events`` by type. Results are rounded here, never
inside an operator.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import operators as op
from barloom.sources import bars_from_trades

# Parameters shared with the SQL twins.
STATUSES = ("A-F", "A-O", "N-F", "N-O", "R-F", "R-O")
CHOSEN = ("A-F", "N-O")
CHOSEN_YEARS = (1997, 1999)
ALL_DATES = ("1900-01-01", "2199-12-31")  # all bars that the tables can give
PLACES = 6

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lineitem_bars(spark: SparkSession, sf_dir: str, symbol) -> DataFrame:
    return bars_from_trades(
        table(spark, sf_dir, "lineitem"),
        symbol=symbol,
        day=F.col("l_shipdate"),
        price=F.col("l_extendedprice"),
        quantity=F.col("l_quantity"),
        order_by=["l_orderkey", "l_linenumber"],
    )


def status_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_bars(spark, sf_dir, F.concat_ws("-", "l_returnflag", "l_linestatus"))


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_bars(spark, sf_dir, F.col("l_suppkey").cast("string"))


def ragged_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``lineitem`` a bar of its own: days repeat, some bars lack company or date."""
    trades = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    return trades.select(
        F.when(F.col("l_linenumber") != 7, F.concat_ws("-", "l_returnflag", "l_linestatus")).alias("company_name"),
        F.when(F.col("l_tax") < 0.075, F.to_date("l_shipdate")).alias("Date"),
        price.alias("Open"),
        (price + F.col("l_quantity")).alias("High"),
        (price - price * F.col("l_discount")).alias("Low"),
        (price - price * F.col("l_tax")).alias("Close"),
        F.col("l_quantity").cast("bigint").alias("Volume"),
    )


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_trades(
        table(spark, sf_dir, "events"),
        symbol=F.col("event_type"),
        day=F.col("ts"),
        price=F.col("value"),
        quantity=F.lit(1),
        order_by=["event_id"],
        unique_order=True,
    )


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Doubles rounded for comparison across engines."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(F.col(f"`{name}`"), places) for name in doubles})


def _over(source: Callable[[SparkSession, str], DataFrame], operator) -> Query:
    return lambda spark, sf_dir: rounded(operator(source(spark, sf_dir)))


def _table_source(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: table(spark, sf_dir, name)


def _changes(bars: DataFrame) -> DataFrame:
    return op.price_changes(bars, "1997-01-01", "1998-12-31")


def _all_changes(bars: DataFrame) -> DataFrame:
    return op.price_changes(bars, *ALL_DATES)


def _series(bars: DataFrame, company: str) -> DataFrame:
    return op.select_bars(bars, company).select("Date", F.col("Close").alias("Value"))


# Operators over the bars by status.
STATUS_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    # whole table
    "num_observations": op.num_observations,
    "describe_numeric": op.describe_numeric,
    "describe_by_company": lambda b: op.describe_numeric(b, by="company_name"),
    "missing_values": op.missing_values,
    "missing_values_price_changes": lambda b: op.missing_values(_all_changes(b)),
    "correlation_matrix": op.correlation_matrix,
    "correlation_matrix_price_changes": lambda b: op.correlation_matrix(_all_changes(b)),
    "pair_correlation": lambda b: op.pair_correlation(b, combinations(STATUSES, 2)),
    "series_correlation": lambda b: op.series_correlation(*(_series(b, c) for c in CHOSEN)),
    "distinct_companies": op.distinct_companies,
    "distinct_years": op.distinct_years,
    "distinct_years_by_company": lambda b: op.distinct_years(b, by_company=True),
    "available_dates": op.available_dates,
    "date_coverage": op.date_coverage,
    "date_coverage_overall": lambda b: op.date_coverage(b, by_company=False),
    "deduce_period": lambda b: op.period_since(b, "1998-07-01"),
    "sampling_period": op.sampling_period,
    # filters and periods
    "filter_company_year": lambda b: op.select_bars(b, CHOSEN, CHOSEN_YEARS),
    "avg_prices_year": lambda b: op.average_prices(b, "Year"),
    "avg_prices_month": lambda b: op.average_prices(b, "Month"),
    "avg_prices_week": lambda b: op.average_prices(b, "Week"),
    "range_change": lambda b: op.range_change(b, "1998-12-31", "1999-12-30"),
    # returns
    "daily_return": op.with_daily_return,
    "daily_return_series": lambda b: op.daily_return_series(b, CHOSEN, CHOSEN_YEARS),
    "avg_return_year": lambda b: op.average_return(b, "Year"),
    "avg_return_month": lambda b: op.average_return(b, "Month"),
    "avg_return_week": lambda b: op.average_return(b, "Week"),
    "avg_return_month_selected": lambda b: op.average_return(b, "Month", CHOSEN, CHOSEN_YEARS),
    "highest_daily_return": op.highest_daily_return,
    "highest_daily_return_overall": lambda b: op.highest_daily_return(b, per_year=False),
    "return_rate_year": lambda b: op.return_rate(b, "1999-03-05", "Year"),
    "return_rate_month": lambda b: op.return_rate(b, "1999-03-05", "Month"),
    "return_rate_week": lambda b: op.return_rate(b, "1999-03-05", "Week"),
    "return_rate_week_new_year": lambda b: op.return_rate(b, "2001-01-01", "Week"),
    "return_rate_labelled": lambda b: op.return_rate_labelled(b, "1999-03-05", "Month"),
    # windows
    "first_last_rows": op.first_last_rows,
    "price_changes": _changes,
    "moving_average_asof": lambda b: op.moving_average_asof(b, "2000-01-01", 20),
    "moving_average_asof_open": lambda b: op.moving_average_asof(b, "1998-02-10", 50, "Open"),
    "moving_average_rolling": lambda b: op.moving_average_rolling(b, 5),
    # indicators and levels
    "rsi": op.rsi,
    "rsi_signal": op.rsi_signal,
    "price_changes_by_span": lambda b: op.price_changes(b, "1997-01-01", "1998-12-31", span_days=90),
    "moving_average_rolling_by_span": lambda b: op.moving_average_rolling(b, 5, span_days=365),
    "bollinger_bands": lambda b: op.bollinger_bands(b, "2000-01-01", 20, unique_days=True),
    "bollinger_bands_open": lambda b: op.bollinger_bands(b, "1998-02-10", 50, "Open", unique_days=True),
    "bollinger_bands_by_day": lambda b: op.bollinger_bands(b, "2000-01-01", 20),
    "money_flow_index": op.money_flow_index,
    "mfi_signal": op.mfi_signal,
    "support_resistance": op.support_resistance,
    "fibonacci_levels": op.fibonacci_levels,
    "fibonacci_levels_overall": lambda b: op.fibonacci_levels(b, per_year=False),
    "fibonacci_overlay": op.fibonacci_overlay,
    "volume_ratio": lambda b: op.volume_ratio(b, "1999-06-30", "1999-01-01", "1999-12-31"),
    # wide reports
    "price_series_wide": lambda b: op.price_series_wide(b, STATUSES, "Close"),
    "price_series_wide_open": lambda b: op.price_series_wide(b, CHOSEN, "Open", CHOSEN_YEARS),
    "avg_return_wide": lambda b: op.average_return_wide(b, STATUSES, "Month"),
    "avg_return_wide_week": lambda b: op.average_return_wide(b, CHOSEN, "Week", CHOSEN_YEARS),
}

# The windowed operators again over many symbols with gaps between their bars.
SUPPLIER_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "supplier_daily_return": op.with_daily_return,
    "supplier_describe_by_company": lambda b: op.describe_numeric(b, by="company_name"),
    "supplier_avg_return_week": lambda b: op.average_return(b, "Week"),
    "supplier_highest_daily_return": op.highest_daily_return,
    "supplier_return_rate_labelled": lambda b: op.return_rate_labelled(b, "1999-03-05", "Year"),
    "supplier_first_last_rows": op.first_last_rows,
    "supplier_price_changes": _changes,
    "supplier_moving_average_asof": lambda b: op.moving_average_asof(b, "2000-01-01", 20),
    "supplier_moving_average_rolling": lambda b: op.moving_average_rolling(b, 5),
    "supplier_rsi": op.rsi,
    "supplier_price_changes_by_span": lambda b: op.price_changes(b, "1997-01-01", "1998-12-31", span_days=30),
    "supplier_moving_average_rolling_by_span": lambda b: op.moving_average_rolling(b, 5, span_days=30),
    "supplier_bollinger_bands": lambda b: op.bollinger_bands(b, "2000-01-01", 20, unique_days=True),
    "supplier_money_flow_index": op.money_flow_index,
    "supplier_support_resistance": op.support_resistance,
    "supplier_fibonacci_overlay": op.fibonacci_overlay,
    "supplier_bar_spacing": op.bar_spacing,
    "supplier_sampling_period": op.sampling_period,
}

# Bars as they may come: repeated days, no company, no date.
RAGGED_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "ragged_pair_correlation": lambda b: op.pair_correlation(b, combinations(STATUSES, 2)),
    "ragged_highest_daily_return": op.highest_daily_return,
    "ragged_first_last_rows": lambda b: op.first_last_rows(b, unique_days=False),
    "ragged_moving_average_asof": lambda b: op.moving_average_asof(b, "2000-01-01", 20),
    "ragged_bollinger_bands": lambda b: op.bollinger_bands(b, "2000-01-01", 20),
}

EVENT_QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "event_bars": lambda b: b,
    "event_daily_return": op.with_daily_return,
    "event_avg_prices_week": lambda b: op.average_prices(b, "Week"),
    "event_rsi": op.rsi,
    "event_money_flow_index": op.money_flow_index,
    "event_support_resistance": op.support_resistance,
}

# Profiles run on any table; the operator sees whatever columns there are.
TABLE_QUERIES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "describe_numeric_lineitem": ("lineitem", op.describe_numeric),
    "describe_numeric_events_by_type": ("events", lambda t: op.describe_numeric(t, by="event_type")),
    "correlation_matrix_lineitem": ("lineitem", op.correlation_matrix),
    "missing_values_documents": ("documents", op.missing_values),
}


def all_queries() -> dict[str, Query]:
    queries = {name: _over(status_bars, f) for name, f in STATUS_QUERIES.items()}
    queries |= {name: _over(supplier_bars, f) for name, f in SUPPLIER_QUERIES.items()}
    queries |= {name: _over(ragged_bars, f) for name, f in RAGGED_QUERIES.items()}
    queries |= {name: _over(event_bars, f) for name, f in EVENT_QUERIES.items()}
    queries |= {name: _over(_table_source(t), f) for name, (t, f) in TABLE_QUERIES.items()}
    return queries
