"""Operators: ``f(bars, ...) -> DataFrame``, usable with ``DataFrame.transform``."""

from barloom.operators.correlation import correlation_matrix, pair_correlation, series_correlation
from barloom.operators.filters import before_date, between_dates, select_bars
from barloom.operators.indicators import bollinger_bands, money_flow_index, rsi
from barloom.operators.levels import (
    fibonacci_levels,
    fibonacci_overlay,
    support_resistance,
    volume_ratio,
)
from barloom.operators.periods import average_prices, average_return, range_change
from barloom.operators.profile import (
    available_dates,
    bar_spacing,
    date_coverage,
    describe_numeric,
    distinct_companies,
    distinct_years,
    missing_values,
    num_observations,
    period_since,
    sampling_period,
    schema_listing,
)
from barloom.operators.reports import (
    average_return_wide,
    mfi_signal,
    price_series_wide,
    return_rate_labelled,
    rsi_signal,
)
from barloom.operators.returns import (
    daily_return_series,
    highest_daily_return,
    return_rate,
    with_daily_return,
)
from barloom.operators.windows import (
    first_last_rows,
    latest_days,
    moving_average_asof,
    moving_average_rolling,
    price_changes,
)

__all__ = [
    "available_dates",
    "average_prices",
    "average_return",
    "average_return_wide",
    "bar_spacing",
    "before_date",
    "between_dates",
    "bollinger_bands",
    "correlation_matrix",
    "daily_return_series",
    "date_coverage",
    "describe_numeric",
    "distinct_companies",
    "distinct_years",
    "fibonacci_levels",
    "fibonacci_overlay",
    "first_last_rows",
    "highest_daily_return",
    "latest_days",
    "mfi_signal",
    "missing_values",
    "money_flow_index",
    "moving_average_asof",
    "moving_average_rolling",
    "num_observations",
    "pair_correlation",
    "period_since",
    "price_changes",
    "price_series_wide",
    "range_change",
    "return_rate",
    "return_rate_labelled",
    "rsi",
    "rsi_signal",
    "sampling_period",
    "schema_listing",
    "select_bars",
    "series_correlation",
    "support_resistance",
    "volume_ratio",
    "with_daily_return",
]
