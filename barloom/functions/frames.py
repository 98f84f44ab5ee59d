"""Window specifications along a company's bars.

Functions rather than constants: a specification can only be built once a
session is running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_date() -> WindowSpec:
    return Window.partitionBy("company_name").orderBy("Date")


def newest_first() -> WindowSpec:
    return Window.partitionBy("company_name").orderBy(F.col("Date").desc())


# Helper column of the yearly windows. It is a column rather than an expression
# in the window, so that stacked windows see one key and share one shuffle.
YEAR = "_year"


def dated(bars: DataFrame) -> DataFrame:
    """Bars that have a company and a date; others have no place along a window."""
    return bars.filter(F.col("company_name").isNotNull() & F.col("Date").isNotNull())


def with_year(bars: DataFrame) -> DataFrame:
    """Bars that have a company and a date, with their year."""
    return dated(bars).withColumn(YEAR, F.year("Date"))


def in_year() -> WindowSpec:
    """All bars of a company's calendar year."""
    return Window.partitionBy("company_name", YEAR)


def tie_order(bars: DataFrame) -> list[str]:
    """The columns that put bars of one company and day in order, as far as ``bars`` has them."""
    return [name for name in ("Open", "High", "Low", "Close", "Volume") if name in bars.columns]


def by_date_in_year() -> WindowSpec:
    """Along a company's calendar year; starts afresh each January."""
    return in_year().orderBy("Date")
