"""Calendar predicates and labels.

Year and month conditions are written as date ranges: ``year(Date) = y`` stays
behind the scan, while a range on ``Date`` is pushed down into Parquet.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.schema import as_date, as_list, check_period

# Spacings in days that have a name of their own.
NAMED_SPACINGS = {1: "1 day", 7: "1 week", 30: "1 month", 365: "1 year"}


def in_years(years: int | Iterable[int], day: str = "Date") -> Column:
    """``year(day)`` is one of ``years``, as one range per run of years."""
    runs = _runs(int(year) for year in as_list(years))
    return _in_ranges(((date(a, 1, 1), date(b, 12, 31)) for a, b in runs), day)


def on_days(days: Iterable[date], day: str = "Date") -> Column:
    """``day`` is one of ``days``, as one range per run of days. Unlike an
    ``IN``, this reaches the scan below a cast from timestamps as well."""
    runs = _runs(d.toordinal() for d in days)
    return _in_ranges(((date.fromordinal(a), date.fromordinal(b)) for a, b in runs), day)


def _runs(numbers: Iterable[int]) -> list[list[int]]:
    """First and last of each run of consecutive numbers."""
    runs: list[list[int]] = []
    for number in sorted(set(numbers)):
        if runs and runs[-1][1] == number - 1:
            runs[-1][1] = number
        else:
            runs.append([number, number])
    return runs


def _in_ranges(ranges: Iterable[tuple[date, date]], day: str) -> Column:
    conditions = [F.col(day).between(F.lit(first), F.lit(last)) for first, last in ranges]
    return reduce(Column.__or__, conditions) if conditions else F.lit(False)


def iso_week_days(year: int, week: int) -> list[date]:
    """Days of a *calendar* year whose ISO week number is ``week``.

    Near New Year this is not one run of days: in calendar year 2000, week 52
    holds 1 and 2 January as well as the last days of December.
    """
    new_year = date(year, 1, 1)
    days = (new_year + timedelta(days=n) for n in range(366))
    return [d for d in days if d.year == year and d.isocalendar().week == week]


def in_previous_period(start: date | str, period: str, day: str = "Date") -> Column:
    """``day`` lies in the year, month or week before ``start``'s own."""
    check_period(period)
    start = as_date(start)
    if period == "Year":
        return in_years(start.year - 1, day)
    if period == "Month":
        last = start.replace(day=1) - timedelta(days=1)
        return F.col(day).between(F.lit(last.replace(day=1)), F.lit(last))
    back = start - timedelta(weeks=1)
    days = iso_week_days(back.year, back.isocalendar().week)
    return on_days([d for d in days if d < start], day)


def period_columns(period: str, day: str = "Date") -> list[Column]:
    """Grouping columns of a period. Weeks pair the calendar year with the ISO
    week number, so 2018-12-31 belongs to (2018, 1)."""
    check_period(period)
    columns = [F.year(day).alias("Year")]
    if period == "Month":
        columns.append(F.month(day).alias("Month"))
    elif period == "Week":
        columns.append(F.weekofyear(day).alias("Week"))
    return columns


def period_label(start: Column, end: Column) -> Column:
    """Wording of the time between two dates.

    A few spacings have a name; any other is split by floor division into weeks
    and days, so a negative difference counts back from the week before.
    """
    gap = F.datediff(end, start)
    weeks = F.floor(gap / 7)
    days = F.pmod(gap, F.lit(7))
    label = reduce(
        lambda chain, item: chain.when(gap == item[0], F.lit(item[1])),
        NAMED_SPACINGS.items(),
        F.when(gap.isNull(), F.lit(None).cast("string")),
    )
    return (
        label.when((weeks > 0) & (days > 0), F.format_string("%d weeks and %d days", weeks, days))
        .when(weeks > 0, F.format_string("%d weeks", weeks))
        .otherwise(F.format_string("%d days", days))
    )
