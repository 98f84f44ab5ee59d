import math
from datetime import date

import pytest

from barloom.operators import (
    average_prices,
    average_return,
    daily_return_series,
    first_last_rows,
    highest_daily_return,
    moving_average_asof,
    moving_average_rolling,
    price_changes,
    range_change,
    return_rate,
    with_daily_return,
)
from tests.conftest import bar, closes, column


def test_first_and_last_rows_overlap_in_short_histories(make):
    sizes = {"A": 90, "B": 80, "C": 60, "D": 30}
    bars = make([b for name, n in sizes.items() for b in closes(range(1, n + 1), name)])
    rows = first_last_rows(bars).collect()
    counts = {name: sum(r.company_name == name for r in rows) for name in sizes}
    assert counts == {"A": 80, "B": 80, "C": 80, "D": 60}
    different = {name: len({r.Date for r in rows if r.company_name == name}) for name in sizes}
    assert different == {"A": 80, "B": 80, "C": 60, "D": 30}
    assert not any(r.Close in range(41, 51) for r in rows if r.company_name == "A")
    assert rows[0].__fields__ == bars.columns
    assert sorted(r.Close for r in first_last_rows(bars, 1).collect() if r.company_name == "A") == [1.0, 90.0]


def test_price_changes_are_cut_before_they_are_compared(make):
    bars = make(closes(range(0, 200, 2)) + closes(range(100, 0, -1), "B"))
    changes = price_changes(bars, "2020-01-11", "2020-03-05")
    day = column(changes.filter("company_name = 'A'"), "Price_Diff_Day")
    month = column(changes.filter("company_name = 'A'"), "Price_Diff_Month")
    assert len(day) == 55 and day == [None] + [2.0] * 54
    assert month == [None] * 30 + [60.0] * 25
    assert column(price_changes(bars, "2020-01-11", "2020-03-05", "B"), "Price_Diff_Day")[1] == -1.0


def test_moving_average_as_of_a_date(make):
    bars = make(closes([1, 2, 3, 4, 5, 6]) + closes([10, 20], "B") + closes([5], "C", "2020-02-01"))
    got = {r.company_name: r.moving_average for r in moving_average_asof(bars, "2020-01-06", 3).collect()}
    assert got == {"A": 4.0, "B": 15.0}  # B has two days only, C starts later
    with pytest.raises(ValueError):
        moving_average_asof(bars, "2020-01-06", 3, "Low")


def test_rolling_average_excludes_its_own_bar(make):
    bars = make(closes([1, 2, 3, 4, 5]))
    assert column(moving_average_rolling(bars, 2), "moving_average") == [None, 1.0, 1.5, 2.5, 3.5]


def test_daily_return_of_zero_open_is_null(make):
    bars = make([bar("A", "2020-01-01", 0.0, close=5.0), bar("A", "2020-01-02", 4.0, close=5.0)])
    assert column(with_daily_return(bars), "Daily_Return") == [None, 25.0]
    series = daily_return_series(bars, ["A"], [2020])
    assert series.columns == ["Date", "Daily_Return", "company_name", "year"]


def test_highest_return_keeps_ties(make):
    bars = make(
        [
            bar("A", "2020-01-01", 1.0, close=2.0),
            bar("B", "2020-06-01", 2.0, close=4.0),
            bar("B", "2020-06-02", 2.0, close=3.0),
            bar("C", "2021-01-01", 4.0, close=1.0),
            bar("C", "2021-01-02", 0.0, close=1.0),
        ]
    )
    per_year = highest_daily_return(bars).collect()
    assert {(r.Year, r.company_name, r.Daily_Return) for r in per_year} == {
        (2020, "A", 100.0),
        (2020, "B", 100.0),
        (2021, "C", -75.0),
    }
    assert {r.company_name for r in highest_daily_return(bars, per_year=False).collect()} == {"A", "B"}


def test_average_prices_and_returns_by_period(make):
    bars = make(
        [
            bar("A", "2018-01-03", 1.0, close=2.0),
            bar("A", "2018-12-31", 3.0, close=3.0),
            bar("A", "2019-02-01", 2.0, close=1.0),
        ]
    )
    weeks = {(r.Year, r.Week): (r.Avg_Open, r.Avg_Close) for r in average_prices(bars, "Week").collect()}
    assert weeks == {(2018, 1): (2.0, 2.5), (2019, 5): (2.0, 1.0)}
    months = {(r.Year, r.Month): r.Avg_Return_Month for r in average_return(bars, "Month").collect()}
    assert months == {(2018, 1): 100.0, (2018, 12): 0.0, (2019, 2): -50.0}
    assert average_return(bars, "Year", ["A"], [2018]).first().Avg_Return_Year == 50.0
    assert average_return(bars, "Year", [], [2018]).collect() == []
    for wrong in (average_prices, average_return):
        with pytest.raises(ValueError):
            wrong(bars, "Day")


def test_return_rate_follows_dates_not_row_order(make):
    rows = [
        bar("A", "2020-02-29", 9.0, close=6.0),
        bar("A", "2020-02-01", 4.0, close=5.0),
        bar("A", "2020-01-31", 1.0),
        bar("A", "2020-03-01", 99.0),
        bar("B", "2020-02-10", 0.0, close=6.0),
        bar("C", "2020-04-10", 1.0, close=6.0),
    ]
    for order in (rows, rows[::-1]):
        rates = return_rate(make(order), "2020-03-15", "Month").collect()
        assert {r.company_name: r.Return_Rate for r in rates} == {"A": 0.5, "B": None}


def test_range_change_needs_both_dates(make):
    bars = make(closes([4, 9, 5]) + closes([1, 1], "B") + closes([0, 1, 7], "C"))
    rows = {r.company_name: tuple(r)[1:] for r in range_change(bars, "2020-01-01", "2020-01-03").collect()}
    assert rows == {"A": (4.0, 5.0, 1.0, 25.0), "C": (0.0, 7.0, 7.0, None)}
    same = range_change(bars, date(2020, 1, 1), date(2020, 1, 1)).filter("company_name = 'A'").first()
    assert (same.absolute_change, same.percentage_change) == (0.0, 0.0)


def test_returns_do_not_depend_on_ansi_mode(spark, make):
    bars = make([bar("A", "2020-01-01", 0.0, close=5.0)])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert column(with_daily_return(bars), "Daily_Return") == [None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert math.isclose(with_daily_return(make([bar(close=1.1)])).first().Daily_Return, 10.0)
