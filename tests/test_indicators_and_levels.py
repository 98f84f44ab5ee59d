import math
import statistics

import pytest

from barloom.operators import (
    average_return_wide,
    bollinger_bands,
    fibonacci_levels,
    fibonacci_overlay,
    mfi_signal,
    money_flow_index,
    price_series_wide,
    return_rate_labelled,
    rsi,
    rsi_signal,
    support_resistance,
    volume_ratio,
)
from tests.conftest import bar, closes, column, run_of_days


def test_rsi_without_losses_is_null_and_without_gains_zero(make):
    bars = make(closes(range(1, 21), "A") + closes(range(20, 0, -1), "B"))
    assert column(rsi(bars, "A"), "RSI") == [None] * 20
    assert column(rsi(bars, "B"), "RSI") == [None] + [0.0] * 19


def test_rsi_frame_is_fifteen_rows(make):
    values = [100, 50] + [50 + i for i in range(1, 17)]  # one fall on row 2, then rises
    got = column(rsi(make(closes(values))), "RSI")
    assert got[0] is None and got[1] == 0.0
    assert got[15] is not None  # row 16 still sees row 2
    assert got[16] is None  # row 17 does not: no loss in its frame
    assert math.isclose(got[2], 100 - 100 / (1 + 1 / 50))


def test_rsi_window_size_and_signal(make):
    bars = make(closes([10, 9, 20, 30, 29]))
    values = column(rsi(bars, window_size=1), "RSI")
    assert values[:2] == [None, 0.0]
    assert math.isclose(values[2], 100 - 100 / (1 + 11 / 1))
    assert values[3] is None
    signals = column(rsi_signal(bars, window_size=1), "signal")
    assert signals == [None, "oversold", "overbought", None, "overbought"]
    even = make(closes([10, 9, 10]))
    assert column(rsi_signal(even), "signal")[-1] == "neutral"


def test_state_restarts_each_january(make):
    bars = make(closes([10, 9, 8, 7, 9, 6], first="2019-12-29"))  # 3 bars, then 3 in 2020
    assert column(rsi(bars), "RSI")[3] is None and column(rsi(bars), "RSI")[2] == 0.0
    assert column(money_flow_index(bars), "Money_Flow_Index")[3] is None
    dates = {str(r.Date) for r in support_resistance(bars).collect()}
    assert dates == {"2019-12-31", "2020-01-03"}  # not 2020-01-01, a low below both before
    both = column(rsi(bars, years=2020), "RSI")
    assert both == column(rsi(bars), "RSI")[3:]


def test_money_flow_is_cumulative(make):
    prices = [10.0, 12.0, 9.0, 11.0]
    rows = [bar("A", d, p, p, p, p, v) for d, p, v in zip(run_of_days(n=4), prices, (5, 6, 7, 8))]
    got = column(money_flow_index(make(rows)), "Money_Flow_Index")
    assert got[:2] == [None, None]  # nothing has fallen yet
    assert math.isclose(got[2], 100 - 100 / (1 + 72 / 63))
    assert math.isclose(got[3], 100 - 100 / (1 + (72 + 88) / 63))


def test_money_flow_rising_only_is_null_and_nan_becomes_fifty(make):
    assert column(money_flow_index(make(closes(range(1, 9)))), "Money_Flow_Index") == [None] * 8
    nan = float("nan")
    rows = [bar("A", d, p, h, p, p) for d, p, h in zip(run_of_days(n=5), (5.0, 4.0, 6.0, 6.0, 6.0), (5.0, 4.0, nan, 6.0, 6.0))]
    got = column(money_flow_index(make(rows)), "Money_Flow_Index")
    assert got[0] is None and got[1] == 0.0 and got[2:] == [50.0, 50.0, 50.0]


def test_mfi_signal(make):
    bars = make(closes([10, 9, 10, 60, 61]))
    assert column(mfi_signal(bars), "signal") == [None, "oversold", "neutral", "overbought", "overbought"]


def test_bands_expand_back_from_the_newest_day(make):
    values = [1, 50, 3, 8, 7, 2, 99]
    rows = bollinger_bands(make(closes(values)), "2020-01-07", 5).orderBy("rank").collect()
    assert [r.Close for r in rows] == [2.0, 7.0, 8.0, 3.0, 50.0] and [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
    assert rows[0].std_dev is None and rows[0].upper_band is None and rows[0].moving_average == 2.0
    for n in range(2, 6):
        seen = [r.Close for r in rows[:n]]
        mean, deviation = statistics.mean(seen), statistics.stdev(seen)
        assert math.isclose(rows[n - 1].moving_average, mean)
        assert math.isclose(rows[n - 1].std_dev, deviation)
        assert math.isclose(rows[n - 1].upper_band, mean + 2 * deviation)
        assert math.isclose(rows[n - 1].lower_band, mean - 2 * deviation)


def test_bands_count_all_rows_of_repeated_dates_and_return_one_more_than_dates(make):
    rows = [bar("A", d, float(i + 1)) for i, d in enumerate(sorted(run_of_days(n=4) * 2))]
    got = bollinger_bands(make(rows), "2020-02-01", 3).collect()
    assert sorted((r["rank"], r.Close) for r in got) == [(1, 7.0), (1, 8.0), (2, 5.0), (2, 6.0)]
    assert [r.moving_average for r in got if r["rank"] == 1] == [7.5, 7.5]  # ties share a frame
    assert [r.moving_average for r in got if r["rank"] == 2] == [6.5, 6.5]


def test_bars_without_company_or_date_get_no_answer(make):
    bars = make(closes([1, 2, 3]) + [bar(None, "2020-01-01", 9.0), bar("A", None, 9.0)])
    for df in (
        rsi(bars),
        money_flow_index(bars),
        fibonacci_overlay(bars),
        fibonacci_levels(bars),
        fibonacci_levels(bars, per_year=False),
        support_resistance(bars),
    ):
        rows = df.collect()
        assert all(r.company_name == "A" for r in rows)
        assert all(r[k] is not None for r in rows for k in ("Date", "Year") if k in df.columns)
    assert rsi(bars).count() == 3 and max(r.price for r in fibonacci_levels(bars).collect()) == 3.0


def test_bands_per_company_and_price_type(make):
    bars = make(closes([1, 2, 3]) + closes([4, 5, 6], "B"))
    assert bollinger_bands(bars, "2020-01-03", 9, companies="B").count() == 2
    assert {r.company_name for r in bollinger_bands(bars, "2020-02-01", 2, "Open").collect()} == {"A", "B"}
    with pytest.raises(ValueError):
        bollinger_bands(bars, "2020-01-03", 9, "Volume")


@pytest.mark.parametrize(
    "lows, kinds", [((5, 4, 3), ["support"]), ((5, 3, 4), []), ((3, 3, 3), []), ((3, 4, 5), ["resistance"])]
)
def test_support_and_resistance(make, lows, kinds):
    rows = support_resistance(make(closes(lows))).collect()
    assert [r.kind for r in rows] == kinds
    assert all(str(r.Date) == "2020-01-03" and r.price == lows[2] for r in rows)


def test_a_bar_can_be_support_and_resistance(make):
    rows = [bar("A", d, 5.0, h, l) for d, h, l in zip(run_of_days(n=3), (6.0, 6.0, 9.0), (4.0, 4.0, 1.0))]
    got = {(r.kind, r.price) for r in support_resistance(make(rows)).collect()}
    assert got == {("support", 1.0), ("resistance", 9.0)}


def test_fibonacci_levels_and_overlay(make):
    bars = make([bar("A", "2019-01-01", 5.0, 11.0, 1.0), bar("A", "2020-01-01", 5.0, 3.0, 2.0), bar("A", "2019-05-05", 6.0)])
    levels = {(r.Year, r.level): r.price for r in fibonacci_levels(bars).collect()}
    expected = {"23.6%": 3.36, "38.2%": 4.82, "50.0%": 6.0, "61.8%": 7.18, "100.0%": 11.0}
    assert {k[1]: v for k, v in levels.items() if k[0] == 2019} == {k: pytest.approx(v) for k, v in expected.items()}
    assert levels[2020, "50.0%"] == 2.5
    overall = fibonacci_levels(bars, per_year=False)
    assert overall.columns == ["company_name", "level", "price"] and overall.count() == 5
    overlay = fibonacci_overlay(bars, "A", 2019).collect()
    assert len(overlay) == 10 and {r.price for r in overlay if r.level == "50.0%"} == {6.0}
    assert {r.Close for r in overlay} == {5.0, 6.0}


def test_volume_ratio(make):
    bars = make(
        [bar("A", d, volume=v) for d, v in zip(run_of_days(n=4), (1, 3, 8, 100))]
        + [bar("B", "2020-01-01", volume=5)]
        + [bar("C", "2020-01-04", volume=5)]
    )
    got = {r.company_name: tuple(r)[1:] for r in volume_ratio(bars, "2020-01-04", "2020-01-01", "2020-01-03").collect()}
    assert got == {"A": (100, 4.0, 25.0), "C": (5, None, None)}  # B has no bar on the day


def test_return_labels(make):
    moves = {"A": 5.0, "B": 3.0, "C": 1.0, "D": 2.0, "E": 5.0}
    bars = make([bar(c, "2020-02-10", 2.0, close=v) for c, v in moves.items()] + [bar("F", "2020-02-10", 0.0)])
    labels = {r.company_name: r.label for r in return_rate_labelled(bars, "2020-03-15", "Month").collect()}
    assert labels == {"A": "highest", "B": "positive", "C": "negative", "D": "none", "E": "highest", "F": "none"}


def test_the_highest_return_may_be_negative(make):
    bars = make([bar("A", "2020-02-10", 2.0, close=1.5), bar("B", "2020-02-10", 2.0, close=1.0)])
    labels = {r.company_name: r.label for r in return_rate_labelled(bars, "2020-03-15", "Month").collect()}
    assert labels == {"A": "highest", "B": "negative"}


def test_wide_series(make):
    bars = make(closes([1, 2], "A") + closes([5], "B", "2020-01-02") + closes([9], "C", "2020-03-01"))
    wide = price_series_wide(bars, ["A", "B"])
    assert wide.columns == ["Date", "A Close", "B Close"]
    assert [tuple(r)[1:] for r in wide.orderBy("Date").collect()] == [(1.0, None), (2.0, 5.0)]
    assert price_series_wide(bars, []).collect() == []
    returns = average_return_wide(make([bar("A", "2020-01-01", 1.0, close=2.0)]), ["A", "B"], "Week")
    assert returns.columns == ["Year", "Week", "A Avg_Return", "B Avg_Return"]
    assert tuple(returns.first()) == (2020, 1, 100.0, None)
    assert average_return_wide(bars, [], "Week").collect() == []
