"""Properties over random histories.

Hypothesis draws a whole market (several companies, gaps between days, prices
and volumes), so one Spark job checks many series.
"""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.operators import (
    bollinger_bands,
    correlation_matrix,
    first_last_rows,
    money_flow_index,
    moving_average_asof,
    moving_average_rolling,
    rsi,
    support_resistance,
)

PRICES = st.integers(1, 400).map(lambda n: n / 4)
QUIET = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


@st.composite
def histories(draw, company: str):
    gaps = draw(st.lists(st.integers(1, 20), min_size=1, max_size=45))
    day, rows = date(2019, 9, 1), []
    for gap in gaps:
        day += timedelta(days=gap)
        open_, close, up, down = (draw(PRICES) for _ in range(4))
        high, low = max(open_, close) + up, min(open_, close) - min(down, 0.25)
        rows.append((company, day, open_, high, low, close, draw(st.integers(0, 1000))))
    return rows


@st.composite
def markets(draw):
    return [row for name in "ABCDE" for row in draw(histories(name))]


def by_company(rows):
    out: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(row[0], []).append(row)
    return out


@QUIET
@given(markets())
def test_oscillators_against_plain_python(make, rows):
    bars = make(rows)
    got_rsi = {(r.company_name, r.Date): r.RSI for r in rsi(bars).collect()}
    got_mfi = {(r.company_name, r.Date): r.Money_Flow_Index for r in money_flow_index(bars).collect()}
    assert len(got_rsi) == len(rows)
    for name, history in by_company(rows).items():
        for year in {r[1].year for r in history}:
            series = [r for r in history if r[1].year == year]
            typical = [(r[3] + r[4] + r[5]) / 3 for r in series]
            moves = [0.0] + [b[5] - a[5] for a, b in zip(series, series[1:])]
            up = down = 0.0
            for i, row in enumerate(series):
                frame = moves[max(0, i - 14) : i + 1]
                gain, loss = sum(m for m in frame if m > 0), -sum(m for m in frame if m < 0)
                expected = None if loss == 0 else 100 - 100 / (1 + gain / loss)
                assert got_rsi[name, row[1]] == pytest.approx(expected)
                if i and typical[i] > typical[i - 1]:
                    up += typical[i] * row[6]
                if i and typical[i] < typical[i - 1]:
                    down += typical[i] * row[6]
                expected = None if down == 0 else 100 - 100 / (1 + up / down)
                assert got_mfi[name, row[1]] == pytest.approx(expected)
    for value in (*got_rsi.values(), *got_mfi.values()):
        assert value is None or 0 <= value <= 100


@QUIET
@given(markets(), st.integers(1, 30))
def test_first_and_last_rows_count(make, rows, k):
    counts = {r.company_name: r["count"] for r in first_last_rows(make(rows), k).groupBy("company_name").count().collect()}
    assert counts == {name: 2 * min(k, len(history)) for name, history in by_company(rows).items()}


@QUIET
@given(markets(), st.integers(1, 8), st.data())
def test_rolling_average_equals_the_average_as_of_the_day(make, rows, n, data):
    bars = make(rows)
    day = data.draw(st.sampled_from(sorted({r[1] for r in rows})))
    rolling = moving_average_rolling(bars, n).filter(F.col("Date") == F.lit(day)).collect()
    as_of = {r.company_name: r.moving_average for r in moving_average_asof(bars, day, n).collect()}
    for row in rolling:
        assert row.moving_average == pytest.approx(as_of.get(row.company_name))


@QUIET
@given(markets(), st.integers(1, 25))
def test_bands_enclose_their_mean(make, rows, n):
    for row in bollinger_bands(make(rows), "2020-06-01", n).collect():
        if row.std_dev is None:
            assert row["rank"] == 1
        else:
            assert row.lower_band <= row.moving_average <= row.upper_band


@QUIET
@given(markets())
def test_all_companies_at_once_equal_one_at_a_time(spark, make, rows):
    bars = make(rows).cache()
    for operator in (rsi, money_flow_index, support_resistance):
        together = {tuple(map(str, r)) for r in operator(bars).collect()}
        alone = {tuple(map(str, r)) for name in "ABCDE" for r in operator(bars, name).collect()}
        assert together == alone
    bars.unpersist()


@QUIET
@given(markets())
def test_correlation_equals_pandas(make, rows):
    bars = make(rows)
    expected = bars.select("Open", "High", "Low", "Close", "Volume").toPandas().corr()
    for row in correlation_matrix(bars).collect():
        value = expected.loc[row.col_a, row.col_b]
        if row["corr"] is None:
            assert value != value or min(bars.toPandas()[c].std() for c in (row.col_a, row.col_b)) < 1e-9
        else:
            assert row["corr"] == pytest.approx(value, abs=1e-9)
