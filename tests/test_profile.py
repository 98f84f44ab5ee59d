import math
import random
import statistics
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import (
    available_dates,
    bar_spacing,
    correlation_matrix,
    date_coverage,
    describe_numeric,
    distinct_companies,
    distinct_years,
    missing_values,
    moving_average_rolling,
    num_observations,
    pair_correlation,
    sampling_period,
    schema_listing,
    select_bars,
    series_correlation,
)
from tests.conftest import bar, closes, column


def test_counts_and_listings(make):
    bars = make(
        [bar("B", "2020-01-01"), bar("A", "2019-12-31"), bar("A", "2020-01-01"), bar("A", "2021-06-01")]
    )
    assert num_observations(bars).first()[0] == 4
    assert [r[0] for r in distinct_companies(bars).collect()] == ["A", "B"]
    assert [tuple(r) for r in distinct_years(bars).collect()] == [(2019, 1), (2020, 2), (2021, 1)]
    assert [tuple(r) for r in distinct_years(bars, by_company=True).collect()][-1] == ("B", 2020, 1)
    assert [r.Date for r in available_dates(bars, "B").collect()] == [date(2020, 1, 1)]
    assert date_coverage(bars, by_company=False).first()[:3] == (date(2019, 12, 31), date(2021, 6, 1), 3)
    coverage = {r.company_name: r.n_dates for r in date_coverage(bars).collect()}
    assert coverage == {"A": 3, "B": 1}
    assert schema_listing(bars).collect()[1] == ("Date", "date")


def test_selection(make):
    bars = make([bar(c, d) for c in "ABC" for d in ("2019-05-01", "2020-05-01")])
    assert select_bars(bars).count() == 6
    assert select_bars(bars, "A").count() == 2
    assert select_bars(bars, ["A", "C"], 2020).count() == 2
    assert select_bars(bars, []).count() == 0
    assert select_bars(bars, None, []).count() == 0


def test_describe(spark, make):
    bars = make([bar("A", "2020-01-01", 1.0), bar("A", "2020-01-02", 3.0), bar("B", "2020-01-01", None)])
    rows = {(r.company_name, r.column): r for r in describe_numeric(bars, by="company_name").collect()}
    a, b = rows["A", "Open"], rows["B", "Open"]
    assert (a["count"], a.mean, a["min"], a["max"]) == (2, 2.0, 1.0, 3.0)
    assert math.isclose(a.stddev, math.sqrt(2))
    assert (b["count"], b.mean, b.stddev) == (0, None, None)
    assert [r.column for r in describe_numeric(bars).collect()] == ["Open", "High", "Low", "Close", "Volume"]
    text = spark.sql("SELECT 'x' AS a, 1.5BD AS b")
    assert describe_numeric(text).collect() == [] and correlation_matrix(text).collect() == []
    assert describe_numeric(text, by="a").columns[0] == "a"


def test_a_null_company_is_a_group_of_its_own(make):
    bars = make([bar("A"), bar(None)])
    groups = {r.company_name for r in describe_numeric(bars, by="company_name").collect()}
    assert groups == {"A", None}


def test_missing_values(spark):
    df = spark.createDataFrame(
        [("", 1.0), (None, None), ("x", float("nan")), (" ", 2.0)], "`a.b` string, v double"
    )
    assert {r.column: r.missing for r in missing_values(df).collect()} == {"a.b": 2, "v": 1}


def test_spacing(make):
    days = ["2020-01-01", "2020-01-02", "2020-01-09", "2020-01-10", "2020-01-17"]
    bars = make([bar("A", d) for d in days] + [bar("B", "2020-01-01")])
    spaced = bar_spacing(bars)
    assert column(spaced, "gap_days") == [None, 1, 7, 1, 7, None]
    assert column(spaced, "period") == [None, "1 day", "1 week", "1 day", "1 week", None]
    assert [tuple(r) for r in sampling_period(bars).collect()] == [("A", 1, "1 day", 2)]


def test_correlation_matrix(spark):
    rows = [(1.0, 2, 5.0, None), (2.0, 4, 5.0, 1.0), (3.0, 6, 5.0, float("nan")), (4.0, 9, 5.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double")
    got = {(r.col_a, r.col_b): r["corr"] for r in correlation_matrix(df).collect()}
    assert len(got) == 16
    assert got["a", "b"] == got["b", "a"] and math.isclose(got["a", "b"], 11.5 / math.sqrt(5 * 26.75))
    assert math.isclose(got["a", "a"], 1.0)
    assert math.isclose(got["a", "d"], 1.0)  # over the two rows where d is a number
    assert got["c", "c"] is None and got["a", "c"] is None
    assert len(correlation_matrix(df, ["a", "b"]).collect()) == 4


def test_profiles_accept_odd_column_names(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "`a.b` double, `c``d` double")
    assert [r.column for r in describe_numeric(df).collect()] == ["a.b", "c`d"]
    assert {round(r["corr"], 9) for r in correlation_matrix(df).collect()} == {1.0, -1.0}


def test_pair_and_series_correlation(spark, make):
    up, down = [1, 2, 3, 4], [8, 6, 4, 2]
    bars = make(closes(up, "A") + closes(down, "B") + closes([7, 7, 7], "C") + closes(up, "D", "2022-01-01"))
    got = {tuple(r)[:2]: r.correlation for r in pair_correlation(bars, [("A", "B"), ("A", "C"), ("A", "D")]).collect()}
    assert got.keys() == {("A", "B"), ("A", "C")}  # A and D share no date
    assert math.isclose(got["A", "B"], -1.0) and got["A", "C"] is None
    table = spark.createDataFrame([("B", "A")], "company_a string, company_b string")
    assert math.isclose(pair_correlation(bars, table, "Open").first().correlation, -1.0)

    def series(name):
        return bars.filter(f"company_name = '{name}'").selectExpr("Date", "Close AS Value")

    assert math.isclose(series_correlation(series("A"), series("B")).first()[0], -1.0)
    assert series_correlation(series("A"), series("D")).first()[0] is None


def test_correlation_survives_large_offsets(spark):
    df = spark.range(100).selectExpr("1e9 + id AS a", "1e9 + 2 * id AS b")
    got = {(r.col_a, r.col_b): r["corr"] for r in correlation_matrix(df).collect()}
    assert got["a", "b"] == pytest.approx(1.0, abs=1e-9)


def test_pairs_of_any_length_and_form_agree(spark, make):
    bars = make(closes([1, 2, 3, 4], "A") + closes([8, 6, 4, 2], "B"))
    short = [("A", "B"), (None, "B")]
    longer = short * 501
    expected = [("A", "B")]
    for pairs in (short, longer, spark.createDataFrame(longer, "company_a string, company_b string")):
        rows = pair_correlation(bars, pairs).collect()
        assert [(r.company_a, r.company_b) for r in rows] == expected and math.isclose(rows[0].correlation, -1.0)
    assert pair_correlation(bars, []).collect() == []


def test_repeated_keys_of_a_series_multiply_nothing(spark):
    left = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 4.0), (3, 6.0)], "Date int, Value double")
    right = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 2.0), (3, 9.0)], "Date int, Value double")
    got = series_correlation(left, right).first().correlation
    assert math.isclose(got, statistics.correlation([2.0, 4.0, 6.0], [1.0, 2.0, 9.0]))
    keyed = [df.selectExpr("Date", "Date % 2 AS part", "Value") for df in (left, right)]
    assert math.isclose(series_correlation(*keyed, on=["Date", "part"]).first().correlation, got)


@pytest.mark.parametrize("n", [1, 2, 5, 6, 60])
def test_correlation_of_many_columns(spark, n):
    df = spark.range(30).select(*(F.sin(F.col("id") * (k + 1)).alias(f"c{k}") for k in range(n)))
    got = {(r.col_a, r.col_b): r["corr"] for r in correlation_matrix(df).collect()}
    assert len(got) == n * n and all(got[a, b] == got[b, a] for a, b in got)
    pdf = df.toPandas().corr()
    assert all(math.isclose(v, pdf[a][b], abs_tol=1e-9) for (a, b), v in got.items())


def test_spacing_leaves_out_bars_without_company_or_date(make):
    bars = make(closes([1, 2, 3]) + [bar(None, "2020-01-01"), bar(None, "2020-01-05"), bar("A", None)])
    assert bar_spacing(bars).count() == 3 and sampling_period(bars).count() == 1
    assert moving_average_rolling(bars, 2).count() == 3


def test_correlation_matrix_of_values_that_are_partly_missing(spark):
    chance = random.Random(11)
    rows = []
    for k in range(3000):
        a, b = chance.gauss(1e6, 1), chance.choice([None, float("nan"), chance.random()])
        rows.append((a, b, a + (b or 0.0) if b == b else 5.0, k if chance.random() < 0.7 else None, 4.25 if b is not None else chance.random(), None))
    df = spark.createDataFrame(rows, "a double, b double, c double, d long, e double, f double").repartition(5)
    pandas = pd.DataFrame([[math.nan if v is None else float(v) for v in r] for r in rows], columns=list("abcdef"))
    got = {(r.col_a, r.col_b): r["corr"] for r in correlation_matrix(df).collect()}
    assert len(got) == 36
    expected = pandas.corr()
    for (one, two), value in got.items():
        want = expected.loc[one, two]
        both = pandas[[one, two]].dropna()
        if len(both) < 2 or both.std().min() < 1e-9:
            assert value is None, (one, two)
        else:
            assert math.isclose(value, want, abs_tol=1e-9), (one, two)
