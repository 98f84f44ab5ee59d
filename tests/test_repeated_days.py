"""Bars with repeated days, without company or without date; histories cut into spans."""

from __future__ import annotations

import math
import random
import re
import statistics
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barloom import operators as op
from barloom.operators.windows import with_bars_before
from barloom.plans.queries import all_queries
from tests.conftest import bar, closes, run_of_days
from tests.test_plans import exchanges, plan


def ragged(seed, companies="AB", days=12, most=4):
    chance = random.Random(seed)
    rows = []
    for name in companies:
        for day in run_of_days(n=days):
            for _ in range(chance.randint(0, most)):
                price = chance.randint(1, 40) / 4
                rows.append(bar(name, day, price, close=chance.choice([price, price * 2, 7.0])))
    lost = [bar(None, d, 50.0) for d in run_of_days(n=3)] + [bar("A", None, 60.0), bar(None, None, 70.0)]
    return rows + lost


def whole(rows):
    return [r for r in rows if r[0] and r[1]]


def test_pairs_take_the_mean_of_a_repeated_day(make):
    rows = [bar("A", "2020-01-01", 1.0), bar("A", "2020-01-01", 3.0), bar("A", "2020-01-02", 4.0), bar("A", "2020-01-03", 9.0)]
    rows += [bar("B", d, v) for d, v in zip(run_of_days(n=3), (2.0, 4.0, 9.0))]
    assert op.pair_correlation(make(rows), [("A", "B")]).first().correlation == pytest.approx(1.0)


@pytest.mark.parametrize("seed", range(3))
def test_pairs_equal_the_correlation_of_their_series(make, seed):
    bars = make(ragged(seed, "ABC", 30))
    found = op.pair_correlation(bars, [("A", "B"), ("C", "A"), ("A", "A"), ("A", "X"), (None, "A")]).collect()
    got = {(r.company_a, r.company_b): r.correlation for r in found}
    series = {c: bars.filter(F.col("company_name") == c).select("Date", F.col("Close").alias("Value")) for c in "ABC"}
    for a, b in (("A", "B"), ("C", "A"), ("A", "A")):
        assert got.pop((a, b)) == pytest.approx(op.series_correlation(series[a], series[b]).first().correlation)
    assert not got


def test_pair_means_are_taken_before_the_shuffle(spark, tmp_path, make):
    make(ragged(1)).write.parquet(f"{tmp_path}/bars")
    text = plan(op.pair_correlation(spark.read.parquet(f"{tmp_path}/bars"), [("A", "B")]))
    assert len(re.findall(r"partial_avg\(Close", text)) == 2 and "NestedLoop" not in text
    assert text.count("IsNotNull(Date)") >= 2


@pytest.mark.parametrize("k", [1, 3, 40])
def test_first_and_last_rows_of_ragged_bars(make, k):
    rows = ragged(k)
    got = sorted(tuple(r) for r in op.first_last_rows(make(rows), k).collect())
    want = []
    for name in "AB":
        own = sorted((r for r in whole(rows) if r[0] == name), key=lambda r: r[1:])
        want += own[:k] + own[-k:]
    assert got == sorted(want)


def test_ties_of_a_day_are_mirrored_with_nulls_first(spark, make):
    rows = [bar("A", "2020-01-01", v) for v in (3.0, None, 1.0, 2.0)]
    got = sorted((r.Open is not None, r.Open) for r in op.first_last_rows(make(rows), 1).collect())
    assert got == [(False, None), (True, 3.0)]


def test_first_and_last_rows_need_one_scan_and_one_exchange(spark, tmp_path, make):
    make(ragged(1)).write.parquet(f"{tmp_path}/bars")
    df = op.first_last_rows(spark.read.parquet(f"{tmp_path}/bars"))
    text = plan(df)
    assert text.count("FileScan") == 1 and exchanges(df) == ["hashpartitioning"]
    assert re.findall(r"WindowGroupLimit .*?(Partial|Final)", text) == ["Final", "Partial"]


@pytest.mark.parametrize("k", [1, 3, 40])
@pytest.mark.parametrize("most", [1, 4, 30])
def test_first_and_last_rows_by_days_counted_first(make, k, most):
    crowd = [bar("C", "2020-03-01", price / 8, close=2.0) for price in range(100)]
    holes = [bar("D", "2020-01-01", v) for v in (3.0, None, 1.0, 1.0, 2.0)]
    rows = ragged(k, days=20, most=most) + crowd + holes + holes
    random.Random(k).shuffle(rows)
    found, plain = (op.first_last_rows(make(rows), k, unique_days=u) for u in (False, True))
    assert found.columns == plain.columns
    got, want = (Counter(tuple(r) for r in df.collect()) for df in (found, plain))
    assert got == want and {r[0] for r in got} == set("ABCD")


def ranked(df):
    """Rows of ``df`` and how many came out of its explode, which are those that are sorted and ranked."""
    rows = df.collect()

    def below(node):
        children = node.children()
        return [node] + [x for i in range(children.size()) for x in below(children.apply(i))]

    nodes = below(df._jdf.queryExecution().executedPlan())
    return rows, sum(n.metrics().apply("numOutputRows").value() for n in nodes if n.nodeName() == "Generate")


def test_ragged_query_ranks_only_bars_of_the_days_at_either_end(spark, tmp_path):
    trades = spark.range(3000).selectExpr(
        "1 AS l_linenumber", "'N' AS l_returnflag", "'O' AS l_linestatus", "0.0D AS l_tax", "0.0D AS l_discount",
        "1.0D AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice", "TIMESTAMP '1997-01-01' + make_interval(0, 0, 0, id % 100) AS l_shipdate",
    )
    trades.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows, sorted_rows = ranked(all_queries()["ragged_first_last_rows"](spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # 30 bars a day: the first 40 are in two days, and so are the last.
    assert sorted_rows == 120
    want = sorted(range(3000), key=lambda i: (i % 100, i))
    assert sorted(r.Open for r in rows) == sorted(want[:40] + want[-40:])


def test_latest_days_leave_out_rows_without_company(spark, tmp_path, make):
    rows = ragged(5)
    make(rows).write.parquet(f"{tmp_path}/bars")
    bars = spark.read.parquet(f"{tmp_path}/bars")
    got = {r.company_name: r.moving_average for r in op.moving_average_asof(bars, "2020-01-10", 3).collect()}
    want = {}
    for name in "AB":
        own = [r for r in whole(rows) if r[0] == name and r[1] < date(2020, 1, 10)]
        days = sorted({r[1] for r in own})[-3:]
        want[name] = pytest.approx(statistics.mean(r[5] for r in own if r[1] in days))
    assert got == want
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan(op.moving_average_asof(bars, "2020-01-10", 3))).group(1)
    assert "IsNotNull(company_name)" in pushed and "LessThan(Date" in pushed


def plain_bands(rows, start, n):
    """Bands of each bar among the newest n + 1, from the definition."""
    out = []
    for name in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == name and r[1] < start]
        days = sorted({r[1] for r in own}, reverse=True)[:n]
        kept = sorted((r for r in own if r[1] in days), key=lambda r: (-r[1].toordinal(), r[2:]))[: n + 1]
        for r in kept:
            seen = [x[5] for x in own if r[1] <= x[1] <= days[0]]
            deviation = statistics.stdev(seen) if len(seen) > 1 else None
            out.append((name, r[1], r[5], days.index(r[1]) + 1, statistics.mean(seen), deviation))
    return out


@pytest.mark.parametrize("n", [1, 3, 30])
def test_bands_of_repeated_days(make, n):
    rows = ragged(n + 7)
    found = op.bollinger_bands(make(rows), "2020-01-11", n).collect()
    got = sorted((r.company_name, r.Date, r.Close, r["rank"], r.moving_average, r.std_dev) for r in found)
    want = sorted(plain_bands(whole(rows), date(2020, 1, 11), n), key=lambda r: r[:4])
    assert len(got) == len(want)
    for one, two in zip(sorted(got, key=lambda r: r[:4]), want):
        assert one[:4] == two[:4] and one[4] == pytest.approx(two[4])
        assert one[5] is None if two[5] is None else one[5] == pytest.approx(two[5], abs=1e-9)
    assert all(r.upper_band == (None if r.std_dev is None else r.moving_average + 2 * r.std_dev) for r in found)


def test_bands_by_day_equal_those_of_unique_days(make):
    bars = make(closes([1, 50, 3, 8, 7, 2, 99]) + closes([1e9 + k % 3 for k in range(40)], "B"))
    one = sorted(op.bollinger_bands(bars, "2020-02-06", 30).collect(), key=lambda r: r[:2])
    two = sorted(op.bollinger_bands(bars, "2020-02-06", 30, unique_days=True).collect(), key=lambda r: r[:2])
    assert len(one) == len(two) == 37
    for a, b in zip(one, two):
        assert a[:8] == b[:8] and a.moving_average == pytest.approx(b.moving_average, rel=1e-12)
        assert a.std_dev == (None if b.std_dev is None else pytest.approx(b.std_dev, abs=1e-6))


def test_a_crowded_day_reaches_the_window_as_one_row(spark, tmp_path):
    spark.range(200_000).select(
        F.lit("A").alias("company_name"), F.lit(date(2020, 1, 1)).alias("Date"), *((F.col("id") % 7).cast("double").alias(c) for c in ("Open", "High", "Low", "Close")),
        F.col("id").alias("Volume"),
    ).write.parquet(f"{tmp_path}/bars")
    found = op.bollinger_bands(spark.read.parquet(f"{tmp_path}/bars"), "2020-02-01", 5)
    text = plan(found)
    assert text.count("WindowGroupLimit") == 4 and "partial_var_pop(Close" in text
    rows = found.collect()
    assert len(rows) == 6 and {r.Close for r in rows} == {0.0}
    values = [float(k % 7) for k in range(200_000)]
    assert all(math.isclose(r.std_dev, statistics.stdev(values), rel_tol=1e-9) for r in rows)


def executed(df):
    df.collect()
    return df


def test_highest_return_reads_bars_once(spark, tmp_path, make):
    rows = ragged(3) + [bar("A", "2021-05-05", 2.0, close=2.0 + k % 2) for k in range(50)]
    make(rows).write.parquet(f"{tmp_path}/bars")
    bars = spark.read.parquet(f"{tmp_path}/bars")
    for per_year in (True, False):
        df = op.highest_daily_return(bars, per_year=per_year)
        got = sorted(tuple(r) for r in df.select(*bars.columns).collect())
        text = plan(executed(df)).split("== Initial Plan ==")[0]
        assert text.count("FileScan") == 1 and "ReusedExchange" in text and "Partial" in text
        dated_rows = [r for r in rows if r[1] or not per_year]
        top = {}
        for r in dated_rows:
            key = r[1].year if per_year else 0
            top[key] = max(top.get(key, -1e9), (r[5] - r[2]) / r[2])
        want = [r for r in dated_rows if (r[5] - r[2]) / r[2] == top[r[1].year if per_year else 0]]
        assert got == sorted(want, key=lambda r: tuple((v is not None, v) for v in r)) or sorted(map(str, got)) == sorted(map(str, want))


def test_a_year_of_equal_returns_is_spread(spark):
    bars = spark.range(5000).select(
        F.concat(F.lit("c"), F.col("id") % 50).alias("company_name"),
        F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 360).cast("int")).alias("Date"),
        *(F.lit(2.0).alias(c) for c in ("Open", "High", "Low", "Close")),
        F.lit(1).cast("long").alias("Volume"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = op.highest_daily_return(bars).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in per_task) == 5000 and len(per_task) > 1 and max(r["count"] for r in per_task) < 4000


def gappy(chance, name):
    day, rows = date(2019, 1, 1), []
    for _ in range(chance.randint(1, 60)):
        day += timedelta(days=chance.choice([1, 1, 2, 5, 40]))
        rows.append(bar(name, day, float(chance.randint(1, 99))))
    return rows


@pytest.mark.parametrize("span_days", [1, 7, 30, 400])
def test_spans_see_what_the_whole_history_sees(make, span_days):
    chance = random.Random(span_days)
    bars = make([r for name in "ABCDE" for r in gappy(chance, name)] + [bar(None, "2019-03-03", 1.0), bar("A", None, 2.0)])
    dates = ("2019-01-20", "2020-12-31")
    for plain, cut in (
        (op.price_changes(bars, *dates), op.price_changes(bars, *dates, span_days=span_days)),
        (op.moving_average_rolling(bars, 3), op.moving_average_rolling(bars, 3, span_days=span_days)),
        (op.moving_average_rolling(bars, 45, "Open"), op.moving_average_rolling(bars, 45, "Open", span_days=span_days)),
    ):
        assert cut.columns == plain.columns
        assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def test_a_long_history_is_spread_over_spans(spark, tmp_path):
    bars = spark.range(20_000).select(
        F.lit("A").alias("company_name"), F.date_add(F.lit(date(1960, 1, 1)), F.col("id").cast("int")).alias("Date"), F.col("id").cast("double").alias("Close")
    )
    led = with_bars_before(bars, 30, "Close", 1000)
    sizes = [r["count"] for r in led.groupBy("company_name", "_span").count().collect()]
    assert len(sizes) == 21 and max(sizes) <= 1030 and sum(sizes) == 20_000 + 30 * 20
    text = plan(op.price_changes(bars.withColumn("Open", F.col("Close")), "1900-01-01", "2100-01-01", span_days=1000))
    assert re.search(r"hashpartitioning\(company_name#\d+, _span#\d+", text) and "Partial" in text
    with pytest.raises(ValueError):
        with_bars_before(bars, 30, "Close", 0)
