"""Ranked and offset windows along each company's bars.

If bars are one row per company and day (``schema.repeated_days`` tells), a
company's window partition holds no more rows than its history has days, and with
``span_days`` no more than a span of it has. The top-k operators keep ``rank <= k``
right above the window: Spark then cuts every map task to k dates per company
before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.frames import by_date, dated, newest_first, tie_order
from barloom.operators.filters import before_date, between_dates, select_bars
from barloom.schema import check_count, check_price_type

# Fixed value: the "month" of a price change is this many bars, not a month.
MONTH_BARS = 30
# Helper columns of windows that are cut by spans of dates.
SPAN, CARRIED = "_span", "_carried"


def first_last_rows(bars: DataFrame, k: int = 40, *, unique_days: bool = True) -> DataFrame:
    """The first ``k`` and the last ``k`` bars of each company, as one table.

    A company with fewer than ``2 * k`` bars has some of them twice. Bars of one
    day follow each other by Open, High, Low, Close and Volume, NULL first. Bars
    without company or date are left out.

    Every bar is ranked from both ends in one pass: it goes once into the part
    of the first and once, its order turned round, into that of the last, and
    each task cuts both parts to ``k`` bars of a company before the shuffle.

    The cut sorts all bars of a task twice over, which spills where a task has
    many. Without ``unique_days`` the bars of each day are counted first, and
    only those of the days at either end are ranked. The rows are the same; the
    bars are read twice, and the days' bounds, one row per company, are broadcast.
    """
    check_count("k", k)
    whole = dated(bars)
    both = whole.withColumn("_end", F.explode(F.array(F.lit(1), F.lit(-1)))) if unique_days else _near_an_end(whole, k)
    row = F.row_number().over(Window.partitionBy("company_name", "_end").orderBy(*_from_either_end(bars)))
    return both.withColumn("_row", row).filter(F.col("_row") <= k).drop("_end", "_row")


def _near_an_end(bars: DataFrame, k: int) -> DataFrame:
    """The bars of the days that hold a company's first and last ``k`` bars, once for each
    part they may be in: ``_end`` is 1 in that of the first and -1 in that of the last.

    Both bounds follow from exact counts, and whole days are kept, so no tie is cut here.
    """
    day = F.unix_date("Date")
    days = bars.groupBy(F.col("company_name").alias("_company"), day.alias("_day")).agg(F.count("*").alias("_bars"))
    company = Window.partitionBy("_company")
    upto, total = F.sum("_bars").over(company.orderBy("_day")), F.sum("_bars").over(company)
    placed = days.withColumns({"_before": upto - F.col("_bars"), "_after": total - upto})
    bounds = placed.groupBy("_company").agg(
        F.max(F.when(F.col("_before") < k, F.col("_day"))).alias("_until"),
        F.min(F.when(F.col("_after") < k, F.col("_day"))).alias("_from"),
    )
    first, last = day <= F.col("_until"), day >= F.col("_from")
    near = bars.join(F.broadcast(bounds), (F.col("company_name") == F.col("_company")) & (first | last))
    ends = F.array(F.when(first, F.lit(1)), F.when(last, F.lit(-1)))
    return near.withColumn("_end", F.explode(F.array_compact(ends))).drop("_company", "_until", "_from")


def _from_either_end(bars: DataFrame) -> list[Column]:
    """Order by date and ties, upwards where ``_end`` is 1 and downwards where it is -1."""
    end, order = F.col("_end"), [F.unix_date("Date") * F.col("_end")]
    for name in tie_order(bars):
        order += [F.col(name).isNotNull().cast("int") * end, F.col(name) * end]
    return order


def price_changes(
    bars: DataFrame,
    start: date | str,
    end: date | str,
    companies: str | Iterable[str] | None = None,
    *,
    span_days: int | None = None,
) -> DataFrame:
    """Close against 1 and 30 bars earlier, within the date range.

    The range is cut first, so the first bar (day) and the first 30 bars
    (month) of each company are NULL. ``span_days``: see ``with_bars_before``.
    """
    selected = between_dates(select_bars(bars, companies), start, end)
    along, window = _along(selected, MONTH_BARS, "Close", span_days)

    def change(bars_back: int) -> Column:
        return F.col("Close") - F.lag("Close", bars_back).over(window)

    return _own(along.withColumns({"Price_Diff_Day": change(1), "Price_Diff_Month": change(MONTH_BARS)}))


def with_bars_before(bars: DataFrame, back: int, price: str, span_days: int) -> DataFrame:
    """Bars cut into spans of ``span_days`` days, each with the ``back`` bars before it.

    Adds ``_span``, which span a row counts in, and ``_carried``, true for the
    copies of earlier bars that lead a span; these have company, date and
    ``price`` only. A window along company and span then sees what one along the
    company would see, ``back`` bars back, but holds the bars of one span: a
    company with a very long or dense history is spread over many tasks. Only
    the last ``back`` bars of each span, cut in every task, are looked at to find
    the copies. Days of a company must be unique.
    """
    check_count("back", back)
    check_count("span_days", span_days)
    spanned = dated(bars).withColumn(SPAN, F.floor(F.unix_date("Date") / span_days))
    row = F.row_number().over(Window.partitionBy("company_name", SPAN).orderBy(F.desc("Date")))
    last = spanned.select("company_name", "Date", price, SPAN).withColumn("_row", row).filter(F.col("_row") <= back)
    # A bar leads every later span that begins within the next ``back`` of the bars left.
    ahead = F.collect_set(SPAN).over(by_date().rowsBetween(1, back))
    copies = last.withColumn("_ahead", F.array_except(ahead, F.array(SPAN))).select(
        "company_name", "Date", price, F.explode("_ahead").alias(SPAN), F.lit(True).alias(CARRIED)
    )
    return spanned.withColumn(CARRIED, F.lit(False)).unionByName(copies, allowMissingColumns=True)


def _along(bars: DataFrame, back: int, price: str, span_days: int | None) -> tuple[DataFrame, WindowSpec]:
    """Bars that have company and date, and the window along them that sees ``back`` bars back."""
    if span_days is None:
        return dated(bars), by_date()
    return with_bars_before(bars, back, price, span_days), Window.partitionBy("company_name", SPAN).orderBy("Date")


def _own(bars: DataFrame) -> DataFrame:
    """Without the copies of ``with_bars_before``."""
    return bars.filter(~F.col(CARRIED)).drop(SPAN, CARRIED) if CARRIED in bars.columns else bars


def latest_days(bars: DataFrame, start: date | str, n: int) -> DataFrame:
    """Each company's bars on its ``n`` latest dates before ``start``; ``rank``
    counts dates back from the newest. Bars without company are left out."""
    check_count("n", n)
    ranked = dated(before_date(bars, start)).withColumn("rank", F.dense_rank().over(newest_first()))
    return ranked.filter(F.col("rank") <= n)


def moving_average_asof(
    bars: DataFrame, start: date | str, n: int, price_type: str = "Close"
) -> DataFrame:
    """Mean price over the ``n`` latest dates before ``start``; over those there
    are when a company has fewer, and no row when it has none."""
    check_price_type(price_type)
    return (
        latest_days(bars.select("company_name", "Date", price_type), start, n)
        .groupBy("company_name")
        .agg(F.avg(price_type).alias("moving_average"))
    )


def moving_average_rolling(
    bars: DataFrame, n: int, price_type: str = "Close", *, span_days: int | None = None
) -> DataFrame:
    """Adds ``moving_average``: mean price of the ``n`` bars before each bar.

    Bars without company or date are left out. ``span_days``: see
    ``with_bars_before``."""
    check_count("n", n)
    check_price_type(price_type)
    along, window = _along(bars, n, price_type, span_days)
    return _own(along.withColumn("moving_average", F.avg(price_type).over(window.rowsBetween(-n, -1))))
