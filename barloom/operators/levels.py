"""Price levels and volume against its average."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.frames import YEAR, by_date_in_year, dated, in_year, with_year
from barloom.functions.prices import ratio
from barloom.operators.filters import select_bars
from barloom.schema import as_date, check_range

# Share of the range above the low, by the name of the level.
FIBONACCI_LEVELS = {"23.6%": 0.236, "38.2%": 0.382, "50.0%": 0.5, "61.8%": 0.618}
TOP_LEVEL = "100.0%"


def _level_rows(lowest: Column, highest: Column) -> Column:
    levels = [
        F.struct(F.lit(name).alias("level"), (lowest + (highest - lowest) * share).alias("price"))
        for name, share in FIBONACCI_LEVELS.items()
    ]
    return F.array(*levels, F.struct(F.lit(TOP_LEVEL).alias("level"), highest.alias("price")))


def fibonacci_levels(
    bars: DataFrame,
    companies: str | Iterable[str] | None = None,
    years: int | Iterable[int] | None = None,
    *,
    per_year: bool = True,
) -> DataFrame:
    """``(company_name[, Year], level, price)``: five levels between the lowest
    low and the highest high of a company, per year or over all of its bars.
    Bars without company or date are left out."""
    keys = ["company_name", "Year"] if per_year else ["company_name"]
    return (
        dated(select_bars(bars, companies, years))
        .withColumn("Year", F.year("Date"))
        .groupBy(*keys)
        .agg(F.min("Low").alias("lowest"), F.max("High").alias("highest"))
        .select(*keys, F.inline(_level_rows(F.col("lowest"), F.col("highest"))))
    )


def fibonacci_overlay(
    bars: DataFrame,
    companies: str | Iterable[str] | None = None,
    years: int | Iterable[int] | None = None,
) -> DataFrame:
    """Each bar's close beside the levels of its company and year.

    The range comes from a window over the company's year, 366 bars if a day has one:
    one scan and one shuffle, where joining the levels back would take two.
    """
    year = in_year()
    return (
        with_year(select_bars(bars, companies, years))
        .select(
            "company_name",
            "Date",
            F.col(YEAR).alias("Year"),
            "Close",
            F.min("Low").over(year).alias("_lowest"),
            F.max("High").over(year).alias("_highest"),
        )
        .select(
            "company_name",
            "Date",
            "Year",
            "Close",
            F.inline(_level_rows(F.col("_lowest"), F.col("_highest"))),
        )
    )


def volume_ratio(
    bars: DataFrame, target: date | str, start: date | str, end: date | str
) -> DataFrame:
    """Volume on ``target`` over the mean volume from ``start`` to ``end``.

    One pass over the dates concerned. A company without a bar on ``target``
    has no row; a period without bars gives NULL.
    """
    target = as_date(target)
    start, end = check_range(start, end, strict=True)
    on_target = F.col("Date") == F.lit(target)
    in_period = F.col("Date").between(F.lit(start), F.lit(end))
    volume = F.col("Volume")
    return (
        bars.filter(on_target | in_period)
        .groupBy("company_name")
        .agg(
            F.count_if(on_target).alias("_on_target"),
            F.max(F.when(on_target, volume)).alias("target_volume"),
            F.avg(F.when(in_period, volume)).alias("average_volume"),
        )
        .filter("_on_target > 0")
        .drop("_on_target")
        .withColumn("volume_ratio", ratio(F.col("target_volume"), F.col("average_volume")))
    )


def support_resistance(
    bars: DataFrame,
    companies: str | Iterable[str] | None = None,
    years: int | Iterable[int] | None = None,
) -> DataFrame:
    """``(company_name, Date, kind, price)``: lows below, and highs above, those
    of the two bars before in the same year."""

    def before(column: str, bars_back: int):
        return F.lag(column, bars_back).over(by_date_in_year())

    low, high = F.col("Low"), F.col("High")
    marked = with_year(select_bars(bars, companies, years)).select(
        "company_name",
        "Date",
        F.when((low < before("Low", 1)) & (low < before("Low", 2)), low).alias("support"),
        F.when((high > before("High", 1)) & (high > before("High", 2)), high).alias("resistance"),
    )
    kinds = F.array(
        *(
            F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("price"))
            for kind in ("support", "resistance")
        )
    )
    return marked.select("company_name", "Date", F.inline(kinds)).filter("price IS NOT NULL")
