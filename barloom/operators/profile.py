"""Table profile: counts, statistics, missing values, distinct values, spacing.

Each is one aggregation with map-side combine. Statistics come back in long
form, one row per column of the table.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.calendar import period_label
from barloom.functions.frames import by_date, dated
from barloom.operators.filters import select_bars
from barloom.schema import as_date, named, numeric_columns

_STATISTICS = "column string, count bigint, mean double, stddev double, min double, max double"


def num_observations(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("num_observations"))


def schema_listing(df: DataFrame) -> DataFrame:
    """Name and type of every column."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "name string, type string")


def describe_numeric(df: DataFrame, by: str | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of each numeric
    column, over the table or per value of ``by``. No numeric column, no rows."""
    columns = [name for name in numeric_columns(df) if name != by]
    keys = [] if by is None else [by]
    if not columns:
        fields = [df.schema[by]] if by else []
        schema = T.StructType(fields + T.StructType.fromDDL(_STATISTICS).fields)
        return df.sparkSession.createDataFrame([], schema)

    statistics = []
    for name in columns:
        value = named(name).cast("double")
        statistics.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(named(name)).alias("count"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("stddev"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
            )
        )
    return df.groupBy(*keys).agg(F.array(*statistics).alias("s")).select(*keys, F.inline("s"))


def missing_values(df: DataFrame) -> DataFrame:
    """NULLs per column, and empty text in string columns. NaN is a value."""
    counts = []
    for field in df.schema:
        column = named(field.name)
        absent: Column = column.isNull()
        if isinstance(field.dataType, T.StringType):
            absent = absent | (column == "")
        counts.append(F.struct(F.lit(field.name).alias("column"), F.count_if(absent).alias("missing")))
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def distinct_companies(bars: DataFrame) -> DataFrame:
    return bars.select("company_name").distinct().orderBy("company_name")


def distinct_years(bars: DataFrame, *, by_company: bool = False) -> DataFrame:
    """Years with data and their number of bars."""
    keys = ["company_name", "Year"] if by_company else ["Year"]
    return (
        bars.withColumn("Year", F.year("Date"))
        .groupBy(*keys)
        .agg(F.count("*").alias("n_bars"))
        .orderBy(*keys)
    )


def available_dates(bars: DataFrame, companies: str | Iterable[str] | None = None) -> DataFrame:
    return select_bars(bars, companies).select("Date").distinct().orderBy("Date")


def date_coverage(bars: DataFrame, *, by_company: bool = True) -> DataFrame:
    """First and last date and the number of different dates."""
    keys = ["company_name"] if by_company else []
    return bars.groupBy(*keys).agg(
        F.min("Date").alias("first_date"),
        F.max("Date").alias("last_date"),
        F.count_distinct("Date").alias("n_dates"),
    )


def period_since(bars: DataFrame, start: object) -> DataFrame:
    """Adds ``period``: the wording of the time from ``start`` to each bar."""
    return bars.withColumn("period", period_label(F.lit(as_date(start)), F.col("Date")))


def bar_spacing(bars: DataFrame) -> DataFrame:
    """Adds ``gap_days`` and ``period`` since the previous bar of the company.

    Bars without company or date are left out."""
    return _gaps(bars).withColumn("period", _gap_label())


def _gaps(bars: DataFrame) -> DataFrame:
    return dated(bars).withColumn("gap_days", F.datediff("Date", F.lag("Date").over(by_date())))


def _gap_label() -> Column:
    """Wording of ``gap_days``, which is all that the wording depends on."""
    origin = F.lit(date(2000, 1, 1))
    return period_label(origin, F.date_add(origin, F.col("gap_days")))


def sampling_period(bars: DataFrame) -> DataFrame:
    """Most frequent spacing of each company's bars; the shortest on a tie."""
    spacing = (
        _gaps(bars.select("company_name", "Date"))
        .filter("gap_days IS NOT NULL")
        .groupBy("company_name", "gap_days")
        .agg(F.count("*").alias("n_gaps"))
    )
    most_frequent = F.max(F.struct("n_gaps", -F.col("gap_days"), "gap_days"))
    return (
        spacing.groupBy("company_name")
        .agg(most_frequent.alias("top"))
        .select("company_name", "top.gap_days", "top.n_gaps")
        .select("company_name", "gap_days", _gap_label().alias("period"), "n_gaps")
    )
