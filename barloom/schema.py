"""The bars schema and the checks on arguments and input columns."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BARS = T.StructType(
    [
        T.StructField("company_name", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
    ]
)

# Argument vocabularies, and the only date format accepted as text.
PERIODS = ("Year", "Month", "Week")
PRICE_TYPES = ("Open", "Close")
DATE_FORMAT = "yyyy-MM-dd"  # for Spark; as_date has the same for Python
# A date, alone or with a time of day and zone, which are dropped.
DATE_TEXT = r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[ T][0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]+)?)?\s*(?:Z|UTC|[+-][0-9]{2}:?[0-9]{2})?)?\s*$"

# Fixed value: the types that profiles and correlations cover. Decimal is left out on purpose.
NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
)


def conform(df: DataFrame) -> DataFrame:
    """Bring the bar columns of ``df`` to the types of ``BARS``.

    Text that does not parse becomes NULL; ``unparsed_values`` counts it. A date
    may have a time of day, a volume a decimal point if it is whole. Columns
    that already have the right type are left untouched, so filters on them
    still reach a Parquet scan. Names are matched like Spark does, whatever
    their case, and come out as in ``BARS``; two that differ in case only are an
    error. Further columns are carried through.
    """
    fixed = _conformed(df)
    return df.withColumns(fixed) if fixed else df


def unparsed_values(df: DataFrame) -> DataFrame:
    """``(column, unparsed)``: how many values of each bar column ``conform``
    turns into NULL. ``df`` is the table before it."""
    fixed = _conformed(df)
    have = {f.name.lower(): f.name for f in df.schema}
    counts = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.count_if(named(have[f.name.lower()]).isNotNull() & fixed.get(f.name, F.lit(0)).isNull()).alias("unparsed"),
        )
        for f in BARS
    ]
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def _conformed(df: DataFrame) -> dict[str, Column]:
    """The bar columns that need a cast or another name."""
    have = {f.name.lower(): f for f in df.schema}
    wanted = {f.name.lower() for f in BARS}
    twins = [f.name for f in df.schema if f.name.lower() in wanted and have[f.name.lower()].name != f.name]
    if twins:
        raise ValueError(f"bars have columns whose names differ in case only: {twins} in {df.columns}")
    missing = [f.name for f in BARS if f.name.lower() not in have]
    if missing:
        raise ValueError(f"bars lack the columns {missing}; found {df.columns}")
    fixed = {}
    for field in BARS:
        found = have[field.name.lower()]
        column = named(found.name)
        if found.dataType == field.dataType:
            if found.name != field.name:
                fixed[field.name] = column
        elif field.name == "Date" and isinstance(found.dataType, T.StringType):
            text = F.regexp_extract(column, DATE_TEXT, 1)
            fixed["Date"] = F.try_to_date(F.when(text != "", text), DATE_FORMAT)
        elif field.name == "Volume" and isinstance(found.dataType, T.StringType):
            # Decimal keeps whole numbers beyond 2^53 exact.
            number = column.try_cast("decimal(38,6)")
            fixed["Volume"] = F.when(number == F.floor(number), number.try_cast("bigint"))
        else:
            fixed[field.name] = column.try_cast(field.dataType)
    return fixed


def repeated_days(bars: DataFrame) -> DataFrame:
    """Company days that occur more than once: ``(company_name, Date, n_rows)``.

    An empty result is what bounds every per-company window by the calendar.
    """
    return (
        bars.groupBy("company_name", "Date")
        .agg(F.count("*").alias("n_rows"))
        .filter("n_rows > 1")
    )


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC_TYPES)]


def as_date(value: date | datetime | str) -> date:
    """A ``date`` from a date, a datetime or text like 2020-01-31."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    if isinstance(value, str):
        return datetime.strptime(value, "%Y-%m-%d").date()
    raise ValueError(f"not a date: {value!r}")


def as_list(value: object | Iterable) -> list:
    """A list from one value or several; a string counts as one value."""
    if isinstance(value, str) or not isinstance(value, Iterable):
        return [value]
    return list(value)


def check_period(period: str) -> str:
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, not {period!r}")
    return period


def check_price_type(price_type: str) -> str:
    if price_type not in PRICE_TYPES:
        raise ValueError(f"price type must be one of {PRICE_TYPES}, not {price_type!r}")
    return price_type


def check_count(name: str, value: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValueError(f"{name} must be a positive whole number, not {value!r}")
    return value


def check_range(start: date | str, end: date | str, *, strict: bool = False) -> tuple[date, date]:
    start, end = as_date(start), as_date(end)
    if end < start or (strict and end == start):
        raise ValueError(f"end date {end} must come after start date {start}")
    return start, end
