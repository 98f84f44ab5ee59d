from __future__ import annotations

import sys
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from barloom.schema import BARS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("barloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def bar(company="A", day="2020-01-01", open=1.0, high=None, low=None, close=None, volume=1):
    """One bar; what is left out follows from the open and close."""
    close = open if close is None else close
    day = date.fromisoformat(day) if isinstance(day, str) else day
    top = max(open or 0.0, close or 0.0) if high is None else high
    bottom = min(open or 0.0, close or 0.0) if low is None else low
    return (company, day, open, top, bottom, close, volume)


def run_of_days(first="2020-01-01", n=10, step=1):
    start = date.fromisoformat(first)
    return [start + timedelta(days=i * step) for i in range(n)]


def closes(values, company="A", first="2020-01-01"):
    days = run_of_days(first, len(values))
    return [bar(company, d, float(v), close=float(v)) for d, v in zip(days, values)]


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: spark.createDataFrame(list(rows), BARS)


def column(df, name, *order):
    """Values of one column, in order of Date unless told otherwise."""
    return [row[name] for row in df.orderBy(*(order or ("company_name", "Date"))).collect()]
