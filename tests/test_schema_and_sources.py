from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import between_dates, rsi, volume_ratio
from barloom.schema import BARS, as_date, as_list, check_price_type, conform, repeated_days, unparsed_values
from barloom.sources import bars_from_trades, read_bars
from tests.conftest import bar

CSV = """Date,Open,High,Low,Close,Volume,company_name,Note
2020-01-02,1.5,2,1,1.75,100,A,first
2020-01-03,x,2,1,,200,A,
not a day,1,2,1,1,,B,""
"""


@pytest.fixture()
def csv_file(tmp_path):
    path = tmp_path / "bars.csv"
    path.write_text(CSV)
    return path


def test_csv_columns_are_found_by_name_and_cast(spark, csv_file):
    bars = read_bars(spark, str(csv_file))
    types = {f.name: f.dataType for f in bars.schema}
    assert {f.name: f.dataType for f in BARS}.items() <= types.items()
    rows = {r.Volume: r for r in bars.collect()}
    assert rows[100].Date == date(2020, 1, 2) and rows[100].Open == 1.5
    assert rows[100].Note == "first"
    assert rows[200].Open is None and rows[200].Close is None and rows[200].Note is None
    assert rows[None].Date is None and rows[None].company_name == "B"


def test_csv_folder_and_inferred_further_column(spark, tmp_path):
    for n in range(2):
        (tmp_path / f"{n}.csv").write_text(
            f"company_name,Date,Open,High,Low,Close,Volume,Extra\nA,2020-01-0{n + 1},1,1,1,1,5,{n}\n"
        )
    assert read_bars(spark, f"{tmp_path}/*.csv").count() == 2
    bars = read_bars(spark, str(tmp_path), "csv", infer_schema=True)
    assert dict(bars.dtypes)["Extra"] == "int" and dict(bars.dtypes)["Volume"] == "bigint"


def test_parquet(spark, make, tmp_path):
    path = f"{tmp_path}/bars.parquet"
    make([bar()]).write.parquet(path)
    assert read_bars(spark, path).collect() == make([bar()]).collect()


def test_excel_without_connector_and_unknown_types(spark):
    with pytest.raises(RuntimeError, match="connector"):
        read_bars(spark, "prices.xlsx")
    for path in ("prices.CSV", "prices.txt", "prices"):
        with pytest.raises(ValueError, match="file type"):
            read_bars(spark, path)


def test_conform_keeps_right_types_and_converts_others(spark):
    with pytest.raises(ValueError, match="Volume"):
        conform(spark.range(1).select(F.lit("A").alias("company_name")))
    raw = spark.sql(
        "SELECT 'A' company_name, timestamp_ntz'2020-02-29 23:00:00' Date, 1 Open, 2f High,"
        " 3L Low, '4.5' Close, 7 Volume"
    )
    fixed = conform(raw)
    assert fixed.schema == BARS or [f.dataType for f in fixed.schema] == [f.dataType for f in BARS]
    assert fixed.first()[:6] == ("A", date(2020, 2, 29), 1.0, 2.0, 3.0, 4.5)
    assert conform(fixed) is fixed


def test_conform_matches_names_whatever_their_case(spark):
    raw = spark.sql(
        "SELECT 'A' Company_Name, '2020-01-05' `date`, 1D open, 2D HIGH, 3D low, 4D close, 5L volume, 6 Rest"
    )
    fixed = conform(raw)
    assert fixed.columns == [*BARS.names, "Rest"]
    assert tuple(fixed.first()) == ("A", date(2020, 1, 5), 1.0, 2.0, 3.0, 4.0, 5, 6)


def test_argument_checks(make):
    assert as_date("2020-1-5") == as_date("2020-01-05") == as_date(datetime(2020, 1, 5, 9)) == date(2020, 1, 5)
    assert as_list("A") == ["A"] and as_list(2020) == [2020] and as_list(("A", "B")) == ["A", "B"]
    bars = make([bar()])
    for wrong in (
        lambda: as_date(5),
        lambda: as_date("05/01/2020"),
        lambda: check_price_type("High"),
        lambda: rsi(bars, window_size=0),
        lambda: between_dates(bars, "2020-02-01", "2020-01-01"),
        lambda: volume_ratio(bars, "2020-01-01", "2020-01-01", "2020-01-01"),
    ):
        with pytest.raises(ValueError):
            wrong()


def test_repeated_days(make):
    twice = make([bar(), bar(), bar(day="2020-01-02")])
    assert [(r.company_name, r.Date, r.n_rows) for r in repeated_days(twice).collect()] == [
        ("A", date(2020, 1, 1), 2)
    ]


TRADES = [
    # symbol, time, price, quantity, order, line
    ("A", "2020-01-01 09:00:00", 5.0, 1, 10, 2),
    ("A", "2020-01-01 23:59:59", 9.0, 2, 10, 1),
    ("A", "2020-01-01 12:00:00", 7.0, 3, 11, 1),
    ("A", "2020-01-01 12:00:00", 6.0, 4, 11, 1),
    ("A", "2020-01-02 00:00:00", 1.0, 5, 1, 1),
    ("B", "2020-01-01 00:00:00", 2.0, 6, 1, 1),
]


def roll_up(spark, order_by, rows=TRADES, **options):
    trades = spark.createDataFrame(rows, "s string, t string, p double, q bigint, o bigint, l int")
    bars = bars_from_trades(
        trades,
        symbol=F.col("s"),
        day=F.to_timestamp_ntz("t"),
        price=F.col("p"),
        quantity=F.col("q"),
        order_by=order_by,
        **options,
    )
    return {(r.company_name, r.Date.day): tuple(r)[2:] for r in bars.collect()}


def test_roll_up_orders_trades_and_breaks_ties_by_price(spark):
    expected = {
        ("A", 1): (9.0, 9.0, 5.0, 7.0, 10),
        ("A", 2): (1.0, 1.0, 1.0, 1.0, 5),
        ("B", 1): (2.0, 2.0, 2.0, 2.0, 6),
    }
    assert roll_up(spark, ["o", "l"]) == expected
    assert roll_up(spark, ["o", "l"], TRADES[::-1]) == expected


def test_roll_up_by_unique_order_agrees(spark):
    unique = [(s, t, p, q, n, l) for n, (s, t, p, q, _, l) in enumerate(TRADES)]
    assert roll_up(spark, ["o"], unique, unique_order=True) == roll_up(spark, ["o"], unique)
    with pytest.raises(ValueError):
        roll_up(spark, ["o", "l"], unique_order=True)


def test_csv_files_with_other_headers_are_an_error(spark, tmp_path):
    head = "company_name,Date,Open,Close,High,Low,Volume"
    (tmp_path / "a.csv").write_text(f"{head}\nA,2020-01-01,1,2,3,0,5\n")
    (tmp_path / "b.csv").write_text("company_name,Date,Close,Open,High,Low,Volume\nB,2020-01-01,2,1,3,0,5\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_bars(spark, f"{tmp_path}/*.csv").collect()


def test_dates_with_a_time_and_whole_volumes_with_a_point(spark):
    rows = [
        ("2020-01-02 00:00:00", "100.0"),
        ("2020-01-02T13:45:00.5Z", "9007199254740993"),
        ("2020-01-02", "1e3"),
        ("02.01.2020", "1.5"),
        ("2020-13-02", "many"),
        (None, None),
    ]
    raw = spark.createDataFrame([("A", d, "1", "1", "1", "1", v) for d, v in rows], "company_name string, Date string, Open string, High string, Low string, Close string, Volume string")
    got = conform(raw).collect()
    assert [str(r.Date) for r in got[:3]] == ["2020-01-02"] * 3 and [r.Date for r in got[3:]] == [None] * 3
    assert [r.Volume for r in got] == [100, 9007199254740993, 1000, None, None, None]
    counts = {r.column: r.unparsed for r in unparsed_values(raw).collect()}
    assert counts["Date"] == 2 and counts["Volume"] == 2 and counts["Open"] == 0 and len(counts) == 7
    assert {r.unparsed for r in unparsed_values(conform(raw)).collect()} == {0}


def test_columns_that_differ_in_case_only_are_an_error(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        raw = spark.createDataFrame([("A", "2020-01-01", 1.0, 1.0, 1.0, 1.0, 2.0, 1)], "company_name string, Date string, Open double, High double, Low double, Close double, close double, Volume int")
        with pytest.raises(ValueError, match="case"):
            conform(raw)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
