"""The registered queries in SQL, written for DuckDB over the same tables.

They share nothing with the Spark side but parameters and column names.
"""

from __future__ import annotations

from itertools import combinations

from barloom.plans.queries import CHOSEN, CHOSEN_YEARS, PLACES, STATUSES

_TRADE_ORDER = "(l_orderkey, l_linenumber, l_extendedprice)"
_STATUS = "l_returnflag || '-' || l_linestatus"
_SUPPLIER = "CAST(l_suppkey AS VARCHAR)"
_BAR = "company_name, Date, Open, High, Low, Close, Volume"
_NUMERIC = ("Open", "High", "Low", "Close", "Volume")
_CHOSEN_SQL = (
    "company_name IN (" + ", ".join(f"'{c}'" for c in CHOSEN) + ")"
    " AND year(Date) IN (" + ", ".join(map(str, CHOSEN_YEARS)) + ")"
)
_IN_YEAR = "PARTITION BY company_name, year(Date) ORDER BY Date"
_BY_DATE = "PARTITION BY company_name ORDER BY Date"
_NEWEST = "PARTITION BY company_name ORDER BY Date DESC"
_RETURN = "(Close - Open) / nullif(Open, 0) * 100"


def _bars(symbol: str) -> str:
    return f"""bars AS (
  SELECT {symbol} AS company_name,
         CAST(l_shipdate AS DATE) AS Date,
         min_by(l_extendedprice, {_TRADE_ORDER}) AS Open,
         max(l_extendedprice) AS High,
         min(l_extendedprice) AS Low,
         max_by(l_extendedprice, {_TRADE_ORDER}) AS Close,
         CAST(sum(l_quantity) AS BIGINT) AS Volume
  FROM lineitem GROUP BY 1, 2)"""


_RAGGED_BARS = """bars AS (
  SELECT CASE WHEN l_linenumber <> 7 THEN l_returnflag || '-' || l_linestatus END AS company_name,
         CASE WHEN l_tax < 0.075 THEN CAST(l_shipdate AS DATE) END AS Date,
         l_extendedprice AS Open,
         l_extendedprice + l_quantity AS High,
         l_extendedprice - l_extendedprice * l_discount AS Low,
         l_extendedprice - l_extendedprice * l_tax AS Close,
         CAST(l_quantity AS BIGINT) AS Volume
  FROM lineitem)"""


# event_id is unique, so it orders the trades of a day by itself.
_EVENT_BARS = """bars AS (
  SELECT event_type AS company_name,
         CAST(ts AS DATE) AS Date,
         min_by(value, event_id) AS Open,
         max(value) AS High,
         min(value) AS Low,
         max_by(value, event_id) AS Close,
         count(*) AS Volume
  FROM events GROUP BY 1, 2)"""


def _r(expression: str, alias: str) -> str:
    return f"round({expression}, {PLACES}) AS {alias}"


def _describe(source: str, columns: tuple[str, ...], by: str = "") -> str:
    key = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"SELECT {key}'{c}' AS \"column\", count({c}) AS count, {_r(f'avg({c})', 'mean')}, "
        f"{_r(f'stddev_samp({c})', 'stddev')}, {_r(f'CAST(min({c}) AS DOUBLE)', 'min')}, "
        f"{_r(f'CAST(max({c}) AS DOUBLE)', 'max')} FROM {source}{group}"
        for c in columns
    )


def _pearson(x: str, y: str) -> str:
    pair = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    varies = f"stddev_samp({x}) {pair} > 0 AND stddev_samp({y}) {pair} > 0"
    return f"CASE WHEN {varies} THEN corr({x}, {y}) {pair} END"


def _correlations(source: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
        f"{_r(_pearson(f'CAST({a} AS DOUBLE)', f'CAST({b} AS DOUBLE)'), 'corr')} FROM {source}"
        for a in columns
        for b in columns
    )


def _missing(source: str, texts: tuple[str, ...], others: tuple[str, ...]) -> str:
    parts = [(c, f"{c} IS NULL OR {c} = ''") for c in texts]
    parts += [(c, f"{c} IS NULL") for c in others]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {absent}) AS missing FROM {source}"
        for c, absent in parts
    )


def _period(period: str) -> tuple[str, str]:
    """Select list and GROUP BY positions of a period."""
    columns = ["CAST(year(Date) AS INTEGER) AS Year"]
    if period == "Month":
        columns.append("CAST(month(Date) AS INTEGER) AS Month")
    if period == "Week":
        columns.append("CAST(week(Date) AS INTEGER) AS Week")
    return ", ".join(columns), ", ".join(str(n + 1) for n in range(len(columns)))


def _avg_prices(period: str) -> str:
    select, group = _period(period)
    return (
        f"SELECT {select}, company_name, {_r('avg(Open)', 'Avg_Open')}, "
        f"{_r('avg(Close)', 'Avg_Close')} FROM bars GROUP BY {group}, company_name"
    )


def _avg_return(period: str, where: str = "true") -> str:
    select, group = _period(period)
    return (
        f"SELECT {select}, company_name, {_r(f'avg({_RETURN})', f'Avg_Return_{period}')} "
        f"FROM bars WHERE {where} GROUP BY {group}, company_name"
    )


def _return_rates(where: str) -> str:
    opening, closing = "min_by(Open, Date)", "max_by(Close, Date)"
    return (
        f"SELECT company_name, ({closing} - {opening}) / nullif({opening}, 0) AS rate "
        f"FROM bars WHERE {where} GROUP BY company_name"
    )


def _return_rate(where: str) -> str:
    return f"SELECT company_name, {_r('rate', 'Return_Rate')} FROM ({_return_rates(where)})"


def _return_rate_labelled(where: str) -> str:
    return f"""SELECT company_name, {_r('rate', 'Return_Rate')},
  CASE WHEN rate = max(rate) OVER () THEN 'highest' WHEN rate < 0 THEN 'negative'
       WHEN rate > 0 THEN 'positive' ELSE 'none' END AS label
FROM ({_return_rates(where)})"""


def _label(gap: str) -> str:
    weeks = f"CAST(floor({gap} / 7.0) AS BIGINT)"
    days = f"({gap} - 7 * {weeks})"
    return f"""CASE WHEN {gap} IS NULL THEN NULL
  WHEN {gap} = 1 THEN '1 day' WHEN {gap} = 7 THEN '1 week'
  WHEN {gap} = 30 THEN '1 month' WHEN {gap} = 365 THEN '1 year'
  WHEN {weeks} > 0 AND {days} > 0 THEN {weeks} || ' weeks and ' || {days} || ' days'
  WHEN {weeks} > 0 THEN {weeks} || ' weeks' ELSE {days} || ' days' END"""


_SPACING = (
    f"SELECT {_BAR}, CAST(Date - lag(Date) OVER ({_BY_DATE}) AS INTEGER) AS gap_days FROM bars"
)
_BAR_SPACING = f"SELECT *, {_label('gap_days')} AS period FROM ({_SPACING})"
_SAMPLING_PERIOD = f"""SELECT company_name, gap_days, period, n_gaps FROM (
  SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY n_gaps DESC, gap_days) AS place
  FROM (SELECT company_name, gap_days, period, count(*) AS n_gaps FROM ({_BAR_SPACING})
        WHERE gap_days IS NOT NULL GROUP BY ALL)) WHERE place = 1"""

_DAILY_RETURN = f"SELECT {_BAR}, {_r(_RETURN, 'Daily_Return')} FROM bars"


def _highest(partition: str, keep_year: bool) -> str:
    year = "CAST(year(Date) AS INTEGER) AS Year, " if keep_year else ""
    return f"""SELECT {year}{_BAR}, {_r('ret', 'Daily_Return')} FROM (
  SELECT *, max(ret) OVER ({partition}) AS top FROM (SELECT *, {_RETURN} AS ret FROM bars))
WHERE ret = top"""


_FIRST_LAST = f"""SELECT {_BAR} FROM (SELECT *, row_number() OVER ({_BY_DATE}) AS n FROM bars) WHERE n <= 40
UNION ALL
SELECT {_BAR} FROM (SELECT *, row_number() OVER ({_BY_DATE}) AS n,
  count(*) OVER (PARTITION BY company_name) AS total FROM bars) WHERE n > total - 40"""

_ALL_CHANGES = f"""SELECT {_BAR},
  Close - lag(Close, 1) OVER ({_BY_DATE}) AS Price_Diff_Day,
  Close - lag(Close, 30) OVER ({_BY_DATE}) AS Price_Diff_Month
FROM bars"""
_CHANGES = f"{_ALL_CHANGES} WHERE Date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"
_PRICE_CHANGES = (
    f"SELECT {_BAR}, {_r('Price_Diff_Day', 'Price_Diff_Day')}, "
    f"{_r('Price_Diff_Month', 'Price_Diff_Month')} FROM ({_CHANGES})"
)

_ROLLING = (
    f"SELECT {_BAR}, {_r(f'avg(Close) OVER ({_BY_DATE} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)', 'moving_average')} "
    "FROM bars"
)


def _latest(start: str, n: int) -> str:
    return (
        f"SELECT * FROM (SELECT *, CAST(dense_rank() OVER ({_NEWEST}) AS INTEGER) AS rank "
        f"FROM bars WHERE Date < DATE '{start}') WHERE rank <= {n}"
    )


def _moving_average(start: str, n: int, price: str) -> str:
    return (
        f"SELECT company_name, {_r(f'avg({price})', 'moving_average')} "
        f"FROM ({_latest(start, n)}) GROUP BY company_name"
    )


def _bollinger(start: str, n: int, price: str) -> str:
    return f"""SELECT {_BAR}, rank, {_r('m', 'moving_average')}, {_r('s', 'std_dev')},
  {_r('m + 2 * s', 'upper_band')}, {_r('m - 2 * s', 'lower_band')}
FROM (SELECT *, avg({price}) OVER ({_NEWEST}) AS m, stddev_samp({price}) OVER ({_NEWEST}) AS s
      FROM ({_latest(start, n)}))"""


# Bars of one day follow each other by their values.
_TIES = ", ".join(f"{name} NULLS FIRST" for name in _NUMERIC)
_RAGGED_FIRST_LAST = f"""WITH placed AS (
  SELECT *, row_number() OVER ({_BY_DATE}, {_TIES}) AS n, count(*) OVER (PARTITION BY company_name) AS total
  FROM bars WHERE company_name IS NOT NULL AND Date IS NOT NULL)
SELECT {_BAR} FROM placed WHERE n <= 40
UNION ALL
SELECT {_BAR} FROM placed WHERE n > total - 40"""
_RAGGED_BANDS = f"""SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER ({_NEWEST}, {_TIES}) AS place FROM ({_bollinger('2000-01-01', 20, 'Close')}))
WHERE place <= 21 AND company_name IS NOT NULL"""

_FRAME = f"({_IN_YEAR} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)"
_RSI_RAW = f"""SELECT {_BAR}, 100 - 100 / (1 + gain / nullif(loss, 0)) AS RSI FROM (
  SELECT *,
    sum(CASE WHEN d > 0 THEN d ELSE 0 END) OVER {_FRAME} / 14 AS gain,
    sum(CASE WHEN d < 0 THEN -d ELSE 0 END) OVER {_FRAME} / 14 AS loss
  FROM (SELECT *, Close - lag(Close) OVER ({_IN_YEAR}) AS d FROM bars))"""
_RSI = f"SELECT {_BAR}, {_r('RSI', 'RSI')} FROM ({_RSI_RAW})"

_MFI_RAW = f"""SELECT {_BAR}, 100 - 100 / (1 + up / nullif(down, 0)) AS mfi FROM (
  SELECT *,
    sum(CASE WHEN tp > prev THEN tp * Volume ELSE 0 END) OVER ({_IN_YEAR}) AS up,
    sum(CASE WHEN tp < prev THEN tp * Volume ELSE 0 END) OVER ({_IN_YEAR}) AS down
  FROM (SELECT *, lag(tp) OVER ({_IN_YEAR}) AS prev
        FROM (SELECT *, (High + Low + Close) / 3 AS tp FROM bars)))"""
_MFI = f"SELECT {_BAR}, {_r('mfi', 'Money_Flow_Index')} FROM ({_MFI_RAW})"


def _signal(value: str, high: int, low: int) -> str:
    return (
        f"CASE WHEN {value} > {high} THEN 'overbought' WHEN {value} < {low} THEN 'oversold' "
        f"WHEN {value} IS NOT NULL THEN 'neutral' END AS signal"
    )


_SUPPORT_RESISTANCE = f"""WITH lagged AS (
  SELECT *, lag(Low) OVER ({_IN_YEAR}) AS low1, lag(Low, 2) OVER ({_IN_YEAR}) AS low2,
         lag(High) OVER ({_IN_YEAR}) AS high1, lag(High, 2) OVER ({_IN_YEAR}) AS high2 FROM bars)
SELECT company_name, Date, 'support' AS kind, Low AS price FROM lagged WHERE Low < low1 AND Low < low2
UNION ALL
SELECT company_name, Date, 'resistance' AS kind, High AS price FROM lagged
WHERE High > high1 AND High > high2"""


def _fibonacci(keys: str) -> str:
    steps = (("23.6%", 0.236), ("38.2%", 0.382), ("50.0%", 0.5), ("61.8%", 0.618))
    grouped = (
        "SELECT company_name, CAST(year(Date) AS INTEGER) AS Year, Low, High FROM bars"
    )
    ranges = f"SELECT {keys}, min(Low) AS lo, max(High) AS hi FROM ({grouped}) GROUP BY {keys}"
    rows = [
        f"SELECT {keys}, '{name}' AS level, {_r(f'lo + (hi - lo) * CAST({share} AS DOUBLE)', 'price')} "
        f"FROM ({ranges})"
        for name, share in steps
    ]
    rows.append(f"SELECT {keys}, '100.0%' AS level, hi AS price FROM ({ranges})")
    return " UNION ALL ".join(rows)


_OVERLAY = f"""SELECT b.company_name, b.Date, CAST(year(b.Date) AS INTEGER) AS Year, b.Close, f.level, f.price
FROM bars b JOIN ({_fibonacci('company_name, Year')}) f
  ON b.company_name = f.company_name AND year(b.Date) = f.Year"""

_VOLUME_RATIO = f"""SELECT company_name, target_volume, {_r('average_volume', 'average_volume')},
  {_r('target_volume / nullif(average_volume, 0)', 'volume_ratio')}
FROM (SELECT company_name, max(Volume) FILTER (WHERE Date = DATE '1999-06-30') AS target_volume,
             avg(Volume) FILTER (WHERE Date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31')
               AS average_volume
      FROM bars GROUP BY company_name)
WHERE target_volume IS NOT NULL"""

_RANGE_CHANGE = f"""SELECT s.company_name, s.Close AS start_close, e.Close AS end_close,
  {_r('e.Close - s.Close', 'absolute_change')},
  {_r('(e.Close - s.Close) / nullif(s.Close, 0) * 100', 'percentage_change')}
FROM bars s JOIN bars e ON s.company_name = e.company_name
WHERE s.Date = DATE '1998-12-31' AND e.Date = DATE '1999-12-30'"""

_PAIRS = ", ".join(f"('{a}', '{b}')" for a, b in combinations(STATUSES, 2))
_PAIR_CORRELATION = f"""SELECT x.company_name AS company_a, y.company_name AS company_b,
  {_r(_pearson('x.Close', 'y.Close'), 'correlation')}
FROM bars x JOIN bars y ON x.Date = y.Date
WHERE (x.company_name, y.company_name) IN ({_PAIRS}) GROUP BY 1, 2"""

_RAGGED_PAIRS = f"""WITH days AS (SELECT company_name, Date, avg(Close) AS Close FROM bars GROUP BY ALL)
{_PAIR_CORRELATION.replace('bars x', 'days x').replace('bars y', 'days y')}"""


def _price_wide(companies: tuple[str, ...], price: str, where: str) -> str:
    columns = ", ".join(
        f"max({price}) FILTER (WHERE company_name = '{c}') AS \"{c} {price}\"" for c in companies
    )
    return f"SELECT Date, {columns} FROM bars WHERE {where} GROUP BY Date"


def _return_wide(companies: tuple[str, ...], period: str, where: str) -> str:
    select, group = _period(period)
    columns = []
    for c in companies:
        mean = f"avg({_RETURN}) FILTER (WHERE company_name = '{c}')"
        columns.append(_r(mean, f'"{c} Avg_Return"'))
    return f"SELECT {select}, {', '.join(columns)} FROM bars WHERE {where} GROUP BY {group}"


_ALL = "company_name IN (" + ", ".join(f"'{c}'" for c in STATUSES) + ")"

_OVER_STATUS: dict[str, str] = {
    "num_observations": "SELECT count(*) AS num_observations FROM bars",
    "describe_numeric": _describe("bars", _NUMERIC),
    "describe_by_company": _describe("bars", _NUMERIC, "company_name"),
    "missing_values": _missing("bars", ("company_name",), ("Date", *_NUMERIC)),
    "missing_values_price_changes": _missing(
        f"({_ALL_CHANGES})",
        ("company_name",),
        ("Date", *_NUMERIC, "Price_Diff_Day", "Price_Diff_Month"),
    ),
    "correlation_matrix": _correlations("bars", _NUMERIC),
    "correlation_matrix_price_changes": _correlations(
        f"({_ALL_CHANGES})", (*_NUMERIC, "Price_Diff_Day", "Price_Diff_Month")
    ),
    "pair_correlation": _PAIR_CORRELATION,
    "series_correlation": f"""SELECT {_r(_pearson('x.Close', 'y.Close'), 'correlation')}
FROM bars x JOIN bars y ON x.Date = y.Date
WHERE x.company_name = '{CHOSEN[0]}' AND y.company_name = '{CHOSEN[1]}'""",
    "distinct_companies": "SELECT DISTINCT company_name FROM bars",
    "distinct_years": "SELECT CAST(year(Date) AS INTEGER) AS Year, count(*) AS n_bars FROM bars GROUP BY 1",
    "distinct_years_by_company": (
        "SELECT company_name, CAST(year(Date) AS INTEGER) AS Year, count(*) AS n_bars "
        "FROM bars GROUP BY 1, 2"
    ),
    "available_dates": "SELECT DISTINCT Date FROM bars",
    "date_coverage": (
        "SELECT company_name, min(Date) AS first_date, max(Date) AS last_date, "
        "count(DISTINCT Date) AS n_dates FROM bars GROUP BY company_name"
    ),
    "date_coverage_overall": (
        "SELECT min(Date) AS first_date, max(Date) AS last_date, "
        "count(DISTINCT Date) AS n_dates FROM bars"
    ),
    "deduce_period": f"SELECT {_BAR}, {_label('gap')} AS period FROM "
    "(SELECT *, Date - DATE '1998-07-01' AS gap FROM bars)",
    "sampling_period": _SAMPLING_PERIOD,
    "filter_company_year": f"SELECT {_BAR} FROM bars WHERE {_CHOSEN_SQL}",
    "avg_prices_year": _avg_prices("Year"),
    "avg_prices_month": _avg_prices("Month"),
    "avg_prices_week": _avg_prices("Week"),
    "range_change": _RANGE_CHANGE,
    "daily_return": _DAILY_RETURN,
    "daily_return_series": (
        f"SELECT Date, {_r(_RETURN, 'Daily_Return')}, company_name, "
        f"CAST(year(Date) AS INTEGER) AS year FROM bars WHERE {_CHOSEN_SQL}"
    ),
    "avg_return_year": _avg_return("Year"),
    "avg_return_month": _avg_return("Month"),
    "avg_return_week": _avg_return("Week"),
    "avg_return_month_selected": _avg_return("Month", _CHOSEN_SQL),
    "highest_daily_return": _highest("PARTITION BY year(Date)", True),
    "highest_daily_return_overall": _highest("", False),
    "return_rate_year": _return_rate("year(Date) = 1998"),
    "return_rate_month": _return_rate("year(Date) = 1999 AND month(Date) = 2"),
    "return_rate_week": _return_rate(
        "year(Date) = 1999 AND week(Date) = week(DATE '1999-02-26') AND Date < DATE '1999-03-05'"
    ),
    "return_rate_week_new_year": _return_rate(
        "year(Date) = 2000 AND week(Date) = week(DATE '2000-12-25') AND Date < DATE '2001-01-01'"
    ),
    "return_rate_labelled": _return_rate_labelled("year(Date) = 1999 AND month(Date) = 2"),
    "first_last_rows": _FIRST_LAST,
    "price_changes": _PRICE_CHANGES,
    "moving_average_asof": _moving_average("2000-01-01", 20, "Close"),
    "moving_average_asof_open": _moving_average("1998-02-10", 50, "Open"),
    "moving_average_rolling": _ROLLING,
    "rsi": _RSI,
    "rsi_signal": f"SELECT {_BAR}, {_r('RSI', 'RSI')}, {_signal('RSI', 70, 30)} FROM ({_RSI_RAW})",
    "price_changes_by_span": _PRICE_CHANGES,
    "moving_average_rolling_by_span": _ROLLING,
    "bollinger_bands_by_day": _bollinger("2000-01-01", 20, "Close"),
    "bollinger_bands": _bollinger("2000-01-01", 20, "Close"),
    "bollinger_bands_open": _bollinger("1998-02-10", 50, "Open"),
    "money_flow_index": _MFI,
    "mfi_signal": (
        f"SELECT {_BAR}, {_r('mfi', 'Money_Flow_Index')}, {_signal('mfi', 80, 20)} FROM ({_MFI_RAW})"
    ),
    "support_resistance": _SUPPORT_RESISTANCE,
    "fibonacci_levels": _fibonacci("company_name, Year"),
    "fibonacci_levels_overall": _fibonacci("company_name"),
    "fibonacci_overlay": _OVERLAY,
    "volume_ratio": _VOLUME_RATIO,
    "price_series_wide": _price_wide(STATUSES, "Close", _ALL),
    "price_series_wide_open": _price_wide(CHOSEN, "Open", _CHOSEN_SQL),
    "avg_return_wide": _return_wide(STATUSES, "Month", _ALL),
    "avg_return_wide_week": _return_wide(CHOSEN, "Week", _CHOSEN_SQL),
}

_OVER_SUPPLIERS: dict[str, str] = {
    "supplier_daily_return": _DAILY_RETURN,
    "supplier_describe_by_company": _describe("bars", _NUMERIC, "company_name"),
    "supplier_avg_return_week": _avg_return("Week"),
    "supplier_highest_daily_return": _highest("PARTITION BY year(Date)", True),
    "supplier_return_rate_labelled": _return_rate_labelled("year(Date) = 1998"),
    "supplier_first_last_rows": _FIRST_LAST,
    "supplier_price_changes": _PRICE_CHANGES,
    "supplier_moving_average_asof": _moving_average("2000-01-01", 20, "Close"),
    "supplier_moving_average_rolling": _ROLLING,
    "supplier_price_changes_by_span": _PRICE_CHANGES,
    "supplier_moving_average_rolling_by_span": _ROLLING,
    "supplier_rsi": _RSI,
    "supplier_bollinger_bands": _bollinger("2000-01-01", 20, "Close"),
    "supplier_money_flow_index": _MFI,
    "supplier_support_resistance": _SUPPORT_RESISTANCE,
    "supplier_fibonacci_overlay": _OVERLAY,
    "supplier_bar_spacing": _BAR_SPACING,
    "supplier_sampling_period": _SAMPLING_PERIOD,
}

_OVER_RAGGED: dict[str, str] = {
    "ragged_pair_correlation": _RAGGED_PAIRS,
    "ragged_highest_daily_return": f"SELECT * FROM ({_highest('PARTITION BY year(Date)', True)}) WHERE Year IS NOT NULL",
    "ragged_first_last_rows": _RAGGED_FIRST_LAST,
    "ragged_moving_average_asof": f"SELECT * FROM ({_moving_average('2000-01-01', 20, 'Close')}) WHERE company_name IS NOT NULL",
    "ragged_bollinger_bands": _RAGGED_BANDS,
}

_OVER_EVENTS: dict[str, str] = {
    "event_bars": f"SELECT {_BAR} FROM bars",
    "event_daily_return": _DAILY_RETURN,
    "event_avg_prices_week": _avg_prices("Week"),
    "event_rsi": _RSI,
    "event_money_flow_index": _MFI,
    "event_support_resistance": _SUPPORT_RESISTANCE,
}

_LINEITEM_NUMERIC = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)

_OVER_TABLES: dict[str, str] = {
    "describe_numeric_lineitem": _describe("lineitem", _LINEITEM_NUMERIC),
    "describe_numeric_events_by_type": _describe("events", ("event_id", "user_id", "value"), "event_type"),
    "correlation_matrix_lineitem": _correlations("lineitem", _LINEITEM_NUMERIC),
    "missing_values_documents": _missing(
        "documents", ("text", "lang", "source"), ("doc_id", "n_chars")
    ),
}


def _with(bars: str, query: str) -> str:
    if query.startswith("WITH "):
        return f"WITH {bars}, {query[len('WITH '):]}"
    return f"WITH {bars}\n{query}"


def all_sql() -> dict[str, str]:
    sql = {name: _with(_bars(_STATUS), query) for name, query in _OVER_STATUS.items()}
    sql |= {name: _with(_bars(_SUPPLIER), query) for name, query in _OVER_SUPPLIERS.items()}
    sql |= {name: _with(_RAGGED_BARS, query) for name, query in _OVER_RAGGED.items()}
    sql |= {name: _with(_EVENT_BARS, query) for name, query in _OVER_EVENTS.items()}
    return sql | _OVER_TABLES
