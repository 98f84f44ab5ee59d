"""Runs the registered queries and their SQL twins and reports differences.

    python tests/compare.py [--exact] /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


LAST_PLACE = 1.5e-6


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def normal(value):
    """NaN made comparable and -0.0 made 0.0; nothing else is touched."""
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def as_rows(columns: list[str], rows) -> list[tuple]:
    """Columns in order of name; rows sorted, by their exact columns first."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(row[i]) for i in order) for row in rows]

    def place(row):
        exact = tuple((v is None, str(v)) for v in row if not isinstance(v, float))
        return exact, tuple(str(v) for v in row if isinstance(v, float))

    return sorted(out, key=place)


def close(a: tuple, b: tuple) -> bool:
    """Equal up to one unit of the last rounded place in doubles.

    Both engines round the same sum, but where it lies on the edge between two
    roundings the order of addition decides.
    """
    return all(
        abs(x - y) <= LAST_PLACE if isinstance(x, float) and isinstance(y, float) else x == y
        for x, y in zip(a, b)
    )


def differences(df, relation, exact: bool = False) -> str | None:
    """What differs between a Spark and a DuckDB result, or None."""
    spark_columns, sql_columns = list(df.columns), list(relation.columns)
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(spark_columns)} != {sorted(sql_columns)}"
    mine = as_rows(spark_columns, df.collect())
    theirs = as_rows(sql_columns, relation.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b and (exact or not close(a, b))]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, first: {bad[0][0]} != {bad[0][1]}"
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    expected = {
        "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
        "date": "DATE", "boolean": "BOOLEAN",
    }
    found = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    wrong = {c: (t, found[c]) for c, t in types.items() if expected.get(t, t) != found[c]}
    return f"types differ: {wrong}" if wrong else None


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    arguments = [a for a in sys.argv[1:] if a != "--exact"]
    exact, sf_dir, names = "--exact" in sys.argv, arguments[0], arguments[1:]
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            problem = differences(query(spark, sf_dir), db.sql(sql[name]), exact)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}")
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
