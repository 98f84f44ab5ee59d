"""Bars from CSV, Excel or Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.schema import conform

# Fixed value: data source name of the Excel connector a user may supply.
EXCEL_FORMAT = "com.crealytics.spark.excel"


def read_bars(
    spark: SparkSession,
    path: str,
    file_type: str | None = None,
    *,
    infer_schema: bool = False,
) -> DataFrame:
    """Read bars from a file, folder or glob and bring them to the bars schema.

    ``file_type`` is ``csv``, ``xlsx`` or ``parquet``; left out, it is the text
    after the last dot of ``path``, case-sensitive. CSV columns are found by
    the names in the header, which must be the same, in the same order, in all
    files of a folder or glob: reading one that differs is an error. They are
    cast, so no pass over the data is needed to learn types; ``infer_schema``
    asks for that pass, to type further columns too. ``schema.unparsed_values``
    counts what the casts could not read.
    """
    kind = path.rsplit(".", 1)[-1] if file_type is None else file_type
    if kind == "csv":
        raw = spark.read.csv(path, header=True, inferSchema=infer_schema, enforceSchema=False)
    elif kind == "xlsx":
        raw = _read_excel(spark, path)
    elif kind == "parquet":
        raw = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported file type {kind!r}: expected csv, xlsx or parquet")
    return conform(raw)


def _read_excel(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.format(EXCEL_FORMAT).options(header="true", inferSchema="true")
    try:
        return reader.load(path)
    except Exception as error:  # a missing connector surfaces as a bare JVM error
        if "DATA_SOURCE_NOT_FOUND" in str(error):
            raise RuntimeError(
                f"reading xlsx needs the {EXCEL_FORMAT} connector; add its jar to the "
                "session (spark.jars.packages) or save the sheet as csv"
            ) from error
        raise
