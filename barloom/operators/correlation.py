"""Pearson correlation between columns and between series."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.frames import dated
from barloom.functions.prices import ratio
from barloom.schema import as_list, named, numeric_columns

PAIRS_SCHEMA = "company_a string, company_b string"


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both sides are present and not NaN;
    NULL when one of them does not vary."""
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    x, y = F.when(both, x), F.when(both, y)
    return ratio(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(col_a, col_b, corr)`` for every ordered pair of numeric columns.

    Each pair is taken over the rows in which both are present and not NaN; NULL
    where one of them does not vary there. Every row is read once, as it is: a
    task holds the moments of all pairs in square arrays, fed by matrix products
    over batches of rows, and shuffles one record per pair. The same in built-in
    aggregates is a sum for every pair and moment, whose generated code took
    five times as long with eight columns.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    moments = df.select(*(named(name).cast("double").alias(f"c{k}") for k, name in enumerate(names))).mapInArrow(_moments(), MOMENTS)
    pair = Window.partitionBy("a", "b")

    def off(mean: str) -> Column:
        """Of a task's mean from that of all rows."""
        return F.col(mean) - ratio(F.sum(F.col("n") * F.col(mean)).over(pair), F.sum("n").over(pair))

    def total(spread: str, one: str, two: str) -> Column:
        return F.sum(F.col(spread) + F.col("n") * F.col(one) * F.col(two)).alias(spread)

    sums = (
        moments.withColumns({"off_a": off("mean_a"), "off_b": off("mean_b")})
        .groupBy("a", "b")
        .agg(total("var_a", "off_a", "off_a"), total("var_b", "off_b", "off_b"), total("cov", "off_a", "off_b"))
    )
    varies = (F.col("var_a") > 0) & (F.col("var_b") > 0)
    corr = F.when(varies, F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.col("cov") / F.sqrt("var_a") / F.sqrt("var_b")))
    # Each pair is computed once and reported in both orders.
    turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    orders = F.when(F.col("a") < F.col("b"), F.array(F.struct("a", "b"), turned)).otherwise(F.array(F.struct("a", "b")))
    labels = F.array(*map(F.lit, names))
    return sums.select(F.explode(orders).alias("p"), corr.alias("corr")).select(
        F.get(labels, F.col("p.a")).alias("col_a"), F.get(labels, F.col("p.b")).alias("col_b"), "corr"
    )


MOMENTS = "a int, b int, n long, mean_a double, mean_b double, var_a double, var_b double, cov double"


def _moments() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The moments of all pairs of columns in a task, as a function that travels without this package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each pair of columns a <= b: rows with both, their means there, and sums of squares and products around them."""
        count = mean = var = cov = None
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            if not len(x):
                continue
            there = ~np.isnan(x)
            mask = there.astype(np.float64)
            n = mask.T @ mask
            # First from a value of the batch, which leaves exact zeros where a column does not vary, then from the mean.
            start = np.where(there.any(0), x[there.argmax(0), np.arange(x.shape[1])], 0.0)
            x = np.where(there, x - start, 0.0)
            centre = x.sum(0) / np.maximum(n.diagonal(), 1)
            x = np.where(there, x - centre, 0.0)
            part_mean = np.repeat((start + centre)[:, None], len(n), axis=1)
            part_var = np.repeat((x * x).sum(0)[:, None], len(n), axis=1)
            part_cov = x.T @ x
            # Pairs that are not missing together have means of their own.
            for i, j in zip(*np.nonzero(np.triu((n < n.diagonal()) | (n < n.diagonal()[:, None])))):
                both = there[:, i] & there[:, j]
                if both.any():
                    for k, m in ((i, j), (j, i)):
                        own = x[both, k] - x[both, k][0]
                        part_mean[k, m] = start[k] + centre[k] + x[both, k][0] + own.mean()
                        part_var[k, m] = ((own - own.mean()) ** 2).sum()
                    one, two = (x[both, k] - x[both, k].mean() for k in (i, j))
                    part_cov[i, j] = part_cov[j, i] = one @ two
            if count is None:
                count, mean, var, cov = n, part_mean, part_var, part_cov
                continue
            away = np.where(count > 0, part_mean - mean, 0.0)
            total = np.maximum(count + n, 1)
            share = count * n / total
            var += part_var + away * away * share
            cov += part_cov + away * away.T * share
            mean = np.where(count > 0, mean + away * n / total, part_mean)
            count = count + n
        if count is not None:
            a, b = np.triu_indices(len(count))
            columns = [a.astype(np.int32), b.astype(np.int32), count[a, b].astype(np.int64), mean[a, b], mean[b, a], var[a, b], var[b, a], cov[a, b]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "n", "mean_a", "mean_b", "var_a", "var_b", "cov"])

    return run


def series_correlation(
    left: DataFrame, right: DataFrame, *, on: str | Sequence[str] = "Date", value: str = "Value"
) -> DataFrame:
    """Correlation of two value series over the keys they share, as one row.

    ``on`` names one or several key columns. A series has one value for each
    key: where rows repeat one, their mean counts, so the join multiplies none.
    """
    keys = as_list(on)

    def once(series: DataFrame, name: str) -> DataFrame:
        return series.groupBy(*keys).agg(F.avg(value).alias(name))

    return once(left, "a").join(once(right, "b"), keys).agg(pearson(F.col("a"), F.col("b")).alias("correlation"))


def pair_correlation(
    bars: DataFrame,
    pairs: DataFrame | Iterable[tuple[str, str]],
    value: str = "Close",
) -> DataFrame:
    """Correlation of the named pairs of companies over the dates they share.

    ``pairs`` is a list or a DataFrame ``(company_a, company_b)`` of any length,
    treated alike: pairs with a NULL name are dropped and repeated ones count
    once. A company has one value for each date: where bars repeat a day, their
    mean counts, taken in each task before anything is shuffled. The means of
    the companies that the pairs name are matched with the pairs and with each
    other by company and date. Whether the pairs are broadcast is left to
    Spark's own size check.
    """
    if not isinstance(pairs, DataFrame):
        pairs = bars.sparkSession.createDataFrame(list(pairs), T.StructType.fromDDL(PAIRS_SCHEMA))
    pairs = pairs.select("company_a", "company_b").dropna().distinct()

    def side(company: str, name: str) -> DataFrame:
        rows = dated(bars).select(F.col("company_name").alias(company), "Date", value)
        named_rows = rows.join(pairs.select(company).distinct(), company, "left_semi")
        return named_rows.groupBy("Date", company).agg(F.avg(value).alias(name))

    return (
        side("company_a", "a")
        .join(pairs, "company_a")
        .join(side("company_b", "b"), ["company_b", "Date"])
        .groupBy("company_a", "company_b")
        .agg(pearson(F.col("a"), F.col("b")).alias("correlation"))
    )
