"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node of ``edges``; component is the smallest node reachable.

    Alternates two steps until nothing changes: every node hands the smallest of its neighbours
    to its larger neighbours, then to its smaller ones. The number of rounds grows with the
    logarithm of the longest path. A node with very many edges is no hot spot: its smallest
    neighbour is combined before the shuffle, and the join that hands it on may be split.
    Each round is checkpointed. Rows with a NULL end and self-loops say nothing and are left out,
    repeated edges count once; no edges give no rows.
    """
    a, b = F.col(src), F.col(dst)
    links = (
        edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    links = durable(links)
    mark = _mark(links)
    while mark[0]:
        links = durable(_small_star(_large_star(links)))
        before, mark = mark, _mark(links)
        if mark == before:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """Count and order-free digest of the edges: equal for equal sets."""
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
    ).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u != v")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).filter("u != v").distinct()
