"""Exact comparison of rows in tiles, for keys that any number of rows may share.

Rows are compared if they share a cell. A cell of up to ``TILE`` rows is one unit of work. A larger
one is cut into tiles of about ``TILE`` rows each, by band and then by hash, and each pair of its
tiles whose bands lie within ``reach`` is a unit of its own: work on a crowded cell spreads over
many tasks, none of which holds more than two tiles. Pairs are compared inside a unit with numpy
and never become rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable

# Rows of a tile. A unit holds two at most.
TILE = 2048
# Crowded cells up to this many are broadcast; more are joined by a shuffle.
BROADCAST_CELLS = 20_000


def tile_units(rows: DataFrame, cell: list[str], payload: list[str], salt: Column, reach: int, tile: int = TILE) -> DataFrame:
    """Units of work from ``rows`` (cell columns, ``band`` int, payload columns).

    Gives ``cell columns, left array<struct<payload>>, right array<struct<payload>>``. In a unit of
    one tile ``right`` is NULL and rows of ``left`` are to be compared with each other; else each
    row of ``left`` with each of ``right``. Every pair of rows that shares a cell and whose bands
    differ by ``reach`` at most meets in exactly one unit. ``salt`` spreads the rows of a band over
    its tiles and should differ between rows. Only rows of crowded cells are shuffled twice.
    """
    crowded = durable(
        rows.groupBy(*cell, "band")
        .agg(F.count("*").alias("n"))
        .groupBy(*cell)
        .agg(
            F.sum("n").alias("total"),
            F.collect_list(F.struct("band", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))).alias("bands"),
        )
        .filter(F.col("total") > tile)
        .drop("total")
    )
    side = F.broadcast(crowded) if crowded.count() <= BROADCAST_CELLS else crowded
    item = F.struct(*payload)

    small = (
        rows.join(side.select(*cell), cell, "left_anti").groupBy(*cell).agg(F.collect_list(item).alias("left")).filter(F.size("left") > 1)
    )
    small = small.withColumn("right", F.lit(None).cast(small.schema["left"].dataType))

    own = F.expr("filter(bands, b -> b.band = band)[0].tiles")
    near = F.expr(
        f"""flatten(transform(filter(bands, b -> abs(b.band - band) <= {reach}),
            b -> transform(sequence(0, b.tiles - 1), s -> struct(b.band as band, s as part))))"""
    )
    cut = (
        rows.join(side, cell)
        .withColumn("part", F.pmod(salt, own).cast("int"))
        .groupBy(*cell, "band", "part")
        .agg(F.first("bands").alias("bands"), F.collect_list(item).alias("rows"))
        .withColumn("me", F.struct("band", "part"))
        .withColumn("other", F.explode(near))
    )
    pairs = (
        cut.select(
            *cell,
            F.least("me", "other").alias("low"),
            F.greatest("me", "other").alias("high"),
            (F.col("me") <= F.col("other")).alias("first"),
            "rows",
        )
        .groupBy(*cell, "low", "high")
        .agg(
            F.first(F.when(F.col("first"), F.col("rows")), ignorenulls=True).alias("left"),
            F.first(F.when(~F.col("first"), F.col("rows")), ignorenulls=True).alias("right"),
        )
        # Two tiles meet only if both have rows: hashing may leave one empty.
        .filter(F.col("left").isNotNull() & (F.col("right").isNotNull() | (F.col("low") == F.col("high"))))
    )
    return small.unionByName(pairs.select(*cell, "left", "right"))
