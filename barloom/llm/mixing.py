"""Mixing sources to target weights by capped water-filling.

The mix has a budget of words that sources share by weight. No source gives more than ``max_epochs``
times its words: what a source cannot give is shared out again among the rest by their weights until
no source is above its cap. A target of e epochs repeats every document floor(e) times in full; the
fractional repetition goes to documents in the order of a seeded hash until the target is met, the
last of them in part. The order comes from two levels of hash cells whose sizes are added up before
any shuffle, so a source with a third of all rows is neither sorted nor gathered in one task, and
reruns agree whatever the partitioning.

Edge cases: NULL or blank texts have size 0 and nothing is taken of them. NULL is a source of its
own, ordered last. Equal rows fall into one hash cell; the cell at the edge of the target is taken
in equal parts. An empty table gives an empty result. Extra columns are ignored, or carried by
``mixed_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import WORD, durable, sized, word_count
from barloom.schema import named as column

SEED = 42
# The seeded order is one of digits of so many bits, two from each of so many hashes.
DIGIT, HASHES = 12, 3
CELLS = 1 << DIGIT


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source, size) with ``place``, from 0 by code point, NULL last.

    Numbered per range partition, then offset by the partitions before: sources may be many.
    """
    sorted_rows = durable(
        sizes.withColumn("_null", F.col("source").isNull())
        .repartitionByRange("_null", "source")
        .withColumn("_part", F.spark_partition_id())
    )
    per_part = sorted_rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy("_null", "source")
    return (
        sorted_rows.withColumn("_row", F.row_number().over(inside))
        .join(offsets, "_part")
        .withColumn("place", F.col("_before") + F.col("_row") - 1)
        .select("source", "size", "place")
    )


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """``sources`` (source, size, weight) with ``target``: shares of ``budget``, capped.

    The level is the words a unit of weight gets. Each round clamps the sources that the level
    carries above their cap and shares the rest of the budget again; it ends when none is above.
    Only sums come to the driver.
    """
    cap = F.col("size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(full, cap).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(full).alias("clamped"),
        ).first()
        if row.clamped == clamped:
            break
        clamped = row.clamped
        if not row.open:
            break
        level = max(level, (budget - row.fixed) / row.open)
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _order(seed: int, id_col: str) -> Column:
    """Place of every row in the seeded order: numbers below ``CELLS``, the first ones of more weight.

    Hashes of id and text come first, so that the place follows from the row; a number of the row in
    its partition only parts rows that are equal in both.
    """
    hashes = [F.xxhash64(F.lit(seed + k), F.col(id_col), F.col("text")) for k in range(2)]
    hashes.append(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()))
    digits = [F.shiftrightunsigned(h, 64 - DIGIT * (k + 1)) % CELLS for h in hashes for k in range(2)]
    return F.array(*(d.cast("int") for d in digits))


def _plan(rows: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """A row for each source: words, target, whole repetitions, and where the fractional one ends.

    ``rows`` has (source, size, order). Documents before ``__edge`` in the seeded order get a
    fractional repetition in full, those at it the share ``__part``. The edge is found digit by digit:
    the words of all cells of a digit are added up, and the next digit only looks at the rows of the
    cell in which the target is met, until that is one row or no digit is left.
    """
    targets = durable(_targets(rows, weights, share, max_epochs))
    named = _by_source(rows, targets)
    edges = targets.select("__source", F.array().cast("array<int>").alias("__edge"), F.col("__extra").alias("goal"))
    ends = None
    for digit in range(2 * HASHES):
        inside = _by_source(named.select("source", "size", "order"), edges).filter(F.slice("order", 1, digit) == F.col("__edge"))
        cells = (
            inside.withColumn("cell", F.col("order")[digit])
            .groupBy("source", "cell")
            .agg(F.sum("size").alias("n"), F.count_if(F.col("size") > 0).alias("rows"), F.first("goal").alias("goal"), F.first("__edge").alias("__edge"))
        )
        before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        met = (
            cells.withColumn("done", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .filter("n > 0 and done < goal and done + n >= goal")
            .select(
                F.col("source").alias("__source"),
                F.concat("__edge", F.array("cell")).alias("__edge"),
                (F.col("goal") - F.col("done")).alias("goal"),
                ((F.col("goal") - F.col("done")) / F.col("n")).alias("__part"),
                "rows",
            )
        )
        met = durable(met)
        ended = met if digit == 2 * HASHES - 1 else met.filter("rows = 1")
        ended = ended.select(F.col("__source").alias("source"), "__edge", "__part")
        ends = ended if ends is None else ends.unionByName(ended)
        edges = met.filter("rows > 1").select("__source", "__edge", "goal")
        if edges.isEmpty():
            break
    return durable(
        targets.join(ends, targets["__source"].eqNullSafe(ends["source"]), "left").select(
            "__source", "__source_size", "__target", "__whole", "__edge", "__part"
        )
    )


def _by_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with the row of their source, which ``table`` has under ``__source``."""
    return rows.join(sized(table), rows["source"].eqNullSafe(table["__source"])).drop("__source")


def _taken() -> Column:
    place = F.slice("order", F.lit(1), F.size("__edge"))
    part = F.when(place < F.col("__edge"), 1.0).when(place == F.col("__edge"), F.col("__part")).otherwise(0.0)
    return (F.col("size") * F.col("__whole") + F.round(F.col("size") * F.coalesce(part, F.lit(0.0)))).cast("long")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = SEED,
    id_col: str = "doc_id",
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of ``docs``.

    Sources in order weigh ``weights``, repeating, and share ``share`` times all words.
    """
    rows = durable(docs.select(F.col(id_col).alias("doc_id"), "source", word_count("text").alias("size"), _order(seed, id_col).alias("order")))
    return _by_source(rows, _plan(rows, weights, share, max_epochs)).select(
        "doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), _taken().alias("taken")
    )


def _targets(rows: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """Per source its words, target, whole repetitions and the words of the fractional one."""
    sources = durable(ranked_sources(rows.groupBy("source").agg(F.sum("size").alias("size"))))
    total = sources.agg(F.sum("size")).first()[0] or 0
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int"))
    filled = water_fill(sources.withColumn("weight", weight), share * total, max_epochs)
    epochs = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0)
    return filled.select(
        F.col("source").alias("__source"),
        F.col("size").alias("__source_size"),
        F.col("target").alias("__target"),
        F.floor(epochs).alias("__whole"),
        (F.col("target") - F.floor(epochs) * F.col("size")).alias("__extra"),
    )


def mixed_rows(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = SEED,
    id_col: str = "doc_id",
) -> DataFrame:
    """The mix itself: a row of ``docs`` for each repetition, numbered by ``repetition`` from 1.

    A last repetition in part holds the leading words of the text. Rows of which nothing is taken
    are left out. A column ``repetition`` that ``docs`` has is replaced. Texts are not shuffled: a
    document only needs the row of its source.
    """
    columns = [c for c in docs.columns if c.lower() != "repetition"]
    # All columns travel in one, so that their names do not meet those used here.
    placed = docs.select(
        F.struct(*map(column, columns)).alias("row"), "source", F.col("text").cast("string"), word_count("text").alias("size"), _order(seed, id_col).alias("order")
    )
    plan = _plan(durable(placed.select("source", "size", "order")), weights, share, max_epochs)
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    left = F.col("taken") - (F.col("repetition") - 1) * F.col("size")
    text = F.when(left >= F.col("size"), F.col("text")).otherwise(leading_words(F.col("text"), left.cast("int")))
    return (
        _by_source(placed, plan)
        .withColumn("taken", _taken())
        .filter("taken > 0")
        .withColumn("repetition", F.explode(F.sequence(F.lit(1), times)))
        .select(*((text if c == "text" else F.col("row")[c]).alias(c) for c in columns), "repetition")
    )


def leading_words(text: Column, n: Column) -> Column:
    """The first ``n`` words, joined by blanks."""
    return F.concat_ws(" ", F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, n))
