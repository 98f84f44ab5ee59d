"""SimHash near-duplicates by tiled exact comparison of fingerprints.

A fingerprint has a 1 where more than half of a text's shingle hashes have one. Fingerprints are
compared exactly, with numpy exclusive-or and bit counts over tiles (``tiles``), and tiles whose
population counts differ by more than the radius are skipped. What shares a tile is chosen so that
no close pair is lost: two fingerprints within radius r agree on at least one of r + 1 bit segments.
Copies of one fingerprint are collapsed before anything is compared, and links inside a unit of work
leave it as a spanning forest, never as all pairs.

Edge cases: a NULL or blank text has no shingle and fingerprint zero, linked like any other. A very
long text is hashed whole, ``BLOCK`` shingles at a time. Rows that repeat a doc_id share its
fingerprint rows; a NULL doc_id gets a fingerprint and the component of its equals, but names no
component. Extra columns are ignored, or carried by ``keep_one_each`` whatever their names; empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable, sized, unused
from barloom.llm.components import connected_components
from barloom.llm.tiles import tile_units

SEED = 42
# Shingles whose bits are counted at once: bounds the memory for one very long text.
BLOCK = 1 << 15


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each run of ``words`` words, repeats included; of the whole text if it has fewer.

    A-Z are lower-cased; bytes.split() parts words at exactly the ASCII white space.
    """
    parts = (text or "").encode().lower().split()
    digest = xxhash.xxh64_intdigest
    if len(parts) > words:
        runs = map(b" ".join, zip(*(parts[k:] for k in range(words))))
    else:
        runs = [b" ".join(parts)] if parts else []
    return np.fromiter((digest(run, SEED) for run in runs), dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> np.uint64:
    """Majority bits of the hashes; zero for no hash."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = np.ascontiguousarray(hashes[at : at + BLOCK]).astype("<u8", copy=False)
        ones += np.unpackbits(block.view(np.uint8).reshape(len(block), -1), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, fp)`` for every row: md5 of the text, and the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t.as_py(), words)) for t in batch.column(2)]
            fps = pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], fps], names=["doc_id", "text_key", "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("text_key"), text.alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, text_key string, fp long")


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def forest(n: int, close: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of ``n`` nodes under blocks of linked pairs."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for one, two in close:
        for a, b in zip(one.tolist(), two.tolist(), strict=True):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                edges.append((a, b))
    return edges


def bits_apart(radius: int) -> Column:
    """The radius + 1 segments of ``fp`` as (segment number, value)."""
    cuts = [round(k * 64 / (radius + 1)) for k in range(radius + 2)]
    return F.array(
        *(
            F.struct(
                F.lit(k).alias("segment"),
                F.expr(f"shiftrightunsigned(fp, {low}) & {(1 << (high - low)) - 1}L" if high - low < 63 else "fp").alias("bits"),
            )
            for k, (low, high) in enumerate(zip(cuts, cuts[1:]))
        )
    )


def link_fingerprints(fps: DataFrame, radius: int = 2) -> DataFrame:
    """``(src, dst)``: spanning links of distinct ``fp`` values at most ``radius`` bits apart."""
    rows = (
        fps.select("fp")
        .distinct()
        .select("fp", F.bit_count("fp").alias("band"), F.explode(bits_apart(radius)).alias("s"))
        .select("fp", "band", "s.segment", "s.bits")
    )
    units = tile_units(rows, ["segment", "bits"], ["fp"], F.xxhash64("fp"), radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                left, right = _values(batch, "left", at), _values(batch, "right", at)
                nodes, edges = _close_in_unit(left, right, radius)
                if edges:
                    one, two = np.array(edges).T
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[one]), pa.array(nodes[two])], names=["src", "dst"])

    return units.select("left", "right").mapInArrow(run, "src long, dst long").distinct()


def _values(batch: pa.RecordBatch, column: str, at: int) -> np.ndarray | None:
    value = batch.column(column)[at]
    return value.values.field("fp").to_numpy(zero_copy_only=False) if value.is_valid else None


def _close_in_unit(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    nodes = left if right is None else np.concatenate([left, right])
    x = nodes.view(np.uint64)
    order = np.argsort(np.bitwise_count(x), kind="stable")
    if right is None:
        ones, twos = order, order
    else:
        ones, twos = order[order < len(left)], order[order >= len(left)]

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        count = np.bitwise_count(x).astype(np.int64)
        for at in range(0, len(ones), 256):
            block = ones[at : at + 256]
            # Sorted by population count: rows whose counts differ beyond the radius are skipped.
            low = np.searchsorted(count[twos], count[block[0]] - radius, "left")
            high = np.searchsorted(count[twos], count[block[-1]] + radius, "right")
            if right is None:
                low = max(low, at)
            other = twos[low:high]
            close = np.bitwise_count(x[block][:, None] ^ x[other][None, :]) <= radius
            i, j = np.nonzero(close)
            yield block[i], other[j]

    return nodes, forest(len(nodes), pairs())


def near_duplicate_fingerprints(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, fp, group, component_id)`` for every row of ``docs``.

    Links of ``radius`` bits or fewer make a group; ``group`` is its smallest fingerprint,
    component_id its smallest doc_id, NULL only where no row of the group has one.
    """
    marked = durable(fingerprints(docs, words, id_col, text_col))
    values = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    # Labels of a component are its smallest fingerprint; only linked fingerprints have one.
    linked = durable(connected_components(link_fingerprints(values, radius)))
    return _with_component(marked, values, linked)


def _with_component(marked: DataFrame, values: DataFrame, linked: DataFrame) -> DataFrame:
    """Rows with the label and the smallest doc_id of their group; few fingerprints are linked at all."""
    values = values.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    least = values.filter("component is not null").groupBy("component").agg(F.min("least").alias("component_id"))
    named = values.join(least, "component", "left").select(
        "fp", F.coalesce("component", "fp").alias("group"), F.coalesce("component_id", "least").alias("component_id")
    )
    return marked.join(named, "fp").select(*marked.columns, "group", "component_id")


def keep_one_each(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) without near-duplicates: one row of each group.

    That is the row with the smallest doc_id; where rows share that id, one of them. Rows without
    doc_id stay only if their group has no doc_id at all, one row of each such group.
    """
    groups = near_duplicate_fingerprints(docs, words, radius)
    texts = durable(
        groups.groupBy("doc_id", "text_key").agg(F.first("group").alias("group"), F.first("component_id").alias("component_id"), F.count("*").alias("copies"))
    )
    own_id, own_key, again, drop = unused(docs, "id", "key", "again", "drop")
    kept = (
        texts.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("doc_id", "group")
        .agg(F.min(F.struct("text_key", "copies")).alias("best"))
        .select(F.col("doc_id").alias(own_id), F.col("best.text_key").alias(own_key), F.col("best.copies").alias("kept"))
    )
    marks = durable(
        texts.join(kept, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col("text_key") == F.col(own_key)), "left")
        .select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key), (F.coalesce("kept", F.lit(0)) > 1).alias(again), F.col("kept").isNull().alias(drop))
        .filter(F.col(again) | F.col(drop))
    )
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (text_key(F.col("text").cast("string")) == F.col(own_key))
    once = docs.join(sized(marks.select(own_id, own_key)), same, "left_anti")
    repeats = durable(marks.filter(F.col(again)).select(own_id, own_key))
    if repeats.isEmpty():
        return once
    # Rows that repeat both id and text: one of each is kept.
    repeated = docs.join(sized(repeats), same, "left_semi")
    first = repeated.withColumn(own_key, text_key(F.col("text").cast("string"))).dropDuplicates(["doc_id", own_key]).drop(own_key)
    return once.unionByName(first)
