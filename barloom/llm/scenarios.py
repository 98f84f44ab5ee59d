"""Rewritten copies of the given tables that some queries are asked to work on."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repeating(words: list[bytes], seed: int) -> list[bytes]:
    """``words``, from one of them on repeating a stretch that ``seed`` chooses."""
    n = len(words)
    start = seed % n
    period = 1 + (n - start) // (3 + seed % 8)
    cycle = words[start : start + period]
    times = -(-(n - start) // period)
    return words[:start] + (cycle * times)[: n - start]


def with_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of all ``docs``; where the crc32 of the id is a multiple of 10 the text repeats
    a stretch of itself. Other texts, and those without id or words, stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            hashes = batch.column(2).to_pylist()
            chosen = [at for at, h in enumerate(hashes) if h is not None and h % 10 == 0]
            if chosen:
                rows = texts.to_pylist()
                for at in chosen:
                    words = (rows[at] or b"").split()
                    if words:
                        rows[at] = b" ".join(repeating(words, hashes[at] // 10))
                texts = pa.array(rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts.cast(pa.string())], names=["doc_id", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    source = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"), hashed.alias("hashed"))
    return source.mapInArrow(run, f"doc_id {kind}, text string")
