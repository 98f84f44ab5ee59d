"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are cut into segments of up to ``SEGMENT`` words. The n-grams of the segments are counted
over the whole corpus. All that occur are seeds, except those in more than ``RARE`` documents and
more than ``COMMON`` times as frequent as the mean of their segment, which one in ``COMMON`` can be:
an item has seeds however often it has leaked, and so has an edited copy that keeps few of its
n-grams, alone or beside exact copies. A copy that keeps no run of ``n`` words is not found. A second scan cuts a passage around every seed found in a
document. Passages and segments that share a seed are joined and aligned word by word, locally, with
gaps, and a pair counts if the alignment reaches ``least`` of the score of a perfect copy. Equal
passages are aligned once, however many documents hold them.

Both scans look n-grams up in a bit filter of fixed greatest size, the only thing broadcast to them;
what it lets through by chance is removed by the joins on exact codes.

Words are runs of ASCII letters and digits and of characters beyond ASCII, in lower case; other
characters do not matter. Edge cases:
NULL or empty texts and items hold nothing; an item of fewer than ``n`` words has no n-gram and is
not searched for. Repeated items are found separately. A row without doc_id is reported without one.
Extra columns are ignored, empty tables give an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable, sized, unused

# Words of a segment, and of the stretch around seeds that is aligned with it.
SEGMENT, MARGIN, PASSAGE = 64, 72, 256
# An n-gram is a common phrase, and no seed, in more documents than RARE and COMMON times the mean of its segment.
RARE, COMMON = 1000, 8
# Alignment scores of a word: equal, different, left out or put in.
MATCH, MISMATCH, GAP = 2, -1, -1
# The bit filter has 16 bits for each n-gram, within these powers of two: 16 MB at most.
LEAST_BITS, MOST_BITS = 20, 27
# Odd multiplier that chains word hashes. Fixed value.
CHAIN = 0x9E3779B97F4A7C15
# Bytes scanned at once.
BLOCK = 1 << 15


class Words:
    """The words of a text: places in its lower-cased UTF-8 ``data``, and a 64-bit hash of each."""

    def __init__(self, text: str | None):
        self.data = (text or "").lower().encode("utf-8", "surrogatepass")
        found = [_scan(self.data, *piece) for piece in _pieces(self.data)]
        self.starts, self.ends, self.hashes = (np.concatenate(x) for x in zip(*found))

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, low: int, high: int) -> str:
        """Words ``low`` to ``high``, parted by blanks."""
        places = zip(self.starts[low:high].tolist(), self.ends[low:high].tolist())
        return b" ".join(self.data[a:b] for a, b in places).decode("utf-8", "surrogatepass")

    def grams(self, n: int) -> np.ndarray:
        """A 64-bit code for each run of ``n`` words."""
        h = self.hashes
        if len(h) < n:
            return np.zeros(0, np.uint64)
        codes = h[: len(h) - n + 1].copy()
        for k in range(1, n):
            codes = codes * np.uint64(CHAIN) + h[k : len(h) - n + 1 + k]
            codes ^= codes >> np.uint64(29)
        return codes


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and a number for each byte."""
    inside = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
    numbers = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(CHAIN)
    numbers ^= numbers >> np.uint64(31)
    return inside, numbers * np.uint64(CHAIN)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``CHAIN`` and of its inverse, modulo 2^64."""
    factors = (CHAIN, pow(CHAIN, -1, 1 << 64))
    one, two = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, f, np.uint64)])) for f in factors)
    return one, two


INSIDE, NUMBERS = _tables()


def _pieces(data: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of about ``BLOCK`` bytes that cut no word: bounds the memory for one very long text."""
    at = 0
    while True:
        end = at + BLOCK
        while end < len(data) and INSIDE[data[end]]:
            end += 1
        yield at, min(end, len(data))
        if end >= len(data):
            return
        at = end


def _scan(data: bytes, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words between two places.

    A hash is the sum of the bytes' numbers by powers of their place, taken from running sums and
    brought back to the first place, so that equal words have equal hashes.
    """
    b = np.frombuffer(data, np.uint8)[low:high]
    if not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = INSIDE[b]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate([[0] * int(inside[0]), edges, [len(b)] * int(inside[-1])]).astype(np.int64)
    starts, ends = edges[0::2], edges[1::2]
    powers, inverse = _powers(1 << max(16, len(b).bit_length()))
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(NUMBERS[b] * powers[: len(b)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    hashes ^= hashes >> np.uint64(32)
    return starts + low, ends + low, hashes * np.uint64(CHAIN)


def segments(benchmark: DataFrame, n: int) -> DataFrame:
    """``(item_id, part, words, codes)``: items cut into segments that overlap by half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts, texts, codes = [], [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = Words(text)
                grams = words.grams(n)
                last = max(0, len(words) - SEGMENT)
                for part, at in enumerate([*range(0, last, SEGMENT // 2), last]):
                    if len(words) >= n:
                        ids.append(item), parts.append(part), texts.append(words.text(at, at + SEGMENT))
                        codes.append(np.unique(grams[at : at + SEGMENT - n + 1]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema[0].type), pa.array(parts, pa.int32()), pa.array(texts, pa.string()), pa.array(codes, pa.list_(pa.int64()))],
                names=["item_id", "part", "words", "codes"],
            )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", F.col("text").cast("string")).mapInArrow(run, f"item_id {kind}, part int, words string, codes array<long>")


def bit_filter(codes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of index bits and packed filter of the column ``code``: two bits for each."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * max(1, codes.count()) - 1).bit_length()))
    place = F.explode(F.array(F.shiftrightunsigned("code", 64 - bits), F.shiftrightunsigned(F.shiftleft("code", 24), 64 - bits)))
    cells = codes.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    )
    packed = np.zeros(1 << (bits - 6), np.int64)
    for row in cells.toLocalIterator():
        packed[row.cell] = row.bits
    return bits, packed


def passes(codes: np.ndarray, bits: int, packed: np.ndarray) -> np.ndarray:
    """True for codes that may be in the filter."""
    shift = np.uint64(64 - bits)

    def held(place: np.ndarray) -> np.ndarray:
        return (packed[place >> np.uint64(6)].view(np.uint64) >> (place & np.uint64(63))) & np.uint64(1) > 0

    found = held(codes >> shift)
    at = np.flatnonzero(found)
    found[at] = held((codes[at] << np.uint64(24)) >> shift)
    return found


def gram_frequencies(docs: DataFrame, codes: DataFrame, n: int) -> DataFrame:
    """``(code, df)``: documents of the whole corpus that hold each n-gram of ``codes``; none for one that no document holds."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(codes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for text in batch.column(0):
                grams = Words(text.as_py()).grams(n)
                held.append(np.unique(grams[passes(grams, *shared.value)]))
            found, count = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count.astype(np.int64))], names=["code", "df"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "code long, df long").groupBy("code").agg(F.sum("df").alias("df"))
    return codes.join(counted, "code")


def passages(docs: DataFrame, seeds: DataFrame, n: int) -> DataFrame:
    """``(doc_id, text_key, start, words, codes)``: stretches of documents around seeds.

    ``start`` is the place of the first word, ``codes`` the seeds inside.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(seeds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, texts, codes = [], [], [], []
            for row, text in enumerate(batch.column(2)):
                words = Words(text.as_py())
                grams = words.grams(n)
                hits = np.flatnonzero(passes(grams, *shared.value))
                for low, high in _stretches(hits, n, len(words)):
                    inside = hits[np.searchsorted(hits, low) : np.searchsorted(hits, high - n, "right")]
                    rows.append(row), starts.append(low), texts.append(words.text(low, high))
                    codes.append(np.unique(grams[inside]).view(np.int64))
            part = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(starts, pa.int32()), pa.array(texts, pa.string()), pa.array(codes, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "start", "words", "codes"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    shape = f"doc_id {kind}, text_key string, start int, words string, codes array<long>"
    return docs.select("doc_id", F.md5(text).alias("text_key"), text.alias("text")).mapInArrow(run, shape)


def _stretches(hits: np.ndarray, n: int, length: int) -> Iterator[tuple[int, int]]:
    """Word ranges of up to ``PASSAGE`` words that hold every hit with ``MARGIN`` words on each side."""
    if not len(hits):
        return
    step = PASSAGE - 2 * MARGIN - n
    first = 0
    while first < len(hits):
        at = int(hits[first])
        # Hits are in order: each stretch begins where the one before has ended.
        end = int(np.searchsorted(hits, at + step))
        yield max(0, at - MARGIN), min(length, int(hits[end - 1]) + n + MARGIN)
        first = end


def align(segment: np.ndarray, passage: np.ndarray) -> np.ndarray:
    """Best local alignment score of each row of ``segment`` (pad -1) with that of ``passage`` (pad -2)."""
    rows, width = passage.shape
    slope = np.arange(width, dtype=np.int32) * -GAP
    best = np.zeros(rows, np.int32)
    before = np.zeros((rows, width), np.int32)
    for k in range(segment.shape[1]):
        step = np.where(passage == segment[:, k, None], MATCH, MISMATCH).astype(np.int32)
        step[:, 1:] += before[:, :-1]
        # Words of the passage left out: the best to the left, less a gap for each word.
        score = np.maximum(np.maximum(step, before + GAP), 0)
        before = np.maximum.accumulate(score + slope, axis=1) - slope
        np.maximum(best, before.max(axis=1), out=best)
    return best


def aligned(pairs: DataFrame, least: float) -> DataFrame:
    """``(pid, item_id, score)`` of ``pairs`` (pid, item_id, passage, segment) that reach ``least``.

    Only passages that hold ``least`` of the segment's words can, and only they are aligned.
    """

    def coded(texts: list[str], ids: dict[str, int], pad: int) -> np.ndarray:
        rows = [[ids.setdefault(w, len(ids)) for w in t.split(" ")] for t in texts]
        out = np.full((len(rows), max(map(len, rows))), pad, np.int32)
        for k, row in enumerate(rows):
            out[k, : len(row)] = row
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                ids: dict[str, int] = {}
                ones, twos = part.column(3).to_pylist(), part.column(2).to_pylist()
                one, two = coded(ones, ids, -1), coded(twos, ids, -2)
                length = np.array([t.count(" ") + 1 for t in ones])
                row = np.arange(len(one))[:, None] * (len(ids) + 2)
                may = np.flatnonzero(np.isin(one + row, two + row).sum(1) >= least * length - 1e-9)
                share = align(one[may], two[may]) / (MATCH * length[may])
                good = share >= least
                kept = part.select([0, 1]).take(pa.array(may[good]))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(share[good])], names=["pid", "item_id", "score"])

    kind = pairs.schema["item_id"].dataType.simpleString()
    return pairs.select("pid", "item_id", "passage", "segment").mapInArrow(run, f"pid string, item_id {kind}, score double")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 4, least: float = 0.6) -> DataFrame:
    """``(doc_id, text_key, item_id, score, start)``: the items that each document holds.

    score is the best share of a perfect alignment, start the first word of the stretch around it,
    text_key the md5 of the text. Documents that hold no item have no row.
    """
    parts = durable(segments(benchmark, n).withColumn("segment", F.monotonically_increasing_id()))
    grams = parts.select("segment", F.explode("codes").alias("code"))
    counted = gram_frequencies(docs, durable(grams.select("code").distinct()), n)
    ranked = grams.join(durable(counted), "code")
    usual = ranked.groupBy("segment").agg(F.avg("df").alias("usual"))
    seeds = durable(ranked.join(usual, "segment").filter(F.col("df") <= F.greatest(F.lit(RARE), COMMON * F.col("usual"))).select("segment", "code"))
    found = durable(passages(docs, durable(seeds.select("code").distinct()), n).withColumn("pid", F.md5("words")))
    distinct = found.select("pid", "words", "codes").dropDuplicates(["pid"])
    pairs = distinct.select("pid", F.explode("codes").alias("code")).join(seeds, "code").select("pid", "segment").distinct()
    both = (
        pairs.join(distinct.select("pid", F.col("words").alias("passage")), "pid")
        .join(parts.select("segment", "item_id", F.col("words").alias("text")), "segment")
        .select("pid", "item_id", "passage", F.col("text").alias("segment"))
    )
    scores = aligned(both, least).groupBy("pid", "item_id").agg(F.max("score").alias("score"))
    hits = found.select("doc_id", "text_key", "start", "pid").join(scores, "pid")
    return (
        hits.groupBy("doc_id", "text_key", "item_id")
        .agg(F.max(F.struct("score", (-F.col("start")).alias("start"))).alias("best"))
        .select("doc_id", "text_key", "item_id", "best.score", (-F.col("best.start")).alias("start"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, n: int = 4, least: float = 0.6) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item of the benchmark."""
    found = contamination(docs, benchmark, n, least)
    bad_id, bad_key = unused(docs, "bad_id", "bad_key")
    bad = sized(durable(found.select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct()))
    same = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (F.md5(F.col("text").cast("string")) == F.col(bad_key))
    return docs.join(bad, same, "left_anti")
