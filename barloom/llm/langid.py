"""Language identification by nearest centroid.

A text is a vector of hashed character 1- to 3-grams, weighted by TF-IDF and normalised. Each
language has several centroids, found by spherical k-means; a text gets the language of the centroid
with the highest cosine. It is rejected if that cosine is less than a share of what training
texts reach at their low end, in the language where that is lowest. That share, and enough buckets that chance collisions add
little, keep the bar between short texts of a language and texts of other scripts or of no language.

Document frequencies are counted over all training rows. Centroids are fitted on a sample of
``sample`` training texts per language, the bound of the fit; the classifier is a table of at most
``MAX_LANGUAGES * clusters`` rows, checked before it is broadcast.

Edge cases: a NULL text or one without a letter is ``und`` with score 0 and rejected; so is every
text if there is nothing to learn from. Rows without language or doc_id are predicted, not learned
from; ids may be of any type, and a sampled id counts with one of its texts. A very long text is
hashed whole, ``BLOCK`` characters at a time. Ties go to the language that comes first in code-point order. Repeated rows are rows like any
other, extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import durable, sized

UNKNOWN = "und"
# Buckets of the hashed n-grams.
BITS = 14
BUCKETS = 1 << BITS
# Languages that a classifier may have: 256 of 4 centroids of 16,384 floats are 67 MB.
MAX_LANGUAGES = 256
# Odd multiplier of the multiplicative hash. Fixed value.
MULTIPLIER = 0x9E3779B97F4A7C15
# A cluster of less than this share of a language's sample is started anew, and left out if it stays so small.
LEAST_SHARE = 0.02
# Characters hashed at once: bounds the memory for one very long text.
BLOCK = 1 << 18


@functools.cache
def _letters() -> np.ndarray:
    """True for code points that are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed 1- to 3-grams of letters, words parted by a blank; None without letters."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[points]
    if not letter.any():
        return None
    points = np.where(letter, points, np.uint32(32)).astype(np.uint64)
    blank = points == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    points = points[keep]
    points = points[int(points[0] == 32) : len(points) - int(points[-1] == 32)]
    points = np.pad(points, 1, constant_values=32)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(points), BLOCK):
        # Two characters of overlap, so that no n-gram is cut.
        one = points[at : at + BLOCK + 2]
        last = at + BLOCK >= len(points)
        two = (one[:-1] << np.uint64(21)) | one[1:]
        three = (two[:-1] << np.uint64(21)) | one[2:]
        for n, grams in enumerate((one, two, three)):
            if not last:
                grams = grams[:BLOCK]
            mixed = (grams + np.uint64(n << 62 if n < 3 else 0)) * np.uint64(MULTIPLIER)
            mixed ^= mixed >> np.uint64(29)
            buckets = (mixed * np.uint64(MULTIPLIER)) >> np.uint64(64 - BITS)
            if n == 0:
                buckets = buckets[grams != 32]
            counts += np.bincount(buckets.astype(np.int64), minlength=BUCKETS)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the normalised TF-IDF vector."""
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at]) * idf[at]
    norm = np.linalg.norm(values)
    return at, values / norm if norm else values


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of every bucket, over all rows of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                counts = gram_counts(text.as_py())
                if counts is not None:
                    seen += counts > 0
                    texts += 1
        places = np.arange(-1, BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.concatenate([[texts], seen]))], names=["bucket", "n"])

    sums = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = {row.bucket: row.n for row in sums.collect()}
    total = table.get(-1, 0)
    seen = np.array([table.get(k, 0) for k in range(BUCKETS)], dtype=np.float64)
    return np.log((1 + total) / (1 + seen)) + 0.1


def spherical_means(x: np.ndarray, clusters: int, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of the unit rows of ``x``, and the centroid of each row.

    Starts from seeded k-means++ draws, the best of a few each time. Small clusters are drawn anew in
    the first half of the rounds; those that stay small are left out, so there may be fewer.
    """
    random = np.random.default_rng(len(x))
    small = LEAST_SHARE * len(x)

    def draw(centroids: np.ndarray) -> np.ndarray:
        """The row, of a few drawn by distance from the centroids, that leaves the least distance."""
        away = np.maximum(1 - (x @ centroids.T).max(1), 0).astype(np.float64)
        if away.sum() <= 1e-9 * len(x):
            return x[:1]
        drawn = random.choice(len(x), 4, p=away / away.sum())
        left = np.minimum(away[:, None], 1 - x @ x[drawn].T).sum(0)
        return x[drawn[np.argmin(left)]][None]

    centroids = x[[int(np.argmax(x @ x.mean(0)))]]
    while len(centroids) < min(clusters, len(x)):
        centroids = np.concatenate([centroids, draw(centroids)])
    for turn in range(rounds):
        own = np.argmax(x @ centroids.T, axis=1)
        sizes = np.bincount(own, minlength=len(centroids))
        sums = np.stack([x[own == k].sum(0) if size else centroids[k] for k, size in enumerate(sizes)])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        if turn < rounds // 2:
            for k in np.flatnonzero(sizes < small):
                centroids[k] = draw(np.delete(centroids, k, axis=0))[0]
    sizes = np.bincount(np.argmax(x @ centroids.T, axis=1), minlength=len(centroids))
    centroids = centroids[(sizes >= small) & (sizes > 0)]
    return centroids, np.argmax(x @ centroids.T, axis=1)


def fit(docs: DataFrame, clusters: int = 4, sample: int = 1000, quantile: float = 0.01, slack: float = 0.4) -> dict:
    """Centroids from ``docs`` (doc_id, text, lang), all of them rows to learn from."""
    rows = docs.filter("lang is not null and doc_id is not null and text is not null")
    idf = inverse_frequencies(rows)
    place = F.xxhash64(F.lit("langid"), "doc_id")
    # Few ids of a language reach the rank: those whose place lies in the share that holds enough of them.
    ids = rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))
    share = (sample + 10 * math.sqrt(sample) + 50) * 1.2 / F.col("ids")
    below = F.when(share < 1, -(2.0**63) + share * 2.0**64).otherwise(2.0**63).alias("below")
    bounds = sized(durable(ids.select(F.col("lang").alias("bound_lang"), below)))
    named_ids = rows.select("lang", "doc_id", place.alias("place"))
    near = named_ids.join(bounds, F.col("lang") == F.col("bound_lang")).filter(F.col("place") <= F.col("below"))
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = near.select("lang", "doc_id", "place").distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample)
    # One text of each id: rows that repeat an id are not gathered.
    picked = (
        rows.join(sized(durable(chosen.select("lang", "doc_id"))), ["lang", "doc_id"])
        .groupBy("lang", "doc_id")
        .agg(F.min(F.col("text").cast("string")).alias("text"))
        .select("lang", place.alias("place"), "text")
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, places, values, order = [], [], [], []
            for lang, at_place, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = gram_counts(text)
                if counts is not None:
                    at, value = weighted(counts, idf)
                    langs.append(lang), order.append(at_place), places.append(at.astype(np.int32)), values.append(value.astype(np.float32))
            yield pa.RecordBatch.from_pydict({"lang": langs, "place": order, "places": places, "values": values}, schema=shape)

    shape = pa.schema([("lang", pa.string()), ("place", pa.int64()), ("places", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])

    def means(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["place"], kind="stable")
        x = np.zeros((len(group), BUCKETS), np.float32)
        for k, (at, value) in enumerate(zip(group["places"], group["values"], strict=True)):
            x[k, at] = value
        centroids, own = spherical_means(x, clusters)
        near = np.einsum("ij,ij->i", x, centroids[own])
        # Not by cluster: a small one's floor would follow its few texts.
        floor = float(np.quantile(near, quantile)) * slack
        rows = [(group["lang"].iloc[0], k, floor, c.astype(np.float32)) for k, c in enumerate(centroids)]
        return pd.DataFrame(rows, columns=["lang", "cluster", "floor", "centroid"])

    sparse = picked.mapInArrow(vectors, "lang string, place long, places array<int>, values array<float>")
    table = durable(sparse.groupBy("lang").applyInPandas(means, "lang string, cluster int, floor double, centroid array<float>"))
    languages = table.select("lang").distinct().count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"{languages} languages; a classifier may have {MAX_LANGUAGES}")
    found = sorted(table.collect(), key=lambda r: (r.lang, r.cluster))
    return {
        "idf": idf,
        "langs": [r.lang for r in found],
        "floors": np.full(len(found), min((r.floor for r in found), default=0.0)),
        "centroids": np.array([r.centroid for r in found], dtype=np.float32).reshape(len(found), BUCKETS).T.copy(),
    }


def classify(text: str | None, model: dict) -> tuple[str, float, bool]:
    """Language, cosine and whether the text is rejected."""
    counts = gram_counts(text)
    if counts is None or not model["langs"]:
        return UNKNOWN, 0.0, True
    at, values = weighted(counts, model["idf"])
    cosines = values @ model["centroids"][at]
    best = int(np.argmax(cosines))
    score = float(min(1.0, max(0.0, cosines[best])))
    return model["langs"][best], score, bool(score < model["floors"][best])


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [classify(t.as_py(), shared.value) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([x[2] for x in found], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    )


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series([not classify(t, shared.value)[2] for t in texts], dtype=bool)

    return docs.filter(good(F.col("text").cast("string")))


def training_rows(docs: DataFrame, held_out: Column) -> DataFrame:
    return docs.filter(~held_out).select("doc_id", "text", "lang")
