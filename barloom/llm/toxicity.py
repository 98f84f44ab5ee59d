"""Toxicity by multiple-instance learning.

Only documents are labelled, but sentences offend. A sentence has the probability that a logistic
model of its words gives it, and a document is toxic unless every sentence, and a leak that stands
for labels without visible cause, holds back (noisy-or):

    P(document) = 1 - (1 - leak) * product over sentences of (1 - p(sentence))

The model is trained through this formula from document labels alone; afterwards the sentence
probabilities tell which sentences offend. Features are hashed words and their beginnings, so that inflected and compound forms
count. Only those get a weight whose share of
the sentences of toxic documents differs from the rest by ``evidence`` standard errors, each sentence
counted once however many copies of it there are; an L1 penalty thins them further. Words of a few
mislabelled documents and their copies do not count.

The fit uses at most ``sample`` labelled documents, chosen by a hash of their id, in one task; that
is the only bound. Scoring reads every text in full.

Edge cases: a NULL or blank text has no sentence and the score of the leak. Several labels of a
document count as toxic if one is; NULL labels and labels of unknown documents are ignored. Without
any label every score is 0. Repeated rows are scored alike, extra columns are ignored, an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORDS = re.compile(r"[^\W\d_]+")
# Letters of the word beginnings that are features besides the word.
BEGINNINGS = (4, 6)
# Words whose bucket a worker remembers.
REMEMBERED = 1 << 20


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def features(word: str) -> list[int]:
    """Buckets of a word and of its beginnings."""
    return [bucket(word), *(bucket(word[:k] + "*") for k in BEGINNINGS if len(word) >= k)]


def sentences(text: str | None) -> Iterator[tuple[int, int, set[str]]]:
    """Start, end (code points, end exclusive) and distinct lower-case words of each sentence."""
    for found in SENTENCE.finditer(text or ""):
        words = set(WORDS.findall(found.group().lower()))
        if words:
            yield found.start(), found.end(), words


def _evident(words: np.ndarray, sentence_of: np.ndarray, label: np.ndarray, evidence: float) -> tuple[np.ndarray, np.ndarray]:
    """Buckets to weigh, and the log odds that a sentence with the bucket is of a toxic document.

    ``label`` is that of each sentence's document. Sentences of equal words count once for each label.
    """
    sizes = np.bincount(sentence_of, minlength=len(label))
    mixed = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    sums = np.concatenate([[0], np.cumsum(mixed * np.uint64(0xBF58476D1CE4E5B9), dtype=np.uint64)]).astype(np.uint64)
    ends = np.cumsum(sizes)
    digest = sums[ends] - sums[ends - sizes]
    _, first = np.unique(digest * np.uint64(2) + label.astype(np.uint64), return_index=True)
    once = np.zeros(len(label), bool)
    once[first] = True
    here = once[sentence_of]
    seen, column = np.unique(words[here], return_inverse=True)
    total = np.bincount(column, minlength=len(seen))
    toxic = np.bincount(column, weights=label[sentence_of[here]], minlength=len(seen))
    n_toxic = label[once].sum()
    n_clean = once.sum() - n_toxic
    p, q = (toxic + 0.5) / (n_toxic + 1), (total - toxic + 0.5) / (n_clean + 1)
    pooled = (total + 1) / (once.sum() + 2)
    error = np.sqrt(pooled * (1 - pooled) * (1 / (n_toxic + 1) + 1 / (n_clean + 1)))
    odds = np.log(p / (1 - p)) - np.log(q / (1 - q))
    keep = np.abs(p - q) >= evidence * error
    return seen[keep], odds[keep]


def _train(words: np.ndarray, sentence_of: np.ndarray, doc_of: np.ndarray, label: np.ndarray, evidence: float, l1: float, rounds: int) -> dict:
    """Proximal gradient steps, scaled per weight, on the mean log loss of the documents.

    ``words`` are buckets, ``sentence_of`` their sentence, ``doc_of`` the document of a sentence.
    """
    seen, start = _evident(words, sentence_of, label[doc_of], evidence)
    here = np.isin(words, seen)
    column, sentence_of = np.searchsorted(seen, words[here]), sentence_of[here]
    n, m = len(label), len(doc_of)
    # Weights of words, then the bias of sentences, then the leak.
    rate = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    weight = np.concatenate([start + 3 * np.sign(start), [-6.0, np.log(rate / (1 - rate)) - 1]])
    mean, square = np.zeros_like(weight), np.zeros_like(weight)
    for step in range(1, rounds + 1):
        z = weight[-2] + np.bincount(sentence_of, weights=weight[column], minlength=m)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        leak = 1 / (1 + np.exp(-weight[-1]))
        quiet = np.log1p(-np.minimum(p, 1 - 1e-9))
        hold = np.bincount(doc_of, weights=quiet, minlength=n) + np.log1p(-leak)
        none = np.exp(hold)
        slope = (1 - label) - label * none / np.maximum(1 - none, 1e-6)  # of the loss, by -hold
        by_sentence = p * slope[doc_of] / n
        gradient = np.concatenate(
            [
                np.bincount(column, weights=by_sentence[sentence_of], minlength=len(seen)),
                [by_sentence.sum(), (leak * slope).sum() / n],
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        pace = 0.05 / (np.sqrt(square / (1 - 0.99**step)) + 1e-3)
        weight -= pace * mean / (1 - 0.9**step)
        weight[:-2] = np.sign(weight[:-2]) * np.maximum(np.abs(weight[:-2]) - pace[:-2] * l1, 0)
        weight[-2] = min(weight[-2], -1.0)
    kept = np.flatnonzero(weight[:-2])
    return {"bucket": seen[kept].tolist(), "weight": weight[kept].tolist(), "bias": float(weight[-2]), "leak": float(1 / (1 + np.exp(-weight[-1])))}


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6000, evidence: float = 6.0, l1: float = 1e-5, rounds: int = 400) -> dict:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), all of them to learn from."""
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64(F.lit("toxic"), "doc_id"), "doc_id").limit(sample)
    # At most `sample` ids, hence fit to broadcast.
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    # One text of each id: rows that repeat an id are not gathered.
    rows = found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ends = [], []
            for text in batch.column(1):
                bag = [sorted({f for w in found for f in features(w)}) for _, _, found in sentences(text.as_py())]
                words.append([w for x in bag for w in x])
                ends.append([len(x) for x in bag])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), batch.column(2).cast(pa.int32())],
                names=["doc_id", "words", "sizes", "toxic"],
            )

    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id", kind="stable").head(sample)
        sizes = [np.asarray(x, dtype=np.int64) for x in group["sizes"]]
        per_doc = np.array([len(x) for x in sizes])
        flat = np.concatenate([*sizes, np.zeros(0, np.int64)])
        model = _train(
            np.concatenate([*(np.asarray(x, dtype=np.int32) for x in group["words"]), np.zeros(0, np.int32)]),
            np.repeat(np.arange(len(flat)), flat),
            np.repeat(np.arange(len(group)), per_doc),
            group["toxic"].to_numpy(np.float64),
            evidence,
            l1,
            rounds,
        )
        return pd.DataFrame([model])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sparse = rows.mapInArrow(bags, f"doc_id {kind}, words array<int>, sizes array<int>, toxic int")
    found = (
        sparse.groupBy()
        .applyInPandas(train, "bucket array<long>, weight array<double>, bias double, leak double")
        .first()
    )
    if found is None:
        return {"weights": {}, "bias": -30.0, "leak": 0.0}
    return {"weights": dict(zip(found.bucket, found.weight, strict=True)), "bias": found.bias, "leak": found.leak}


class Scorer:
    """Scores texts with a model; remembers the weights of words."""

    def __init__(self, model: dict):
        self.model = model
        self.known: dict[str, tuple[int, ...]] = {}

    def weighed(self, word: str) -> tuple[int, ...]:
        """The buckets of the word that have a weight; most words have none."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = tuple(f for f in features(word) if f in self.model["weights"])
        return found

    def score(self, text: str | None, offends: float) -> tuple[float, int, list[tuple[int, int, float]]]:
        """Score, number of sentences, and (start, end, probability) of the offending ones."""
        hold, count, located = math.log1p(-min(self.model["leak"], 1 - 1e-9)), 0, []
        for start, end, words in sentences(text):
            count += 1
            z = self.model["bias"] + sum(self.model["weights"][f] for f in {f for w in words for f in self.weighed(w)})
            p = 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))
            hold += math.log1p(-min(p, 1 - 1e-9))
            if p >= offends:
                located.append((start, end, p))
        return -math.expm1(hold), count, located


def score(docs: DataFrame, model: dict, offends: float = 0.5) -> DataFrame:
    """``(doc_id, score, sentences, offending)`` for every row of ``docs``.

    ``offending`` lists the sentences with probability ``offends`` or more as (start, end, p).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.score(t.as_py(), offends) for t in batch.column(1)]
            spans = pa.array([[{"start": a, "end": b, "p": p} for a, b, p in x[2]] for x in found], kind_of_spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.float64()), pa.array([x[1] for x in found], pa.int32()), spans],
                names=["doc_id", "score", "sentences", "offending"],
            )

    kind_of_spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, sentences int, offending array<struct<start:int,end:int,p:double>>"
    )
