"""Periodic runs of words, by descending-LCP Kruskal over the suffixes of a text.

A run is a stretch of words with smallest period q, at least ``least_exponent`` periods and
``least_length`` words long, that no neighbouring word extends keeping that period.

The suffixes of a text are sorted, and neighbours in that order are joined by the length of their
longest common prefix (LCP), longest first, with union-find. Each class keeps its positions in order,
and the smaller of two classes moves into the larger. Positions i < j that become neighbours when
classes meet at LCP l have exactly that LCP: the words from i on have period j - i over j - i + l
words, and the run starts at i if the words before i and j differ. Every run is met so, once, and
with its smallest period: a position between i and i + q with an LCP of q or more would give the run a
smaller period, so i and i + q are neighbours as soon as they share a class. Classes below the least
LCP that a run can have are never formed, and a text in which no stretch of that length occurs twice
is not sorted at all.

A text is one row and one unit of work: n words take n log n steps and memory in proportion to n.

Edge cases: a NULL or blank text has no words, no runs and collapses to the empty text. A very long
text is treated whole. Repeated rows and rows without doc_id are rows like any other, extra columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import Numbering

RUN = "struct<start:bigint,length:bigint,period:bigint>"
# Bytes of text after which rows are handed on.
CHUNK = 8 << 20


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``ids`` (whole numbers from 0) in order, by prefix doubling."""
    n = len(ids)
    rank, width = ids.astype(np.int64), 1
    scale = max(n, int(rank.max()) + 1) + 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - width, 0)] = rank[width:] + 1
        key = rank * scale + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


def common_prefixes(ids: list[int], order: list[int]) -> list[int]:
    """LCP of each suffix with the next one in ``order``."""
    n = len(ids)
    place = [0] * n
    for k, i in enumerate(order):
        place[i] = k
    out, length = [0] * max(n - 1, 0), 0
    for i in range(n):
        k = place[i]
        if k == n - 1:
            length = 0
            continue
        j = order[k + 1]
        stop = n - max(i, j)
        while length < stop and ids[i + length] == ids[j + length]:
            length += 1
        out[k] = length
        length = max(length - 1, 0)
    return out


def least_prefix(least_length: int, least_exponent: int) -> int:
    """The smallest LCP that the first two periods of a run can have."""
    return min(max(least_length - q, (least_exponent - 1) * q) for q in range(1, least_length + 1))


def find_runs(ids: np.ndarray, least_length: int = 6, least_exponent: int = 4) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of ``ids``, by start and period."""
    n, least = len(ids), least_prefix(least_length, least_exponent)
    words = ids.tolist()
    stretches = n - least + 1
    if stretches < 2 or len(set(zip(*(words[k:] for k in range(least))))) == stretches:
        return []
    order = suffix_order(ids).tolist()
    prefixes = np.array(common_prefixes(words, order))
    joints = np.flatnonzero(prefixes >= least)
    joints = joints[np.argsort(-prefixes[joints], kind="stable")]

    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    runs = []

    def root(k: int) -> int:
        if k not in parent:
            parent[k], members[k] = k, [order[k]]
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def met(i: int, j: int, prefix: int) -> None:
        q = j - i
        if prefix >= (least_exponent - 1) * q and prefix + q >= least_length and (i == 0 or words[i - 1] != words[j - 1]):
            runs.append((i, prefix + q, q))

    for k, prefix in zip(joints.tolist(), prefixes[joints].tolist()):
        a, b = root(k), root(k + 1)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members.pop(b)
        parent[b] = a
        for at, x in enumerate(small):
            place = bisect_left(large, x)
            # Neighbours in the united class are one of each: none of the smaller class lies between.
            if place and (at == 0 or small[at - 1] < large[place - 1]):
                met(large[place - 1], x, prefix)
            if place < len(large) and (at + 1 == len(small) or small[at + 1] > large[place]):
                met(x, large[place], prefix)
        if 8 * len(small) < len(large):
            for x in small:
                insort(large, x)
        else:
            large += small
            large.sort()
    return sorted(runs, key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for each of ``n`` words that a run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def periodic_runs(
    docs: DataFrame, least_length: int = 6, least_exponent: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for every row of ``docs``.

    ``runs`` is an array of (start, length, period) in words, by start and period; ``collapsed`` is
    the text with the first period of every run only, its words parted by one space. An exponent
    of 2 or more is required.
    """
    if least_exponent < 2 or least_length < 2:
        raise ValueError("a run has two periods and two words at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size, first = [], 0, 0
            for at in range(len(batch)):
                words = (batch.column(1)[at].as_py() or b"").split()
                found = find_runs(Numbering().of(words), least_length, least_exponent)
                kept = words
                if found:
                    kept = [words[k] for k in np.flatnonzero(kept_words(len(words), found))]
                rows.append((len(words), found, b" ".join(kept)))
                size += len(rows[-1][2])
                if size >= CHUNK or at == len(batch) - 1:
                    yield _as_batch(batch.column(0).slice(first, at + 1 - first), rows)
                    rows, size, first = [], 0, at + 1

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string")


def _as_batch(ids: pa.Array, rows: list[tuple[int, list, bytes]]) -> pa.RecordBatch:
    flat = np.array([run for _, found, _ in rows for run in found], np.int64).reshape(-1, 3)
    items = pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], names=["start", "length", "period"])
    ends = np.concatenate([[0], np.cumsum([len(found) for _, found, _ in rows])]).astype(np.int32)
    columns = [
        ids,
        pa.array([n for n, _, _ in rows], pa.int64()),
        pa.ListArray.from_arrays(pa.array(ends), items),
        pa.array([text for _, _, text in rows], pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])
