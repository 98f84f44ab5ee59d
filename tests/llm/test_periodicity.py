import hashlib
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import periodicity
from barloom.llm.common import Numbering
from barloom.llm.queries import op13_lcp_kruskal
from barloom.llm.scenarios import repeating
from tests.llm.conftest import SF, edge_rows


def brute_runs(words, least_length=6, least_exponent=4):
    """Every run, by looking at each period in turn."""
    n, found = len(words), []
    for q in range(1, n // least_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least_length, least_exponent * q):
                stretch = words[i : i + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 6), st.integers(0, 30), st.sampled_from([(6, 4), (2, 2), (5, 3), (9, 2)]))
def test_runs_of_any_words(head, period, more, least):
    words = head + [head[-1 - k % min(period, len(head))] for k in range(more)] if head else head
    ids = np.array(words, np.int64)
    assert periodicity.find_runs(ids, *least) == brute_runs(words, *least)


def expected(doc_id, text):
    """The contract of the query, word by word."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (len(runs), *(best + (1000 * best[1] // best[2],) if best else (None,) * 4), *sha)


def test_query_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # Whole texts, but short ones: brute force takes the square of the words.
    docs = docs.filter("n_chars < 4000").unionByName(spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4]) for r in edge_rows() if r[4] < 4000], docs.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r[0]), tuple(r[1:])) for r in op13_lcp_kruskal(spark, str(tmp_path)).collect())
    assert got == sorted((str(r.doc_id), expected(r.doc_id, r.text)) for r in docs.select("doc_id", "text").collect())
    assert sum(row[1][0] > 0 for row in got) > 50


def test_whole_table_has_its_planted_runs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op13_lcp_kruskal(spark, SF).collect()}
    assert len(got) == len(docs)
    checked = 0
    for row in docs:
        h, words = zlib.crc32(str(row.doc_id).encode()), (row.text or "").encode().split()
        if h % 10 or len(words) < 100:
            continue
        planted = repeating(words, h // 10)
        start = h // 10 % len(words)
        period = 1 + (len(words) - start) // (3 + h // 10 % 8)
        if len(words) - start >= max(6, 4 * period):
            assert got[row.doc_id].n_runs > 0 and got[row.doc_id].length >= len(planted) - start
            checked += 1
    assert checked > 20


def test_edge_cases(spark, edge, empty):
    rows = {}
    for r in periodicity.periodic_runs(edge).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert len(rows[1]) == 2 and rows[1][0] == rows[1][1]
    for doc_id in (2, 3, 5):
        assert (rows[doc_id][0].n_words, rows[doc_id][0].runs, rows[doc_id][0].collapsed) == (0, [], "")
    (long,) = rows[4]
    assert [tuple(r) for r in long.runs] == [(0, long.n_words, 5)] and long.collapsed == "lorem ipsum dolor sit amet"
    assert rows[7][0].collapsed == "Grüße, naïve 日本 \U0001f600 text"
    assert periodicity.periodic_runs(empty).collect() == []
    with pytest.raises(ValueError):
        periodicity.periodic_runs(edge, least_exponent=1)


def test_a_very_long_text_takes_time_about_in_proportion():
    def seconds(n):
        words = (np.arange(n) % (n // 9)).astype(np.int64)
        started = time.perf_counter()
        assert periodicity.find_runs(words) == [(0, n, n // 9)]
        return time.perf_counter() - started

    assert seconds(160_000) < 8 * max(seconds(40_000), 0.05)


def test_words_are_numbered_as_they_come():
    assert Numbering().of([b"b", b"a", b"b"]).tolist() == [0, 1, 0]
