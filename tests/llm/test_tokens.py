import re
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from barloom.llm import tokens
from barloom.llm.queries import op9_delta_rollup
from tests.llm.conftest import SF

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
COUNTER = tokens.BpeCounter(open(VOCABULARY, "rb").read())
COUNTS = "op string, doc_id long, source string, lang string, version string, tokens long, seq int"


def table(rollup):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in rollup.totals().collect()}


def batch(spark, *rows):
    return spark.createDataFrame([(*r, 0) if len(r) == 6 else r for r in rows], COUNTS)


def test_query_equals_a_recount(spark):
    label = {}
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        label[r.doc_id] = r
    docs, total = Counter(), Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        text, mark = r.text, label.get(r.doc_id)
        if mark and mark.toxic == 1:
            continue
        if mark and mark.quality == 0:
            text = "\n".join(dict.fromkeys(text.split("\n")))
        counts = {"byte_bpe_50k": len(COUNTER.encoding.encode_ordinary(text)), "words": len(re.findall(r"[^\x20\x09-\x0D]+", text))}
        for version, n in counts.items():
            docs[r.source, r.lang, version] += 1
            total[r.source, r.lang, version] += n
    got = {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in op9_delta_rollup(spark, SF).collect()}
    assert got == {k: (docs[k], total[k]) for k in docs}


@given(st.text(alphabet="ab' .\n\té日1", max_size=50))
def test_counts_by_word_equal_counts_of_the_text(text):
    assert COUNTER.count(text) == len(COUNTER.encoding.encode_ordinary(text))


def test_signed_changes(spark, tmp_path):
    rollup = tokens.Rollup(spark, f"file://{tmp_path}/r")
    assert rollup.totals().collect() == []
    first = batch(spark, ("insert", 1, "a", "en", "v1", 10), ("insert", 2, "a", "en", "v1", 5), ("insert", 1, "a", "en", "v2", 20), ("insert", None, "a", "en", "v1", 7), ("insert", None, "a", "en", "v1", 7))
    assert rollup.apply("b1", first)
    assert table(rollup) == {("a", "en", "v1"): (4, 29), ("a", "en", "v2"): (1, 20)}
    # a revised count, a move to another source, a deletion, and changes of unknown documents
    second = batch(spark, ("revise", 1, "b", "en", "v1", 12), ("delete", 2, None, None, "v1", None), ("delete", 9, "a", "en", "v1", 3), ("revise", 8, None, None, "v1", 1))
    assert rollup.apply("b2", second)
    want = {("a", "en", "v1"): (2, 14), ("b", "en", "v1"): (1, 12), ("a", "en", "v2"): (1, 20), (None, None, "v1"): (1, 1)}
    assert table(rollup) == want
    assert not rollup.apply("b2", second) and not rollup.apply("b1", first) and table(rollup) == want
    # the last change of a document counts
    third = batch(spark, ("insert", 3, "c", "de", "v1", 1, 1), ("delete", 3, "c", "de", "v1", 0, 3), ("revise", 3, "c", "de", "v1", 4, 2), ("insert", 2, "a", "en", "v1", 6, 0), ("insert", 2, "a", "en", "v1", 6, 0))
    assert rollup.apply("b3", third)
    assert table(rollup) == want | {("a", "en", "v1"): (3, 20)}
    assert rollup.apply("b4", third.limit(0)) and table(rollup) == want | {("a", "en", "v1"): (3, 20)}
    assert rollup.committed() == ["b1", "b2", "b3", "b4"]


def test_a_batch_that_broke_off_is_overwritten(spark, tmp_path):
    rollup = tokens.Rollup(spark, f"file://{tmp_path}/r")
    change = batch(spark, ("insert", 1, "a", "en", "v1", 10))
    change.selectExpr("doc_id", "source", "lang", "version", "tokens * 9 AS tokens", "1 AS sign").write.parquet(f"{tmp_path}/r/ledger/b1")
    change.selectExpr("source", "lang", "version", "5L AS docs", "90L AS tokens").write.parquet(f"{tmp_path}/r/totals/b1")
    assert rollup.totals().collect() == []  # no marker
    assert rollup.apply("b1", change) and table(rollup) == {("a", "en", "v1"): (1, 10)}
    with pytest.raises(ValueError):
        rollup.apply("../b", change)


def test_edge_cases(spark, edge, empty):
    got = tokens.bpe_counts(edge, VOCABULARY, "v").collect()
    assert len(got) == edge.count() and {r.tokens for r in got if r.doc_id in (2, 3)} == {0}
    assert tokens.word_counts(edge).count() == edge.count()
    assert tokens.bpe_counts(empty, VOCABULARY, "v").collect() == []
