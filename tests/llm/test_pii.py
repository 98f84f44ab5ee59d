import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.llm import pii
from barloom.llm.queries import op8_weak_supervision_pii
from tests.llm.conftest import SF

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def counts(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
    return True


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if counts(k, m.group())]


def check(texts, rows):
    for r in rows:
        spans = plain_spans(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s.startswith(k + ":") for s in spans) for k in PLAIN)
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        listed = [s for s in r.spans.split(",") if s]
        assert set(spans) <= set(listed)
        assert listed == sorted(listed, key=lambda s: (pii.KINDS.index(s.split(":")[0]), *map(int, s.split(":")[1:])))


def test_base_spans_of_the_query_equal_the_plain_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = op8_weak_supervision_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    check(texts, rows)


ODD = [
    "a@b.c_d@e.f x@y z@y. q@r.s@t.u a@b.c.d@e.f",
    "1.2.3.4.5.6.7.8 999.1.1.1 000255.0.0.1 12345678901.2.3.4 1.2.3 1..2.3.4 7.7.7.256",
    "4111 1111 1111 1111, 4111-1111-1111-1111-5 5500000000000004 340000000000009 4111  1111 1111 1111",
    "+1 (234) 567-8901 +12 +123456789 ++123456789012345 +1234567890123456 +1-",
    "1" * 50_000,
    "12 " * 5_000,
    "a@" * 5_000,
    "x" * 30_000 + "@y.z",
    "\U0001f600\U0001f600 é a@b.de 日本 10.0.0.1",
    "",
    None,
]


def test_odd_and_very_long_texts(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    check(dict(enumerate(ODD)), pii.detect(docs).collect())


@pytest.fixture(scope="module")
def finder(spark):
    def find(texts):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return pii.with_proposals(docs).select("doc_id", F.filter("__proposals", lambda s: s["strict"]).alias("s")).collect()

    return find


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="a@.+1 29-(é_", max_size=40), min_size=1, max_size=30))
def test_any_text_gives_the_plain_spans(finder, texts):
    for r in finder(texts):
        assert [f"{pii.KINDS[s.kind]}:{s.start}:{s.end}" for s in r.s] == plain_spans(texts[r.doc_id])


def test_the_classifier_adds_written_out_forms(spark):
    texts = [f"Mail to user{k}@mail.com or call +1 (234) 567-89{k:02d} today, from 10.0.0.{k}." for k in range(60)]
    texts += [f"Write to john{k} at mail dot com, tel. (234) 567-89{k:02d}, card 4111 1111 1111 1111." for k in range(40)]
    texts += [f"We meet at nine dot point {k}." for k in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in pii.detect(docs).collect()}
    assert all("phone" in rows[k] and "email" in rows[k] for k in range(60, 100))
    clean = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert clean[0] == "Mail to <email> or call <phone> today, from <ip>."
    assert clean[60] == "Write to <email>, tel. <phone>, card <card>."


def test_reliable_labelers_outweigh_others(spark):
    rows = [(0, 1, 1, 0, 1, 1, 90), (0, -1, -1, 0, -1, -1, 90), (0, 1, 1, 1, 1, -1, 5), (0, -1, -1, 0, -1, 1, 5)]
    patterns = spark.createDataFrame(rows, "kind int, form int, gazetteer int, context int, edges int, layout int, n long")
    p = [r.p for r in pii.estimate(patterns).orderBy("n", "form").collect()]
    assert p[0] < 0.1 and p[1] > 0.9 and p[2] < 0.1 and p[3] > 0.9


def test_many_loose_spans_are_not_matched_over_and_over(spark):
    text = "call 234-567-8901 or x@y.de now. " * 4000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.detect(docs).first()
    assert row.n_email == 4000 and row.spans.count("phone") in (0, 4000)


def test_edge_cases(spark, edge, empty):
    rows = pii.detect(edge).collect()
    assert len(rows) == edge.count()
    assert [r.spans for r in rows if r.doc_id is None and r.n_ip] == ["email:42:49,ip:28:36"]
    out = pii.redacted(edge)
    assert out.columns == edge.columns and out.filter("text is null").count() == 2
    assert pii.detect(empty).collect() == [] and pii.redacted(empty).collect() == []


def test_time_grows_with_the_spans_not_with_their_square(spark):
    def seconds(n):
        text = " ".join(f"user{k}@mail{k % 9}.com, {k % 200}.1.2.3 ask john at mail dot com" for k in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        judged = pii.with_proposals(docs).select(F.size("__proposals"))
        started = time.perf_counter()
        assert judged.first()[0] >= 2 * n
        return time.perf_counter() - started

    seconds(100)
    assert seconds(16_000) < 3 * max(seconds(8_000), 1.0)


def test_redaction_of_a_very_long_text(spark):
    text = "".join(f"é{k} a{k}@b.de 1.2.3.{k % 300} " for k in range(5_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    want = "".join(f"é{k} <email> {'<ip>' if k % 300 < 256 else f'1.2.3.{k % 300}'} " for k in range(5_000))
    assert pii.redacted(docs).first().text == want


def test_running_joins_what_comes_before(spark):
    chance = random.Random(3)
    rows = [[chance.randint(0, 9) for _ in range(n)] for n in (0, 1, 127, 128, 129, 1000)]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, x array<int>")
    got = df.select("k", F.expr(pii.running("x", "x", 0, pii.SUM)).alias("sum"), F.expr(pii.running("x", "x", 0, pii.MOST)).alias("top"))
    for r in got.collect():
        x = rows[r.k]
        assert r["sum"] == [sum(x[:i]) for i in range(len(x))]
        assert r.top == [max(x[:i], default=0) for i in range(len(x))]


@pytest.mark.parametrize("length", [0, 1, 1023, 1024, 1025, 5000])
def test_pieces_of_blocks(spark, length):
    text = "".join("aé\U0001f600\n"[k % 4] for k in range(length))
    ranges = [(0, 0), (0, 1), (5, 29), (1000, 1024), (1020, 1030), (1024, 1025), (900, 3100), (length, length + 1), (0, length)]
    df = spark.createDataFrame([(text, a, b) for a, b in ranges], "text string, a int, b int")
    got = df.withColumn("blocks", pii.blocks(F.col("text"))).select("a", "b", pii.piece(F.col("blocks"), F.col("a"), F.col("b")).alias("p"))
    assert [(r.a, r.b, r.p) for r in got.collect()] == [(a, b, text[a:b]) for a, b in ranges]


def test_loose_spans_that_touch_strict_ones_are_left_out(spark):
    chance = random.Random(5)
    for _ in range(3):
        strict = sorted({(a, a + chance.randint(1, 6)) for a in range(0, 400, 9) if chance.random() < 0.5})
        loose = sorted({(a, a + chance.randint(1, 6)) for a in range(3, 400, 7)})
        df = spark.createDataFrame([([(*s, "s") for s in strict], [(*s, "l") for s in loose])], f"s array<{pii.SPAN}>, l array<{pii.SPAN}>")
        got = df.withColumn("m", pii.mixed("s", "l")).select(pii.apart("m").alias("out")).first().out
        assert [(r.start, r.end) for r in got] == [x for x in loose if not any(a < x[1] and x[0] < b for a, b in strict)]


def test_names_of_further_columns_do_not_matter(spark):
    names = ["__email", "__text", "__spans", "__blocks", "__proposals", "row", "spans", "__strict_ip"]
    docs = spark.createDataFrame([(1, "to a@b.de", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = pii.redacted(docs)
    assert out.columns == docs.columns and tuple(out.first()) == (1, "to <email>", *names)
