import re
from collections import defaultdict

import numpy as np
import pytest

from barloom.llm import decontamination as dc
from barloom.llm.queries import op5_seeded_alignment
from tests.llm.conftest import SF


def words_of(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def brute_score(segment, passage):
    """Smith-Waterman by the plain recurrence."""
    best, before = 0, [0] * (len(passage) + 1)
    for a in segment:
        row = [0]
        for k, b in enumerate(passage, 1):
            row.append(max(0, before[k - 1] + (2 if a == b else -1), before[k] - 1, row[-1] - 1))
        best, before = max(best, *row), row
    return best


def test_alignment_equals_the_plain_recurrence():
    random = np.random.default_rng(4)
    ones, twos = random.integers(0, 6, (40, 9)), random.integers(0, 6, (40, 30))
    got = dc.align(ones.astype(np.int32), twos.astype(np.int32))
    assert got.tolist() == [brute_score(a.tolist(), b.tolist()) for a, b in zip(ones, twos)]


@pytest.mark.parametrize("block", [3, 40, dc.BLOCK])
def test_words_and_codes_do_not_depend_on_blocks(monkeypatch, block):
    text = "One, TWO-three: vier_fünf \U0001f600 ÄÖ 12.5!" * 7
    whole = dc.Words(text)
    monkeypatch.setattr(dc, "BLOCK", block)
    words = dc.Words(text)
    assert words.text(0, len(words)).split(" ") == words_of(text) and len(words) == len(words_of(text))
    assert (words.grams(3) == whole.grams(3)).all()
    ids = {}
    for gram, code in zip(zip(words_of(text), words_of(text)[1:], words_of(text)[2:]), words.grams(3).tolist()):
        assert ids.setdefault(gram, code) == code
    assert len(set(ids.values())) == len(ids)
    assert len(dc.Words(None)) == len(dc.Words("")) == len(dc.Words("... ")) == 0


def test_query_finds_every_planted_passage_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    grams = defaultdict(set)
    for item in items:
        words = words_of(item.text)
        for k in range(len(words) - 4):
            grams[tuple(words[k : k + 5])].add(item.item_id)
    sizes = defaultdict(int)
    for owners in grams.values():
        for item in owners:
            sizes[item] += 1
    want = set()
    for doc in docs:
        words, seen = words_of(doc.text), defaultdict(int)
        for gram in {tuple(words[k : k + 5]) for k in range(len(words) - 4)}:
            for item in grams.get(gram, ()):
                seen[item] += 1
        want |= {(doc.doc_id, item) for item, n in seen.items() if n >= 0.8 * sizes[item]}
    got = op5_seeded_alignment(spark, SF).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want and all(r.score > 0.8 for r in got)


@pytest.fixture(scope="module")
def world():
    random = np.random.default_rng(9)
    vocabulary = [f"word{k}" for k in range(3000)]
    item = list(random.choice(vocabulary, 40))
    other = lambda n: list(random.choice(vocabulary, n))
    edited = item.copy()
    for at in (7, 19, 30):
        edited[at] = "changed"
    del edited[12]
    edited.insert(25, "added")
    return {
        "item": item,
        "copy": other(500) + item + other(500),
        "edited": other(100) + edited + other(50),
        "upper": [w.upper() + "!" for w in item],
        "third": other(60) + item[:13] + other(60),
        "clean": other(2000),
        "long": other(20_000) + item + other(20_000),
    }


def test_copies_and_edited_copies_are_found(spark, world):
    names = [k for k in world if k != "item"]
    docs = spark.createDataFrame([(k, " ".join(world[n])) for k, n in enumerate(names)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(world["item"])), (2, "too short"), (3, None), (1, " ".join(world["item"]))], "item_id long, text string")
    found = {names[r.doc_id]: r for r in dc.contamination(docs, items).collect()}
    assert found.keys() == {"copy", "edited", "upper", "long"}
    assert found["copy"].score == found["upper"].score == 1.0 and 0.75 < found["edited"].score < 1
    assert {names[r.doc_id] for r in dc.clean(docs, items).collect()} == {"third", "clean"}


def test_an_item_in_most_documents_is_still_found(spark, world):
    texts = [" ".join(world["item"] + [f"own{k}"]) for k in range(60)] + [" ".join(world["clean"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(world["item"]))], "item_id long, text string")
    assert {r.doc_id for r in dc.contamination(docs, items).collect()} == set(range(60))


@pytest.mark.parametrize("rare", [dc.RARE, 0])
@pytest.mark.parametrize("copies, edits", [(0, 1), (1, 1), (20, 1), (1, 20)])
def test_an_item_with_every_fifth_word_replaced_is_found(spark, world, monkeypatch, copies, edits, rare):
    monkeypatch.setattr(dc, "RARE", rare)
    item = world["item"]
    broken = [w if k % 5 else f"instead{k}" for k, w in enumerate(item)]
    texts = [" ".join([*item, f"own{k}"]) for k in range(copies)] + [" ".join([f"other{k}", *broken]) for k in range(edits)]
    docs = spark.createDataFrame([*enumerate(texts), (99, " ".join(world["clean"]))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in dc.contamination(docs, items).collect()} == set(range(copies + edits))


def test_phrases_that_are_common_everywhere_are_no_seeds(spark, world, monkeypatch):
    monkeypatch.setattr(dc, "RARE", 5)
    phrase = world["item"][:5]
    texts = [f"{' '.join(phrase)} own{k}" for k in range(60)] + [" ".join(world["item"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, scan = [], dc.passages
    monkeypatch.setattr(dc, "passages", lambda d, seeds, n: seen.append(seeds.count()) or scan(d, seeds, n))
    items = spark.createDataFrame([(1, " ".join(world["item"]))], "item_id long, text string")
    assert {r.doc_id for r in dc.contamination(docs, items).collect()} == {60}
    assert seen == [35]


def test_long_items_are_cut_into_segments(spark, world):
    item = " ".join(world["clean"][:300])
    docs = spark.createDataFrame([(1, " ".join(world["copy"] + world["clean"][100:200])), (2, " ".join(world["copy"]))], "doc_id long, text string")
    rows = dc.contamination(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in rows] == [(1, 5)]


def test_edge_cases(spark, edge, empty):
    items = spark.createDataFrame([(1, "A text without any id, from 10.0.0.1, for a@b.org."), (None, "one plain text about a fox and a dog")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.contamination(edge, items).collect()}
    assert got == {(None, 1), (1, None)}
    kept = dc.clean(edge, items)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 3
    assert dc.contamination(empty, items).collect() == [] and dc.contamination(edge, items.limit(0)).collect() == []
