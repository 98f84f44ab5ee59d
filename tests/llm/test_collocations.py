import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from barloom.llm import collocations, hasharrays
from barloom.llm.queries import op11_direct_address_tiling, oracle
from tests.compare import connect, differences
from tests.llm.conftest import SF, edge_rows


def brute(docs, most_words, least, percent, top):
    """Ranked phrases of (lang, text) rows, from the definition."""
    table = {c: c + 32 for c in range(65, 91)}
    counts, out = defaultdict(Counter), []
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(table)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for n in range(1, most_words + 1):
                counts[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    for lang, f in counts.items():
        total = sum(k for g, k in f.items() if len(g) == 1)
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        inside = lambda g, h: any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
        rows = []
        for g, a in found.items():
            if any(len(h) > len(g) and 100 * b >= percent * a and inside(g, h) for h, b in found.items()):
                continue
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out)


@pytest.mark.parametrize("most_words", [2, 3, 4])
def test_phrases_of_random_texts(spark, tmp_path, monkeypatch, most_words):
    monkeypatch.setattr(collocations, "SHARD_BYTES", 4000)
    monkeypatch.setattr(collocations, "SHARD_ROWS", 10)
    random = np.random.default_rng(most_words)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "a-b", "New", "York", "city"]
    chances = 1 / np.arange(1, 36)
    docs = []
    for k in range(300):
        words = [str(w) + random.choice(["", "", "", ",", ".", "\n"]) for w in random.choice(vocabulary, 25, p=chances / chances.sum())]
        words[5:5] = ["New", "York", "City"] if k % 3 else ["new", "york"]
        docs.append((["en", "de", None][k % 3 if k % 2 else 0], " ".join(words)))
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    got = collocations.collocations(df, f"{tmp_path}/p", most_words, 4, 50, 60)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, most_words, 4, 50, 60)
    assert not (tmp_path / "p").exists()


@pytest.mark.parametrize("side, filled", [(4, 1), (4, 20), (1024, 1)])
def test_crowded_tiles_and_sorted_coordinates_count_all_cells(monkeypatch, side, filled):
    monkeypatch.setattr(collocations, "SIDE", side)
    monkeypatch.setattr(collocations, "FILLED", filled)
    random = np.random.default_rng(side + filled)
    tiles, want, parts = collocations.Tiles(), Counter(), []
    for _ in range(5):
        left, right = (np.minimum(random.zipf(1.3, 400), 10_000) - 1 for _ in range(2))
        want.update(zip(left.tolist(), right.tolist()))
        parts.append(tiles.add(left, right))
    parts += list(tiles.counted())
    got = Counter()
    for keys, counts in parts:
        assert (np.diff(keys[:, 0].astype(object)) > 0).all()
        for key, n in zip(keys[:, 0].tolist(), counts[:, 0].tolist()):
            got[key >> 32, key & 0xFFFFFFFF] += n
    assert got == want and (len(tiles.dense) > 0 or filled > 1)


def test_blocks_of_words_keep_languages_apart(monkeypatch):
    class Ids:
        """Finds the keys of the words it was made of."""

        def __init__(self, words):
            self.keys = {}
            for number, (lang, word) in enumerate(words):
                key = xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang, xxhash.xxh64_intdigest("0", 42)))
                self.keys[int(hasharrays.mixed(np.array([key], np.uint64))[0])] = number

        def find(self, keys):
            found = np.array([self.keys.get(int(k), -1) for k in keys])
            return None, found, {"id": np.maximum(found, 0)}

    texts = [("en", b"A b. rare c"), ("de", b"a"), ("en", None), ("en", b"b\tc!b")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*texts)], names=["lang", "text"])
    ids = Ids([("en", "a"), ("en", "b"), ("en", "c"), ("de", "a")])
    for size in (1, 3, 1000):
        monkeypatch.setattr(collocations, "BLOCK", size)
        parts = np.concatenate(list(collocations.Texts(0, ids).blocks(iter([batch])))).tolist()
        text = " ".join("|" if i < 0 else str(i) for i in parts)
        assert sorted(re.split(r"[| ]*\|[| ]*", text.strip("| "))) == ["0 1", "1", "1 2", "2", "3"]


def test_query_equals_its_twin_on_the_larger_table(spark):
    assert differences(op11_direct_address_tiling(spark, SF), connect(SF).sql(oracle.OP11)) is None


def test_edge_cases(spark, tmp_path, edge, empty):
    assert collocations.collocations(empty, f"{tmp_path}/none").collect() == []
    got = collocations.collocations(edge, f"{tmp_path}/edge", least=2, top=100_000)
    want = brute([(r[2], r[1]) for r in edge_rows()], 3, 2, 50, 100_000)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_scores_beyond_64_bits_are_exact(spark):
    a, left, right = 10**12 + 7, 10**12 + 9, 3 * 10**12 + 1
    levels = [
        spark.createDataFrame([([1], left, 1), ([2], right, 2)], "words array<long>, n long, id long"),
        spark.createDataFrame([([1, 2], a, 1)], "words array<long>, n long, id long"),
    ]
    (row,) = collocations.scored(levels).collect()
    assert row.score == 1000000 * a * a // (left * right) and (row.l, row.r) == (left, right)


def test_keys_of_spark_and_python_agree(spark):
    start = xxhash.xxh64_intdigest("3", 42)
    want = xxhash.xxh64_intdigest("wört", xxhash.xxh64_intdigest("de", start))
    got = spark.range(1).select(collocations._word_key(3, F.lit("de"), F.lit("wört"))).first()[0]
    assert got % 2**64 == want
