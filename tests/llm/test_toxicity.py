import zlib
from random import Random

from barloom.llm import toxicity
from barloom.llm.queries import op2_noisy_or_toxicity

SF1 = "/root/testdata/sf0.1"


def auc(positive, negative):
    return sum((p > n) + 0.5 * (p == n) for p in positive for n in negative) / (len(positive) * len(negative))


def test_held_out_ranking_and_decisions(spark):
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    rows = op2_noisy_or_toxicity(spark, SF1).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    toxic, clean = ([r for r in held if label[r.doc_id] == y] for y in (1, 0))
    assert auc([r.score for r in toxic], [r.score for r in clean]) > 0.9
    assert sum(r.predicted for r in toxic) > 0.75 * len(toxic)
    assert sum(r.predicted for r in clean) < 0.03 * len(clean)


def planted(n=600):
    """Texts of five lines; in every fourth, one line holds the word that makes it toxic."""
    random = Random(8)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(4))
    docs, labels, bad = [], [], {}
    for k in range(n):
        lines = [f"The {word()} {word()} met a {word()}." for _ in range(5)]
        if k % 4 == 0:
            bad[k] = lines[k % 5] = f"The vile {word()} met a {word()}."
        docs.append((k, "\n".join(lines)))
        labels.append((k, int(k in bad)))
    return docs, labels, bad


def test_offending_sentences_are_located_from_document_labels(spark):
    docs, labels, bad = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    for r in toxicity.score(df, model).collect():
        found = [docs[r.doc_id][1][s.start : s.end] for s in r.offending]
        assert found == ([bad[r.doc_id]] if r.doc_id in bad else [])
        assert (r.score >= 0.7) == (r.doc_id in bad) and r.sentences == 5


def test_score_is_the_noisy_or_of_its_sentences():
    model = {"weights": {toxicity.bucket("bad"): 3.0, toxicity.bucket("awful"): 5.0}, "bias": -4.0, "leak": 0.1}
    score, count, _ = toxicity.Scorer(model).score("Bad day. Awful bad day! Fine.", 0.5)
    p = [1 / (1 + 2.718281828459045 ** -z) for z in (-1.0, 4.0, -4.0)]
    assert count == 3 and abs(score - (1 - 0.9 * (1 - p[0]) * (1 - p[1]) * (1 - p[2]))) < 1e-9


def test_edge_cases(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (4, 0), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(edge, labels)
    rows = toxicity.score(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.sentences for r in rows if r.doc_id in (2, 3, 5)} == {0}
    nothing = toxicity.fit(edge, labels.limit(0))
    assert {r.score for r in toxicity.score(edge, nothing).collect()} <= {0.0} | {r.score for r in toxicity.score(edge, nothing).collect() if r.score < 1e-6}
    assert toxicity.score(empty, nothing).collect() == []
