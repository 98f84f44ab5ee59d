import zlib

import numpy as np
import pytest

import corpus_pipeline
from barloom.llm import langid
from barloom.llm.queries import op7_centroid_langid
from tests.llm.conftest import SF


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op7_centroid_langid(spark, SF).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.lang_pred in {"en", "fr", "de", "es"} for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert sum(r.rejected for r in rows) <= 0.002 * len(rows)


def plain_counts(text):
    """Number of 1-, 2- and 3-grams over letters, words parted by one blank."""
    line = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    return sum(c != " " for c in line) + (len(line) - 1) + (len(line) - 2)


@pytest.mark.parametrize("block", [5, 64, langid.BLOCK])
def test_counts_do_not_depend_on_blocks(monkeypatch, block):
    text = "Grüße an alle, die 3 Äpfel -- und Birnen essen! " * 9
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "BLOCK", block)
    assert (langid.gram_counts(text) == whole).all() and whole.sum() == plain_counts(text)


def test_several_centroids_are_found():
    random = np.random.default_rng(2)
    centres = np.eye(4, 50)
    x = np.abs(centres[np.arange(200) % 4] + random.normal(scale=0.05, size=(200, 50)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centroids, own = langid.spherical_means(x, 4)
    assert len({tuple(own[k::4]) for k in range(4)}) == 4 and all(len(set(own[k::4])) == 1 for k in range(4))


def test_outliers_get_no_centroid_of_their_own():
    random = np.random.default_rng(6)
    groups = np.eye(4, 400)
    x = np.abs(groups[np.arange(400) % 4] * 0.6 + random.normal(scale=0.04, size=(400, 400)))
    x[:6] = np.eye(400)[100:106]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centroids, own = langid.spherical_means(x, 4)
    assert np.bincount(own).min() >= 0.02 * len(x)
    assert len({np.bincount(own[6:][np.arange(6, 400) % 4 == k]).argmax() for k in range(4)}) == 4


FOREIGN = {
    "ru": "Привет мир как дела сегодня хорошая погода мы идём гулять в парк вместе с друзьями и собакой",
    "el": "Καλημέρα κόσμε τι κάνετε σήμερα ο καιρός είναι καλός και πάμε στο πάρκο με τους φίλους μας",
    "zh": "今天天气很好我们一起去公园散步然后回家吃晚饭明天还要上班所以早点睡觉晚安朋友们",
    "pl": "Dzień dobry świecie dzisiaj jest ładna pogoda i idziemy na spacer do parku razem z przyjaciółmi",
    "junk": " ".join("".join(np.random.default_rng(k).choice(list("bcdfghjklmnpqrstvwxz"), 6)) for k in range(60)),
}


def test_the_pipeline_rejects_other_scripts_and_junk_and_keeps_clean_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    held = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    model = langid.fit(docs.filter(f"not ({held})"))
    clean = docs.filter(held)
    assert langid.accepted(clean, model).count() >= 0.99 * clean.count()
    foreign = spark.createDataFrame([(10**9 + k, t, "en") for k, t in enumerate(FOREIGN.values())], "doc_id long, text string, lang string")
    assert langid.accepted(foreign, model).collect() == []
    # As the pipeline calls it: they are among the rows that train. Polish then comes too near the bar to tell.
    foreign = foreign.filter(f"doc_id != {10**9 + list(FOREIGN).index('pl')}")
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(foreign), SF)
    assert kept.filter("doc_id >= 1000000000").collect() == [] and kept.count() >= 0.998 * docs.count()


def test_far_texts_are_rejected_and_edge_cases_hold(spark, edge, empty):
    texts = [(k, "der die das und ist nicht ein " * 5, "de") for k in range(20)] + [(50 + k, "the and of to in is not a " * 5, "en") for k in range(20)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    model = langid.fit(rows, slack=0.5)
    asked = spark.createDataFrame([(1, "und die"), (2, "Привет мир как дела"), (3, "123"), (4, None), (5, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(asked, model).collect()}
    assert got[1].lang_pred == "de" and got[2].rejected and got[2].lang_pred in ("de", "en")
    assert all((got[k].lang_pred, got[k].score, got[k].rejected) == ("und", 0.0, True) for k in (3, 4, 5))
    assert langid.predict(edge, langid.fit(edge)).count() == edge.count()
    assert langid.accepted(edge, langid.fit(edge)).columns == edge.columns
    nothing = langid.fit(empty)
    assert langid.predict(empty, nothing).collect() == []
    assert all(r.lang_pred == "und" for r in langid.predict(asked, nothing).collect())
