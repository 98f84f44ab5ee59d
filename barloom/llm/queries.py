"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    collocations,
    crosspolytope,
    decontamination,
    hasharrays,
    kneserney,
    langid,
    mixing,
    oracle,
    periodicity,
    pii,
    scenarios,
    simhash,
    tokens,
    toxicity,
    urls,
    warc,
)
from barloom.llm.common import crc_part, durable, read_table, shared_dir, sized


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(read_table(spark, sf_dir, "pages"), URL_RULES)


def op2_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(crc_part("doc_id", 3) != 1))
    found = toxicity.score(docs, model)
    spans = F.transform("offending", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        "doc_id",
        F.coalesce(crc_part("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.concat_ws(",", spans).alias("offending"),
    )


def op3_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mixing.mix(docs, weights=(5.0, 2.0, 1.0), share=1.5, max_epochs=2.0)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = simhash.near_duplicate_fingerprints(docs, words=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_seeded_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"), "start")


def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return crosspolytope.near_duplicate_vectors(vectors, least=0.9)


def op7_centroid_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_part("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(langid.training_rows(docs, held_out))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(read_table(spark, sf_dir, "documents"))


def op9_delta_rollup(spark: SparkSession, sf_dir: str, vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken") -> DataFrame:
    """Counts all documents under two tokenizer versions, then applies what ``labels`` says of them:
    toxic ones are deleted, ones of low quality are revised to their count without repeated lines.
    The second batch is sent twice, as after a lost answer."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))

    def counts(rows: DataFrame) -> DataFrame:
        return tokens.bpe_counts(rows, vocabulary, "byte_bpe_50k").unionByName(tokens.word_counts(rows))

    rollup = tokens.Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    rollup.apply("000-load", tokens.changes(counts(docs), "insert"))
    found = rollup.ledger().join(labels, "doc_id")
    deleted = found.filter("toxic = 1").select("doc_id", "source", "lang", "version", "tokens")
    poor_ids = durable(labels.filter("quality = 0 and coalesce(toxic, 0) != 1").select("doc_id"))
    poor = docs.join(sized(poor_ids), "doc_id", "left_semi")
    revised = tokens.changes(counts(tokens.without_repeated_lines(poor)), "revise")
    for _ in range(2):
        rollup.apply("001-labels", tokens.changes(deleted, "delete").unionByName(revised))
    return rollup.totals()


def op10_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(read_table(spark, sf_dir, "pages"), folder)
    found = warc.read(spark, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_direct_address_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/phrases-{uuid.uuid4().hex}"
    return collocations.collocations(docs, folder, most_words=3, least=10, covered_percent=50, top=2000)


def op12_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under a bigram model of those that are not held out; its files go once they are scored."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_part("doc_id", 7) == 2, F.lit(False))
    folder = f"{shared_dir(spark)}/lm-{uuid.uuid4().hex}"
    model = kneserney.fit(docs.filter(~held_out), folder, order=2)
    found = durable(kneserney.score(docs, model))
    hasharrays.remove(folder)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op13_lcp_kruskal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of six words and four periods or more, in all documents, a tenth of them made to repeat themselves."""
    docs = scenarios.with_repeats(read_table(spark, sf_dir, "documents"))
    found = periodicity.periodic_runs(docs, least_length=6, least_exponent=4)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        query.__name__: query
        for query in (
            op1_redirect_equivalence,
            op2_noisy_or_toxicity,
            op3_water_filling,
            op4_simhash,
            op5_seeded_alignment,
            op6_cross_polytope,
            op7_centroid_langid,
            op8_weak_supervision_pii,
            op9_delta_rollup,
            op10_sharded_warc,
            op11_direct_address_tiling,
            op12_kneser_ney,
            op13_lcp_kruskal,
        )
    }


def llm_sql() -> dict[str, str]:
    return {"op1_redirect_equivalence": oracle.OP1, "op6_cross_polytope": oracle.OP6, "op10_sharded_warc": oracle.OP10, "op11_direct_address_tiling": oracle.OP11}
