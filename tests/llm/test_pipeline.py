import corpus_pipeline
from barloom.llm import decontamination
from tests.llm.conftest import SF


def test_stages_on_all_that_is_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept[name] <= before
        before = kept[name]
        assert docs.columns == (columns if name != "source_mixing" else [*columns, "repetition"])
    assert len(kept["language_id"]) >= 0.998 * 1000
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    mixed = spark.read.parquet(f"{tmp_path}/benchmark_decontamination")
    assert decontamination.contamination(mixed, items).count() == 0
    assert kept["pii"] == kept["benchmark_decontamination"]
    clean = spark.read.parquet(f"{tmp_path}/pii")
    assert clean.filter("text rlike '[a-z]@[a-z0-9]+[.]' or n_chars != length(text)").count() == 0


def test_edge_cases_pass_through_every_stage(spark, edge, empty):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (edge, empty):
            out = stage(spark, docs, SF)
            rows = out.count()
            assert set(docs.columns) <= set(out.columns), name
            assert rows <= 2 * docs.count()
