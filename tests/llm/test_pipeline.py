"""The pipeline keeps clean documents and drops planted ones; every stage takes what the one before returns."""

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from outagegrid.llm import near_dedup
from outagegrid.session import REQUIRED


def test_names():
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "byte_bpe"]


def test_run_over_the_smallest_tables(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, size = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, data).cache()
        assert docs.columns == columns and 0 < docs.count() <= size
        size = docs.count()
    found = near_dedup.near_duplicates(docs, 5, 80)
    assert found.where("not kept").count() == 0
    whole = corpus_pipeline.run(spark, data)
    assert {r.doc_id for r in whole.collect()} == {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_hard_rows(spark, make, hard, data, name):
    docs = make(hard).select("doc_id", "text", "lang", "source", "n_chars")
    stage = dict(corpus_pipeline.STAGES)[name]
    for df in (docs, docs.where("false")):
        stage(spark, df, data).collect()


def test_a_stage_on_its_own_bounds_its_batches(spark, make, hard, data):
    """The toxicity stage took over 3,000 MB of an executor where nobody had configured the session."""
    docs = make(hard).select("doc_id", "text", "lang", "source", "n_chars")
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    try:
        dict(corpus_pipeline.STAGES)["byte_bpe"](spark, docs, data)
        assert spark.conf.get(key) == REQUIRED[key]
    finally:
        spark.conf.set(key, REQUIRED[key])
