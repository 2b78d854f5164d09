"""The corpus pipeline, its stages on odd rows, and the queries' registration."""

from __future__ import annotations

import __spark_entry__ as wiring
import corpus_pipeline
from quillsift.llm.near_dedup import near_classes
from quillsift.llm.staging import staged, table
from quillsift.llm.toxicity import score_documents


def test_stages_take_odd_rows_and_keep_columns(spark, sf_dir, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = staged(spark, stage(spark, docs, sf_dir), "test")
        assert docs.columns == columns, name
        assert docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0


def test_stages_take_empty_tables(spark, sf_dir, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf_dir).count() == 0, name


def test_decisions_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = staged(spark, corpus_pipeline.drop_toxic(spark, docs, sf_dir), "test")
    scores = score_documents(spark, docs, table(spark, sf_dir, "labels"))
    clean = {r.doc_id for r in scores.where("predicted = 0").collect()}
    assert {r.doc_id for r in kept.collect()} == clean
    single = staged(spark, corpus_pipeline.drop_near_copies(spark, kept, sf_dir), "test")
    assert single.count() == near_classes(spark, kept).select("class_id").distinct().count()


def test_every_operator_has_a_query():
    names = wiring.queries().keys()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert "pipeline" in names
