"""The stages in order on the smallest tables: every decision holds on the next input."""

import corpus_pipeline

from urbanloom.llm import lsh_forest, quality_rules
from urbanloom.llm.common import stored, table

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, FOLDER, "documents")
    kept = stored(corpus_pipeline.quality(spark, docs, FOLDER), "t")
    good = {r["id"] for r in quality_rules.judge(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good and kept.columns == docs.columns
    cut = stored(corpus_pipeline.lines(spark, kept, FOLDER), "t")
    assert cut.columns == docs.columns and cut.count() == len(good)
    single = stored(corpus_pipeline.near_duplicates(spark, cut, FOLDER), "t")
    again = lsh_forest.near_duplicates(single)
    assert single.columns == docs.columns and again.filter("not kept").count() == 0
    mixed = stored(corpus_pipeline.mixture(spark, single, FOLDER), "t")
    assert mixed.columns == docs.columns and mixed.count() > 0
    most = mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0]
    assert most <= 3
    assert corpus_pipeline.tokens(spark, mixed, FOLDER).count() == mixed.count()
