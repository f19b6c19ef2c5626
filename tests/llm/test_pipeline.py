"""The stages of the pipeline on odd tables; see test_llm_queries for what they decide."""

import pytest

import corpus_pipeline
from tests.llm.conftest import words

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_on_odd_rows(spark, make_docs, odd_rows, rows):
    """Null ids, texts, sources and languages, empty and very long texts, repeated rows, no rows, clashing columns."""
    own = [(1000 + i, words(60, i)) for i in range(30)] + [(1000, words(60, 0))]
    docs = make_docs(odd_rows + own if rows == "odd" else [])
    if rows == "odd":
        blank = make_docs([(70, words(50, 99)), (None, words(50, 98))], lang=None, source=None)
        docs = docs.unionByName(blank)
    docs = docs.withColumnRenamed("gone", "matches before").withColumnRenamed("cell", "a.b")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns == corpus_pipeline.COLUMNS if name != "source_mixing" else set(corpus_pipeline.COLUMNS) <= set(out.columns)
        found = out.collect()
        given = {(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()}
        assert len(found) <= docs.count()
        if name != "line_dedup":
            assert {(r["doc_id"], r["text"]) for r in found} <= given
        else:
            # Lines may go, rows do not; a row without an id loses nothing.
            assert len(found) == docs.count()
            assert {r["text"] for r in found if r["doc_id"] is None} == {t for i, t in given if i is None}
        if name == "jaccard_join":
            # Rows without an id or a word are no copies of others.
            assert {r["text"] for r in found if r["doc_id"] is None} == {t for i, t in given if i is None}
        extra = [f"{i} AS `{c}`" for i, c in enumerate(("n_words", "score", "component_id", "tokens"))]
        docs = spark.createDataFrame(found, out.schema).selectExpr("*", *extra)
