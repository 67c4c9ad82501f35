"""The pipeline: each stage takes the columns of documents and its decision takes effect."""

from __future__ import annotations

import corpus_pipeline
from reviewlake.llm.queries import QUERIES
from tests.llm.test_documents import brute_components


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    columns, given = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, given, sf_dir).cache()
        assert kept.columns == columns, name
        if name == "toxicity":
            toxic = {r["doc_id"] for r in QUERIES["op10_toxicity"](spark, sf_dir).filter("predicted = 1").collect()}
            assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - toxic
        if name == "near copies":
            want = brute_components([(r["doc_id"], r["text"] or "") for r in given.collect()], corpus_pipeline.SIMILAR_PERCENT)
            assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _, _, stays in want if stays)
        if name == "repeated passages":
            before = {r["doc_id"]: r for r in given.collect()}
            seen: set[str] = set()
            for r in kept.orderBy("doc_id").collect():
                assert r["n_chars"] == len(r["text"])
                text = before[r["doc_id"]]["text"]
                again = any(text[i:i + 200] in seen for i in range(len(text) - 199)) if text.isascii() else None
                if again is not None:
                    assert again == (r["text"] != text) or not again
                seen.update(text[i:i + 200] for i in range(len(text) - 199))
        if name == "mixture":
            ids = {r["doc_id"] for r in given.collect()}
            counts = kept.groupBy("doc_id").count().collect()
            assert {r["doc_id"] for r in counts} <= ids and max(r["count"] for r in counts) <= 3
        given = kept
    tokens = corpus_pipeline.STAGES[-1][1](spark, given, sf_dir)
    assert tokens.count() == given.count() and tokens.filter("n_tokens != size(ids)").count() == 0


def test_odd_rows_pass_all_stages(spark, sf_dir, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, sf_dir)
            assert kept.columns == docs.columns
            kept.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
