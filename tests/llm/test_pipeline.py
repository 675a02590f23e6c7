"""The pipeline's stages on their own inputs, and the registered queries."""

from __future__ import annotations

import hashlib

import pytest

import __spark_entry__ as contract
import compare
import corpus_pipeline
from tallymill.llm import exact_dedup, ngram_join, pii, quality, secrets
from tallymill.llm.queries import QUERIES


def test_stages_keep_columns_and_decide(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = corpus_pipeline.good_documents(spark, docs, folder).cache()
    assert good.columns == docs.columns
    verdicts = {r.doc_id: r.kept for r in quality.quality(docs).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, kept in verdicts.items() if kept}
    once = corpus_pipeline.distinct_documents(spark, good, folder).cache()
    assert {r.doc_id for r in once.collect()} == {
        r.doc_id for r in exact_dedup.exact_groups(good).collect() if r.kept}
    unlike = corpus_pipeline.unlike_documents(spark, once, folder).cache()
    assert {r.doc_id for r in unlike.collect()} == {
        r.doc_id for r in ngram_join.near_groups(once).collect() if r.doc_id == r.component_id}
    masked = corpus_pipeline.masked_documents(spark, unlike, folder).cache()
    assert masked.columns == docs.columns and masked.count() == unlike.count()
    assert masked.filter("n_chars <> length(text)").isEmpty()
    packed = corpus_pipeline.packed_sequences(spark, masked, folder)
    assert packed.select("doc_id").distinct().count() == masked.count()


def test_run_ends_in_pieces(spark, folder):
    assert not corpus_pipeline.run(spark, folder).isEmpty()


def test_exact_groups_equal_sql(spark, folder):
    difference = compare.difference(
        QUERIES["op10_exact_dedup"](spark, folder), compare.connect(folder), exact_dedup.EXACT_SQL)
    assert difference is None


@pytest.mark.parametrize("name, finder", [("op1_secret_network", secrets), ("op3_personal_segments", pii)])
def test_span_queries_digest_the_fixed_spans(spark, folder, name, finder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES[name](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = finder.fixed_spans(texts[r.doc_id])
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert all(r[f"n_{k}"] == sum(kind == k for kind, _, _ in spans) for k in finder.KINDS)
        assert {*written.split(",")} - {""} <= {*r.spans.split(",")}


@pytest.mark.parametrize("name", ["op2_url_words", "op4_prefix_bpe", "op6_chat_tree", "op7_quality_votes"])
def test_queries_answer_for_every_key(spark, folder, name):
    key, table = {"op2": ("page_id", "pages"), "op6": ("conv_id", "conversations")}.get(name[:3], ("doc_id", "documents"))
    got = [r[0] for r in QUERIES[name](spark, folder).select(key).collect()]
    ids = {r[0] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect()}
    assert sorted(got) == sorted(ids | ({-7} if key == "conv_id" else set()))


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert {name.split("_")[0] for name in QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}
