"""The pipeline as a whole and its stages against plain versions."""

from __future__ import annotations

import pytest

import corpus_pipeline as pipeline
from oreline.scratch import fresh_path

from . import brute
from .fixtures import clashing, frame, made

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark):
    """The smallest data with awkward rows added."""
    root = fresh_path(spark, "pipeline-input")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    extra = frame(spark, made() + [(None, "row without an id"), (1004, None)])
    docs.unionByName(extra.select(*docs.columns)).write.parquet(f"{root}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    return root


def test_run_equals_its_stages_on_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in pipeline.reject_toxic(spark, docs, folder).collect()]
    assert len(rows) > 200
    firsts = {}
    for doc, text in rows:
        firsts[text or ""] = max(firsts.get(text or "", (False, 0, None)), (doc is not None, doc or 0, doc))
    kept = [(top[2], text) for text, top in firsts.items()]
    exact = pipeline.drop_exact_copies(spark, pipeline.reject_toxic(spark, docs, folder), folder)
    assert sorted((r.doc_id, r.text or "") for r in exact.where("doc_id is not null").collect()) == sorted(x for x in kept if x[0] is not None)
    known = [x for x in kept if x[0] is not None]
    near = {doc for doc, (_, _, stays) in brute.near(known).items() if stays}
    got = {r.doc_id for r in pipeline.drop_near_copies(spark, exact, folder).collect()}
    assert got - {None} == near
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    texts = dict(known)
    clean = {doc for doc in near if not any(i in texts[doc] for i in items)}
    final = {r.doc_id for r in pipeline.run(spark, folder).collect()} - {None}
    assert final <= clean and len(clean - final) <= 2  # re-parameterised items may go as well


def test_stages_keep_the_columns(spark, folder):
    docs = clashing(spark.read.parquet(f"{folder}/documents.parquet"))
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    assert pipeline.STAGES[-1][1](spark, docs, folder).columns == ["doc_id", "n_tokens", "p_good", "p_poor", "rate"]


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, folder).isEmpty()
