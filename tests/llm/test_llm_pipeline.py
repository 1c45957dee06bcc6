"""Stages of the pipeline, each against its own input, and the registered queries."""

import re

import pytest

import corpus_pipeline
from llm_helpers import clashing, empty_documents, odd_documents
from odmeter.llm import mixing
from odmeter.llm.queries import QUERIES
from odmeter.session import new_folder
from test_llm_copies import brute_classes
from test_llm_models import brute_base
from test_llm_tokens import gapless


def test_stages_one_by_one(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    columns, seen = rows.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = new_folder(spark, name)
        stage(spark, rows, sf).write.parquet(path)
        seen[name] = (rows, rows := spark.read.parquet(path))
        assert name == corpus_pipeline.STAGES[-1][0] or rows.columns == columns

    before, after = seen["quality_classifier"]
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    judged = [(r["doc_id"] in kept, labels[r["doc_id"]]) for r in before.collect() if r["doc_id"] in labels]
    assert sum(k == (q == 1) for k, q in judged) > 0.95 * len(judged)

    before, after = seen["near_dedup"]
    pairs = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({c for _, c, _ in brute_classes(pairs)})

    before, after = seen["personal_data"]
    texts = {r["doc_id"]: r["text"] for r in after.collect()}
    for r in before.collect():
        if brute_base(r["text"]):
            assert not brute_base(texts[r["doc_id"]])
        elif not re.search("[0-9@]", r["text"]):
            assert texts[r["doc_id"]] == r["text"]

    before, after = seen["mix_sources"]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sizes(before).collect() if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()} == copies

    before, after = seen["best_fit_packing"]
    packed = [tuple(r) for r in after.collect()]
    gapless(packed)
    assert sum(r[1] == 0 for r in packed) == before.count()


def test_odd_documents_pass_every_stage(spark, sf):
    rows = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES[1:]:
        path = new_folder(spark, "odd")
        stage(spark, rows, sf).write.parquet(path)
        rows = spark.read.parquet(path)
    assert rows.count() > 0


@pytest.mark.parametrize("kind", ["odd", "clashing", "empty", "repeated"])
def test_whole_pipeline_on_unusual_tables(spark, sf, kind):
    """All stages from the classifier on, each written and read; stages but the last keep the columns."""
    rows = empty_documents(spark) if kind == "empty" else odd_documents(spark)
    if kind == "clashing":
        rows = clashing(rows, "score", "size", "class", "position", "key", "taken")
    if kind == "repeated":
        rows = rows.unionByName(rows).unionByName(spark.read.parquet(f"{sf}/documents.parquet").select(rows.columns).limit(40))
    columns = rows.columns
    for name, stage in corpus_pipeline.STAGES:
        path = new_folder(spark, f"{kind}-{name}")
        stage(spark, rows, sf).write.parquet(path)
        rows = spark.read.parquet(path)
        assert name == corpus_pipeline.STAGES[-1][0] or rows.columns == columns
    assert kind != "empty" or rows.count() == 0


def test_registered_names():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
