"""The corpus pipeline: stages over ``documents``, each applying one operator of ``odmeter.llm``.

``run`` writes what each stage returns as Parquet in the shared folder and reads it again for the next one, so that a lost executor
costs one stage at most.  All stages but the last return the columns of documents.

Defined results: an empty table passes as an empty table.  NULL and empty texts score by the classifier's bias alone, are copies of nothing, hold
no personal data, and are no part of the mix, since they have no words; a NULL doc_id, source or n_chars stays as it is, and a NULL source is a source
of its own.  Of rows that repeat one stays after near_dedup, and as many as the mix takes of it come after it.  Texts of any length
are processed whole.  Extra columns are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odmeter.llm import mixing, near_copies, packing, pii, quality_model
from odmeter.session import new_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, scores at the threshold or above."""
    weights = quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_model.score(docs, weights)
    return scored.where(F.col("score") >= quality_model.THRESHOLD).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id."""
    return near_copies.drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked by its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality),
    ("near_dedup", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix),
    ("best_fit_packing", packed),
]

#: The classifier, the tagger, the signatures and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
