"""The corpus pipeline: documents in, token ids of clean documents out.

Each stage takes the documents its predecessor kept and returns those it keeps, with the columns of
``documents``; the last returns a row of token ids for each document that is left. Stages are written
as Parquet and read again, so each starts from stored rows and a lost executor costs one stage at most.

An empty or missing text, repeated rows and extra columns have the results stated in the operators'
modules; extra columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketflow.llm import classifier, decontamination, jaccard, pieces, pii
from basketflow.llm.base import table
from basketflow.workspace import new_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return classifier.accepted(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return jaccard.one_of_each(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return pii.redacted(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become piece ids."""
    return pieces.round_trip(docs)


STAGES = [
    ("quality_classifier", keep_quality),
    ("jaccard_join", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("pii", redact_personal_data),
    ("sentencepiece", encode_pieces),
]

#: Trained trees, discriminants and MinHash have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
