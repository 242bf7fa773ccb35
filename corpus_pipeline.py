"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before has kept; run() writes each
result as Parquet and rereads it.  Nulls, empty texts, repeated rows and further columns are treated as
the operators' docstrings say; an empty table passes through every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetime.llm import decontam, near_dedup, packing, pii, quality
from stagetime.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from all labelled ones, doesn't reject."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(docs, labels)
    name = f"score_{uuid.uuid4().hex}"  # docs may have a column of any name
    return quality.score(docs, model, name).filter(F.col(name) >= 0.5).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are similar by 0.8 or more."""
    return near_dedup.without_near_duplicates(docs, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that holds a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that reveal it replaced."""
    return pii.sanitise(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in the sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("personal data", mask_personal_data),
    ("packing", pack_sequences),
]

#: Trained models and tokenisers are beyond SQL; tests hold the operators against brute force and run the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
