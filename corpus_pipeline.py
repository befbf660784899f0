"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

Toxic documents go, one document of each near-duplicate group stays, secrets are replaced by a
mark, sources are mixed to their target weights, and the mix is packed into token sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import jaccard, mixing, packing, secrets, toxicity
from tokenloom.llm.common import table
from tokenloom.llm.queries import tokenizer_path
from tokenloom.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; the model learns from the labels of ``docs``."""
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.8 connect."""
    return jaccard.one_per_class(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced by a mark."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source up to its target: documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their ids and places in sequences."""
    return packing.pack_documents(docs, tokenizer_path(), cache_words=150_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Stages learn models and hash shingles, which SQL can't express; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
