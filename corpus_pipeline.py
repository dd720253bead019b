"""Corpus pipeline: five stages from raw documents to token ids.

Each stage is written as Parquet and read again as the next one's input, so a
lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import minhash, mixing, pieces, suffixes, toxicity
from kestrel.llm.common import give_back, release, table
from kestrel.llm.queries import sentencepiece_model
from kestrel.session import checkpoint_dir


def settled(stage: Callable) -> Callable:
    """``stage`` from a driver that has given back what the stage before left: Python's memory and the JVM's garbage.

    A stage holds its training rows, plans and task results until then; five stages in one driver add up.
    """
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark)
        give_back()
        out = stage(spark, docs, sf_dir)
        release(spark)
        give_back()
        return out
    return run


@settled
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


@settled
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.drop_near_duplicates(docs)


@settled
def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 100 bytes or more that start earlier in the corpus."""
    out = suffixes.drop_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@settled
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


@settled
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of each document of the mix."""
    return pieces.encode_documents(docs, sentencepiece_model())


STAGES = [
    ("toxicity", toxicity_stage),
    ("minhash_dedup", near_dedup_stage),
    ("suffix_dedup", repeats_stage),
    ("mix_sources", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: SQL cannot express the stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
