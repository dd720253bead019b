"""Registered queries of this package: ``opN_<name>`` and, where SQL can express it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (
    balltree, chat, lexical, linequality, maintext, merkle, minhash, mixing, oracles, pieces, quality, suffixes, toxicity, warc)
from kestrel.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_minhash_dedup", oracles.MINHASH)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents, linked by exact similarity of 0.75 or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_warc_round_trip", oracles.WARC)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC archives in the shared folder and read them back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query("op3_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return maintext.extract(table(spark, sf_dir, "pages"))


@query("op4_suffix_dedup", oracles.SUFFIX)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that repeat a 100-byte string which starts earlier."""
    return suffixes.find_repeats(table(spark, sf_dir, "documents"), apart=True)


def sentencepiece_model() -> str:
    """Path of the public model; a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op5_sentencepiece")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents; digests of ids and decoded texts."""
    return pieces.encode_documents(table(spark, sf_dir, "documents"), sentencepiece_model(), digest=True)


@query("op6_mix_sources")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: targets by capped water-filling, words taken per document."""
    return mixing.plan_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op7_exact_top_k", oracles.TOP_K)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best candidates of every query among all rows."""
    return balltree.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op8_chat_format", oracles.CHAT)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one made of control strings; digests read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digest(chat.format_conversations(rows.unionByName(hard)))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; labels of two thirds of the ids teach."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_quality_rules", oracles.QUALITY)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the threshold table for all documents."""
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query("op11_merkle_manifest", oracles.MERKLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents; proofs of all rows, checked against rows changed on purpose."""
    return merkle.digest(merkle.manifest(table(spark, sf_dir, "documents")))


@query("op12_line_quality")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; labels of four fifths of the ids teach."""
    return linequality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_lexical_search", oracles.LEXICAL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
