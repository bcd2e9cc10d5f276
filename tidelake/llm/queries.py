"""One query per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import (
    adaptive_rules,
    dart_dedup,
    huffman,
    interpolated_lm,
    mixing,
    packing,
    prefix_trie,
    secrets,
    token_alignment,
    vector_dedup,
    warc,
    weak_quality,
    weighted_sampling,
)
from tidelake.llm.sql import SQL  # noqa: F401  registered with the queries

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.classify(table(spark, sf_dir, "documents")).select(
        F.col("document.doc_id").alias("doc_id"), "votes", "posterior", "score", "kept")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return planned.select(
        F.col("document.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = huffman.encode_corpus(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)
    return huffman.read_ids(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score(table(spark, sf_dir, "documents"))


def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)


def op9_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.array_join("broken", ",").alias("broken"))


def op10_dart_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_dedup.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "class_size", "kept")


def op6_sign_hash_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("document.doc_id").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2("base", 256).alias("base_sha256"), "spans")


def op8_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"),
                                 vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op12_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.edited_fingerprints(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op11_token_alignment": op11_token_alignment,
    "op12_weighted_fingerprints": op12_weighted_fingerprints,
    "op13_prefix_trie": op13_prefix_trie,
    "op1_weak_quality": op1_weak_quality,
    "op6_sign_hash_vectors": op6_sign_hash_vectors,
    "op7_secret_spans": op7_secret_spans,
    "op8_warc_segments": op8_warc_segments,
    "op10_dart_near_duplicates": op10_dart_near_duplicates,
    "op9_adaptive_rules": op9_adaptive_rules,
    "op3_huffman_ids": op3_huffman_ids,
    "op4_interpolated_lm": op4_interpolated_lm,
    "op5_pattern_packing": op5_pattern_packing,
    "op2_mix_sources": op2_mix_sources,
}
