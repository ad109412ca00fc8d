"""The queries of this subpackage: thin wrappers that apply each operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import bpe, kdtree, licenses, mixing, phrase_dedup, quality, simhash, sql, suffix_dedup, token_scan, toxicity

from kinfold.llm.common import text_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return text_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.token_counts(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "shards")


def op6_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op7_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_token_counts": op2_token_counts,
        "op3_toxicity": op3_toxicity,
        "op4_quality": op4_quality,
        "op5_mixing": op5_mixing,
        "op6_phrase_dedup": op6_phrase_dedup,
        "op7_kdtree": op7_kdtree,
        "op8_simhash": op8_simhash,
        "op9_bpe": op9_bpe,
        "op10_licenses": op10_licenses,
    }


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
