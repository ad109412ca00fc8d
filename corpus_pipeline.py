"""Documents made ready for training in five stages, each over all that its predecessor kept.

1. toxicity: documents that the factorization machine rejects go; labels are read from the labels table.
2. near_duplicates: one document of each group of near copies (five-word shingles, Jaccard similarity 0.8 or more) stays.
3. repeated_passages: words of passages that stand earlier in the corpus go, each with the white space behind it; all
   other text stays as it is.
4. mixing: documents as often as their source's target asks, shard by shard, in random order within a shard.
5. encoding: byte-level BPE ids and their decoding; (mix_file, mix_row) give the order of the mix.

All stages but the last return the columns of documents.  A stage's cases (nulls, ties, repeated rows, empty tables) are
those of its operator in kinfold.llm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import bpe, mixing, near_copies, phrase_dedup, toxicity
from kinfold.llm.common import new_shared_folder, remove_folder, text_batches, write_stage

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return near_copies.keep_one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return phrase_dedup.strip_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids, decoded_sha256, mix_file, mix_row), one for each time a document was taken.

    docs is read from the files of the stage before, whose names and rows are in the order of the mix.
    """
    text_batches(spark)
    named = docs.select(F.struct("doc_id", F.col("_metadata.file_name").alias("mix_file"), F.col("_metadata.row_index").alias("mix_row")).alias("doc_id"), "text")
    found = bpe.encode(named, public_tokenizers.path(TOKENIZER))
    return found.select("doc_id.doc_id", "n_tokens", "ids", F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"), "doc_id.mix_file", "doc_id.mix_row")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL can't express the fitted machine or the automata; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result but the last is a Parquet table in the shared folder while the next reads it."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), new_shared_folder(spark)
    for k, (name, stage) in enumerate(STAGES[:-1]):
        docs = write_stage(stage(spark, docs, sf_dir), f"{folder}/{k}_{name}")
        if k:
            remove_folder(spark, f"{folder}/{k - 1}_{STAGES[k - 1][0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
