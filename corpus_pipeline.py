"""Corpus pipeline: from raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows the stage before it kept and
returns a frame; all but the last return the columns of ``docs``.  A stage's result is
written and read again before the next one starts.

Null, empty and blank texts fail the quality rules and go in the first stage; long texts
are read whole in all of them; of repeated rows one stays (second stage); an empty table
stays empty; further columns are carried along under their own names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import bpe, decontaminate, quality_rules, simhash, suffix_dedup
from tidepool.llm.common import release, stage, staging, table


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the standard policy."""
    return quality_rules.keep_passing(docs, "standard-1")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints (3-word shingles) link within 3 bits."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that also start elsewhere; n_chars follows the text."""
    cut = suffix_dedup.dedup(docs, length=200)
    return cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType)) if "n_chars" in cut.columns else cut


def drop_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that matches a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian uint32) of each document, with digests of them and of their decoding."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    both = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return both.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_strings),
    ("benchmark_decontamination", drop_benchmark_documents),
    ("byte_bpe", encode_and_decode),
]

# Near duplicates and the stages after them are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = table(spark, sf_dir, "documents"), []
    for name, step in STAGES[:-1]:
        with staging() as made:
            docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, read + made[:-1])      # the rows the stage read, and what it had written itself
        read = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
