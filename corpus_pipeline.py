"""The corpus pipeline: stages applied one after another to the documents table.

Each stage takes (spark, docs, sf_dir), works on all rows of the stage before
and returns their columns; the last one returns the encoded documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aqarlens.llm import bpe, digest_runs, jaccard, mixing, toxicity
from aqarlens.llm.common import stage

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half for toxicity; labels come from the labels table."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts, the one with the smallest doc_id."""
    return digest_runs.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that n-gram similarity links, directly or through others, the one with the smallest doc_id."""
    return jaccard.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at temperature weights: every document once at least, no source passed over more than twice."""
    return mixing.repeat_rows(docs, mixing.mix_sources(docs, max_repeats=2.0, keep_all=True))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row."""
    return bpe.token_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mix_sources", mix),
    ("bpe", encode),
]

#: Learned scores and bisection have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are a stage table for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
