"""The corpus pipeline: documents to packed token sequences, one operator a stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import kneser_ney, line_chunks, packing, recompression, simhash
from cellweave.llm.workers import on_workers
from cellweave.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the limit of their language; the others go."""
    return kneser_ney.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that came before elsewhere; n_chars follows the text."""
    return _measured(line_chunks.remove_repeated(docs), docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows of 35 words; n_chars follows the text."""
    done = recompression.remove_repeats(docs, keep=docs.columns, layout=True)
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    return _measured(done.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 1024 tokens, with their ids."""
    path = public_tokenizers.path
    return packing.pack(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


def _measured(found: DataFrame, docs: DataFrame) -> DataFrame:
    """n_chars made anew where the text is another one."""
    if "n_chars" not in docs.columns:
        return found
    return found.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType)))


STAGES = [
    ("quality_classifier", on_workers(quality_classifier)),
    ("line_dedup", on_workers(line_dedup)),
    ("simhash_near_dedup", on_workers(simhash_near_dedup)),
    ("substring_dedup", on_workers(substring_dedup)),
    ("packing", on_workers(pack)),
]

#: Perplexities, fingerprints and token ids can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
