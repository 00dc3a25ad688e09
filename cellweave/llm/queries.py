"""Registered queries of the operators for training data."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import alignment, bpe, chat, collocations, kneser_ney, line_chunks, line_rules, packing, ppm, recompression, simhash, toxicity, vectors
from cellweave.llm.workers import on_workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = on_workers(fn)
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@register
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents by SimHash of 4-word shingles, radius 4."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_of("fingerprint").alias("fingerprint"), "component_id")


BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BPE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@register
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded by byte-level BPE, as digests."""
    return bpe.digests(table(spark, folder, "documents"), BPE_RANKS, public_tokenizers.PATTERN)


@register
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens, one row per piece."""
    return packing.pack(table(spark, folder, "documents"), BPE_TOKENIZER, BPE_RANKS, public_tokenizers.PATTERN)


@register
def op6_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings linked at cosine 0.95 or more, with components."""
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@register
def op8_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Quality figures of all documents and the verdict of the line frequency rule."""
    return line_rules.assess(table(spark, folder, "documents"))


@register
def op9_recompression(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the words of repeated windows of 35 words, as digests."""
    done = recompression.remove_repeats(table(spark, folder, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register
def op10_ppm(spark: SparkSession, folder: str) -> DataFrame:
    """Code lengths of all documents by matching contexts and by a word baseline."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return ppm.score(table(spark, folder, "documents"), held_out)


@register
def op2_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity of all documents, the threshold of their language and the verdict."""
    return kneser_ney.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels that aren't held out."""
    docs = table(spark, folder, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    labels = table(spark, folder, "labels").where(remainder != 1)
    scored = toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"])
    return scored.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded by two tokenizers: groups that both share, and links by corpus-wide counts."""
    return alignment.align(table(spark, folder, "documents"), BPE_RANKS, public_tokenizers.PATTERN, PIECES)


@register
def op12_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one that spells control strings out, as budgeted windows: digests read back from them."""
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, folder, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.windows(rows.unionByName(planted), BPE_RANKS, public_tokenizers.PATTERN))


@register
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of two and three words of every language, over all documents."""
    return collocations.collocations(table(spark, folder, "documents"))


@register
def op7_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without repeated chunks of lines: what is left of each, as length and digest."""
    left = line_chunks.remove_repeated(table(spark, folder, "documents").select("doc_id", "text"))
    return left.select("doc_id", F.octet_length("text").cast("long").alias("kept_bytes"), F.md5("text").alias("kept_md5"))


@register
def op7_line_passages(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without repeated passages of two lines or more: what is left, as length and digest."""
    left = line_chunks.remove_passages(table(spark, folder, "documents").select("doc_id", "text"))
    return left.select("doc_id", F.octet_length("text").cast("long").alias("kept_bytes"), F.md5("text").alias("kept_md5"))


ORACLES["op7_line_chunks"] = """
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i,
         len(string_split(text, chr(10))) AS n
  FROM documents WHERE text IS NOT NULL),
rolled AS (
  SELECT *, CASE WHEN i = n OR substr(md5(coalesce(md5(lag(line) OVER w), '') || md5(line)), 1, 2) < '40' THEN 1 ELSE 0 END AS cut
  FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
placed AS (
  SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k
  FROM rolled),
chunk AS (
  SELECT doc_id, k, string_agg(line, chr(10) ORDER BY i) AS part,
         count(*) FILTER (WHERE trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '') > 1 AS multi
  FROM placed GROUP BY doc_id, k),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY multi, part ORDER BY doc_id, k) AS occurrence FROM chunk),
kept AS (
  SELECT doc_id, string_agg(part, chr(10) ORDER BY k) AS text FROM ranked WHERE NOT multi OR occurrence = 1 GROUP BY doc_id)
SELECT d.doc_id,
       CASE WHEN d.text IS NULL THEN NULL ELSE strlen(coalesce(kept.text, '')) END::BIGINT AS kept_bytes,
       CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(kept.text, '')) END AS kept_md5
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
