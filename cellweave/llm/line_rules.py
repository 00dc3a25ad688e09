"""Quality rules: figures of each text and lines that many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.text import slices, words
from cellweave.session import settle

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each distinct (left, right)."""
    return np.unique(left.astype(np.int64) * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def repeated_words(coded: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each text in windows of 8 that occur twice or more in it; exact, by doubling ranks."""
    total, rows = len(coded), len(offsets) - 1
    count = total - WINDOW + 1
    if count <= 0:
        return np.zeros(rows, np.int64)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    rank = coded
    for step in (1, 2, 4):
        rank = _ranks(rank[:-step], rank[step:])
    inside = np.flatnonzero(row[:count] == row[WINDOW - 1 :])
    if not len(inside):
        return np.zeros(rows, np.int64)
    same, times = np.unique(_ranks(rank[inside], row[inside]), return_inverse=True, return_counts=True)[1:]
    starts = inside[times[same] > 1]
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return _sums(np.cumsum(change[:-1]) > 0, offsets)


def _figures(texts: pa.Array) -> tuple[list[pa.Array], pa.Array]:
    """The base figures of a slice, and the lines of each text that have a word, as (hash, n_words)."""
    texts = pc.fill_null(texts, "")
    offsets, flat = words(texts)
    coded = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    chars = _sums(pc.utf8_length(flat).to_numpy(zero_copy_only=False), offsets)
    parts = pc.split_pattern(texts, "\n")
    lines, row = parts.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    at, inner = words(lines, lower=True)
    n = np.diff(at)
    full = np.flatnonzero(n)
    line = lines.take(pa.array(full)).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    kinds = np.unique(row[full] * (int(line.max(initial=0)) + 1) + line) // (int(line.max(initial=0)) + 1)
    dups = np.bincount(row[full], minlength=len(texts)) - np.bincount(kinds, minlength=len(texts))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at), inner), " ").take(pa.array(full))
    hash_of = xxhash.xxh64_intdigest
    hashes = np.fromiter((hash_of(x) for x in joined.cast(pa.large_binary()).to_pylist()), np.uint64, len(full)).view(np.int64)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[full], minlength=len(texts)))])
    items = pa.StructArray.from_arrays([pa.array(hashes), pa.array(n[full].astype(np.int32)), pa.array(_positions(row)[full].astype(np.int32))], ["hash", "n", "line"])
    return [
        pa.array(np.diff(offsets)), pa.array(chars), pc.count_substring_regex(texts, pattern=SYMBOLS).cast(pa.int64()), pa.array(dups.astype(np.int64)), pa.array(repeated_words(coded, offsets)),
    ], pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items)


def _positions(row: np.ndarray) -> np.ndarray:
    """Index of each line in its text, lines being in order."""
    first = np.concatenate([[0], np.cumsum(np.bincount(row))])
    return np.arange(len(row)) - first[row]


def figures(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """_id, _host, a hash of the text, the base figures and _lines: (hash, n, line) of each line with a word.

    A line's hash ignores case of A-Z and the width of blanks.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{host}`").cast("string").alias("_host"), F.xxhash64(F.col(f"`{text}`")).alias("_print"), F.col(f"`{text}`").cast("string").alias("_text"))
    schema = rows.drop("_text").schema.simpleString()[7:-1].replace(":", " ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            made, lines = _figures(part.column("_text"))
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *made, lines], ["_id", "_host", "_print", *(x.split()[0] for x in FIGURES.split(", ")), "_lines"])

    return rows.mapInArrow(run, f"{schema}, {FIGURES}, _lines array<struct<hash: long, n: int, line: int>>")


def assess(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source", share: float = 0.02, least: int = 20, depleted: float = 0.7) -> DataFrame:
    """id, base figures, base_failed, removed_words, removed_lines and kept of every row.

    A line is removed from the documents of a host if more than ``least`` of the host's
    different texts and more than ``share`` of them hold it; copies of one text count once,
    so they don't make their own lines frequent. A document is rejected if base_failed
    (fewer than 20 words, or over 30 % of them in repeated windows), or if its removed
    lines hold over ``depleted`` of its words. A null text has no words; a null host is a
    host of its own; repeated rows each have a row; an empty table gives none.
    """
    rows = settle(figures(docs, id_col, text, host).withColumn("_row", F.monotonically_increasing_id()))
    lines = rows.select("_row", "_host", "_print", F.explode("_lines").alias("_")).select("_row", "_host", "_print", F.col("_.hash").alias("hash"), F.col("_.n").alias("n"), F.col("_.line").alias("line"))
    held = lines.select("_host", "hash", "_print").distinct().groupBy("_host", "hash").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > least)
    sizes = rows.select("_host", "_print").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("texts"))
    frequent = held.alias("h").join(sizes.alias("s"), F.expr("h._host <=> s._host")).where(F.col("held") > share * F.col("texts")).select("h._host", "hash")
    hits = lines.alias("l").join(frequent.alias("f"), F.expr("l._host <=> f._host AND l.hash = f.hash"), "left_semi")
    removed = hits.groupBy("_row").agg(F.sum("n").alias("removed_words"), F.sort_array(F.collect_list("line")).alias("removed_lines"))
    joined = rows.drop("_lines").join(removed, "_row", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    spent = F.col("removed_words") > depleted * F.col("n_words")
    names = [x.split()[0] for x in FIGURES.split(", ")]
    return joined.select(F.col("_id").alias(id_col), *names, failed.alias("base_failed"), "removed_words", F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"), (~failed & ~spent).alias("kept"))


def without_lines(text: str, removed: str) -> Column:
    """The text column without the lines numbered in ``removed``."""
    kept = F.filter(F.split(F.col(text), "\n"), lambda _, i: ~F.array_contains(F.col(removed), i))
    return F.array_join(kept, "\n")
