"""Phrase collocations: depth-truncated suffix subtrees, built by groups of word prefixes within a memory budget."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.sets import names_of
from cellweave.llm.text import LOWER, mix, slices
from cellweave.operators.sizing import join_small
from cellweave.session import settle

SLICE = 1 << 19
#: Suffixes of a group of prefixes, 40 bytes each, that one task builds a subtree of.
BUDGET = 1 << 20
HELD = 1 << 18
BINS = 1 << 14
BREAK = np.zeros(256, bool)
BREAK[[46, 44, 59, 58, 33, 63, 10, 11, 12, 13]] = True
GAP = BREAK.copy()
GAP[[9, 32]] = True
U = np.uint64


class Pieces:
    """Words of a slice of texts: ``names`` by language and word, and whether a word follows the last one in its piece."""

    def __init__(self, texts: pa.Array, langs: list[str], seed: int):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = LOWER[np.frombuffer(raw, np.uint8)[at[0] : at[-1]]] if raw is not None and len(at) else np.zeros(0, np.uint8)
        at = at - at[0]
        solid = ~GAP[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        before, after = np.concatenate([[False], solid]), np.concatenate([solid, [False]])
        starts, ends = np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))
        text = np.searchsorted(at, starts, side="right") - 1
        piece = np.concatenate([[0], np.cumsum(BREAK[data])])[starts]
        self.follows = np.zeros(len(starts), bool)
        self.follows[1:] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        flat = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])])
        coded = flat.dictionary_encode()
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kinds = sorted(set(langs))
        number = {x: k for k, x in enumerate(kinds)}
        lang = np.array([number[x] for x in langs], np.int64)[text]
        distinct, inverse, self.counts = np.unique(lang * max(len(coded.dictionary), 1) + word, return_inverse=True, return_counts=True)
        self.words = coded.dictionary.take(pa.array(distinct % max(len(coded.dictionary), 1)))
        self.langs = [kinds[k] for k in (distinct // max(len(coded.dictionary), 1)).tolist()]
        heads = [x.encode() + b"\0" for x in kinds]
        hash_of, of = xxhash.xxh3_64_intdigest, dict(zip(kinds, heads, strict=True))
        self.distinct = np.fromiter((hash_of(of[x] + w, seed) for x, w in zip(self.langs, self.words.cast(pa.large_binary()).to_pylist(), strict=True)), U, len(distinct))
        self.names = self.distinct[inverse]


def _pair_name(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * U(0x9E3779B97F4A7C15) + (second ^ (second >> U(29))) * U(0xE7037ED1A0B428DB))


def _merged(batches: Iterator[pa.Table], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows with equal keys added up as far as HELD rows of memory reach."""
    held: list[pa.Table] = []
    size = 0

    def added() -> pa.Table:
        return pa.concat_tables(held).group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).select([*keys, "n"])

    for table in batches:
        held.append(table)
        size += table.num_rows
        if size > HELD:
            held = [added()]
            size = held[0].num_rows
            if size > HELD // 2:
                yield from held.pop().combine_chunks().to_batches()
                size = 0
            pa.default_memory_pool().release_unused()
    if held:
        yield from added().combine_chunks().to_batches()


def subtree_counts(first: np.ndarray, second: np.ndarray, third: np.ndarray, n: np.ndarray) -> pa.Table:
    """Nodes of depth 2 and 3 of the suffix subtree with these leaves (third 0: the suffix ends), counts from leaf totals."""
    order = np.lexsort((third, second, first))
    first, second, third, n = first[order], second[order], third[order], n[order]
    if not len(n):
        return pa.table({"first": pa.array([], pa.int64()), "second": pa.array([], pa.int64()), "third": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    node2 = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
    node3 = np.append(True, node2[1:] | (third[1:] != third[:-1]))
    at2, at3 = np.flatnonzero(node2), np.flatnonzero(node3)
    total2, total3 = np.add.reduceat(n, at2), np.add.reduceat(n, at3)
    real = third[at3] != 0
    at3, total3 = at3[real], total3[real]
    rows = np.concatenate([at2, at3])
    return pa.table({"first": first[rows].view(np.int64), "second": second[rows].view(np.int64), "third": np.concatenate([np.zeros(len(at2), np.int64), third[at3].view(np.int64)]), "n": np.concatenate([total2, total3])})


class Groups:
    """Groups of prefixes: bins of first words in order, filled up to the budget; a fuller bin is dealt over several by its suffixes."""

    def __init__(self, bins: np.ndarray, totals: np.ndarray, budget: int):
        self.base, self.width = np.zeros(BINS, np.int64), np.ones(BINS, np.int64)
        group, room = 0, 0
        for b, total in sorted(zip(bins.tolist(), totals.tolist(), strict=True)):
            if total > budget:
                group += bool(room)
                self.base[b], self.width[b] = group, -(-total // budget)
                group, room = group + int(self.width[b]), 0
                continue
            if room + total > budget:
                group, room = group + 1, 0
            self.base[b] = group
            room += total
        self.count = group + 1

    def of(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
        b = (mix(first) % U(BINS)).astype(np.int64)
        return self.base[b] + (mix(_pair_name(first, second) ^ mix(third)) % self.width[b].astype(U)).astype(np.int64)


def _rows(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").alias("body"))


def word_counts(docs: DataFrame, lang: str, text: str, seed: int) -> DataFrame:
    """(lang, word, name, n): occurrences of every word by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            for part in slices(batches, "body", SLICE):
                found = Pieces(part.column("body"), part.column("lang").to_pylist(), seed)
                yield pa.table({"lang": pa.array(found.langs, pa.string()), "word": found.words.cast(pa.string()), "name": found.distinct.view(np.int64), "n": found.counts.astype(np.int64)})

        yield from _merged(tables(), ["lang", "word", "name"])

    counted = _rows(docs, lang, text).mapInArrow(run, "lang string, word string, name long, n long")
    # Tasks have added up what they hold, so rows are dealt at once.
    return counted.repartition("lang", "word", "name").groupBy("lang", "word", "name").agg(F.sum("n").alias("n"))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in exact decimals: counts have up to 15 digits."""
    a, left, right = (x.cast("decimal(15,0)") for x in (a, left, right))
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (a * a), left * right).cast("long")


def candidates(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 10, seed: int = 0, budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, name, n), and phrases of two and of three words by names, that occur ``least`` times or more.

    A first scan counts words. A second counts prefixes of two words that the first left, a
    third takes the suffixes of three words that begin with a prefix left, ended where two
    words were not; prefixes are dealt by their counts to groups of ``budget`` suffixes at
    most, and each group's subtree is built by one task on its own.
    """
    while True:
        words = settle(word_counts(docs, lang, text, seed))
        if words.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            break
        seed += 1
    sc = docs.sparkSession.sparkContext
    kept = sc.broadcast(names_of(words.where(F.col("n") >= least), "name"))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            for part in slices(batches, "body", SLICE):
                found = Pieces(part.column("body"), part.column("lang").to_pylist(), seed)
                good = kept.value.may_hold(found.names)
                at = np.flatnonzero(found.follows[1:] & good[1:] & good[:-1])
                yield pa.table({"first": found.names[at].view(np.int64), "second": found.names[at + 1].view(np.int64), "n": np.ones(len(at), np.int64)})

        yield from _merged(tables(), ["first", "second"])

    pairs = _rows(docs, lang, text).mapInArrow(prefixes, "first long, second long, n long").repartition("first", "second").groupBy("first", "second").agg(F.sum("n").alias("n"))
    pairs = settle(pairs.where(F.col("n") >= least))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (batch.column(c).to_numpy().view(U) for c in ("first", "second"))
            yield pa.RecordBatch.from_arrays([pa.array(_pair_name(first, second).view(np.int64)), pa.array((mix(first) % U(BINS)).astype(np.int64)), batch.column("n")], ["name", "bin", "n"])

    plain = pairs.mapInArrow(named, "name long, bin long, n long")
    held = sc.broadcast(names_of(plain, "name"))
    totals = plain.groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    groups = sc.broadcast(Groups(totals.column("bin").to_numpy(), totals.column("n").to_numpy(), budget))

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables() -> Iterator[pa.Table]:
            for part in slices(batches, "body", SLICE):
                found = Pieces(part.column("body"), part.column("lang").to_pylist(), seed)
                names = found.names
                begins = np.zeros(len(names) + 1, bool)
                begins[: len(names) - 1] = found.follows[1:] & held.value.may_hold(_pair_name(names[:-1], names[1:]))
                at = np.flatnonzero(begins)
                third = np.where(begins[at + 1], np.append(names, [U(0), U(0)])[at + 2], U(0))
                group = groups.value.of(names[at], names[at + 1], third)
                yield pa.table({"group": group, "first": names[at].view(np.int64), "second": names[at + 1].view(np.int64), "third": third.view(np.int64), "n": np.ones(len(at), np.int64)})

        yield from _merged(tables(), ["group", "first", "second", "third"])

    def build(table: pa.Table) -> pa.Table:
        first, second, third = (table.column(c).to_numpy().view(U) for c in ("first", "second", "third"))
        return subtree_counts(first, second, third, table.column("n").to_numpy())

    leaves = _rows(docs, lang, text).mapInArrow(suffixes, "group long, first long, second long, third long, n long")
    nodes = leaves.groupBy("group").applyInArrow(build, "first long, second long, third long, n long")
    # A fuller bin's groups hold parts of the totals of depth 2.
    nodes = settle(nodes.groupBy("first", "second", "third").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
    return words, nodes.where("third = 0").drop("third"), nodes.where("third <> 0")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 10, absorbed: int = 50, top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best ``top`` phrases of two or three words.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and those into
    words at blanks. A phrase with at least ``least`` occurrences scores
    floor(1000000 a a / (l r)) at its worst cut, the first of them on ties; it is dropped if a
    longer one that holds it occurs at least ``absorbed`` in 100 times as often. Ranks go by
    score, occurrences, then bytes of the phrase. A null lang is ``und``, a null or empty
    text has no words, repeated rows count each, and an empty table gives none. Words are
    named by 64-bit hashes that are checked to differ, else named anew.
    """
    words, pairs, triples = candidates(docs, lang, text, least, budget=budget)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    good = settle(words.where(F.col("n") >= least))
    named = {k: good.select(F.col("name").alias(k), F.col("word").alias(f"{k}_word"), F.col("n").alias(f"{k}_n"), F.col("lang").alias(f"{k}_lang")) for k in ("first", "second", "third")}
    longer = triples.select(F.explode(F.array(F.struct("first", "second"), F.struct(F.col("second").alias("first"), F.col("third").alias("second")))).alias("_"), "n")
    longer = longer.groupBy(F.col("_.first").alias("first"), F.col("_.second").alias("second")).agg(F.max("n").alias("longest"))
    two = pairs.join(longer, ["first", "second"], "left").where(F.coalesce(100 * F.col("longest") < absorbed * F.col("n"), F.lit(True))).drop("longest")
    two = join_small(join_small(two, named["first"], "first", settled=True), named["second"], "second", settled=True)
    two = two.select(F.col("first_lang").alias("lang"), F.concat_ws(" ", "first_word", "second_word").alias("phrase"), F.col("n").alias("a"), F.col("first_n").alias("l"), F.col("second_n").alias("r"), _score(F.col("n"), F.col("first_n"), F.col("second_n")).alias("score"))
    head = pairs.select("first", "second", F.col("n").alias("head_n"))
    tail = pairs.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("n").alias("tail_n"))
    three = triples.join(head, ["first", "second"]).join(tail, ["second", "third"])
    for k in ("first", "second", "third"):
        three = join_small(three, named[k], k, settled=True)
    one = _score(F.col("n"), F.col("first_n"), F.col("tail_n"))
    other = _score(F.col("n"), F.col("head_n"), F.col("third_n"))
    cut = F.when(other < one, F.struct(F.col("head_n").alias("l"), F.col("third_n").alias("r"), other.alias("score"))).otherwise(F.struct(F.col("first_n").alias("l"), F.col("tail_n").alias("r"), one.alias("score")))
    three = three.select(F.col("first_lang").alias("lang"), F.concat_ws(" ", "first_word", "second_word", "third_word").alias("phrase"), F.col("n").alias("a"), cut.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return join_small(best, totals, "lang", settled=True).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
