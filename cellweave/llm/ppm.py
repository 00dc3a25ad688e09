"""Code lengths of texts by prediction by partial matching over bytes, and by a word baseline."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.text import Tokens, mix, slices
from cellweave.session import settle

CHUNK_BYTES = 24 << 20
ORDER = 5
HELD = 2_000_000
PENDING = 1_000_000
SLICE = 1 << 20
BITS = 9
END = 257
END_WORD = -7046029254386353131


def grams(tokens: Tokens, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbol and its ``order`` predecessors at every byte and at the end of each text.

    Symbols take 9 bits: 0 before the text, 1 to 256 a byte, 257 the end. Also the offsets.
    """
    sizes = np.diff(tokens.texts)
    offsets = tokens.texts + np.arange(len(tokens.texts))
    # Each text has ``order`` zeros before it, so no gram reaches into the one before.
    place = np.arange(len(tokens.data)) + np.repeat(np.arange(len(sizes)) + order * np.arange(1, len(sizes) + 1), sizes)
    padded = np.zeros(offsets[-1] + order * len(sizes), np.int16)
    padded[place] = tokens.data
    padded[place] += 1
    ends = offsets[1:] - 1 + order * np.arange(1, len(sizes) + 1)
    padded[ends] = END
    out = padded.astype(np.int64)
    for k in range(1, order + 1):
        out[k:] |= padded[:-k].astype(np.int64) << (BITS * k)
    inside = np.zeros(len(padded), bool)
    inside[place] = True
    inside[ends] = True
    return out[inside], offsets


def _tail(gram: str, length: int) -> Column:
    """The last ``length`` symbols of a gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << (BITS * length)) - 1))


def model(counted: DataFrame, order: int) -> DataFrame:
    """(gram, cost), cost being the log10 probability of the last symbol of every gram after the others.

    ``counted`` has the training count of every gram that is to be scored, 0 included. The
    trie's nodes are the suffixes of the grams; a node's symbols with n of t occurrences
    and d kinds have (n - 1/2) / t, an unseen one escapes with d / 2t to the next shorter
    context, where symbols already seen in the longer one are excluded. After the empty
    context the symbols that were never seen share what is left alike.
    """
    nodes = {order + 1: counted.where("n > 0").withColumnRenamed("gram", "g")}
    for size in range(order, 0, -1):
        nodes[size] = settle(nodes[size + 1].groupBy(_tail("g", size).alias("g")).agg(F.sum("n").alias("n")))

    def contexts(size: int) -> DataFrame:
        """Of each context of grams of this size: t occurrences, d kinds, and the occurrences x of its kinds in the shorter context."""
        inside = nodes[size].withColumn("c", F.shiftright("g", BITS))
        if size == 1:
            return inside.groupBy("c").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("d"), F.lit(0).cast("long").alias("x"))
        below = nodes[size - 1].select(F.col("g").alias("short"), F.col("n").alias("below"))
        joined = inside.withColumn("short", _tail("g", size - 1)).join(below, "short")
        return joined.groupBy("c").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("d"), F.sum("below").alias("x"))

    top = settle(contexts(order + 1))
    seen = nodes[order + 1].withColumn("c", F.shiftright("g", BITS)).join(top, "c")
    out = seen.select(F.col("g").alias("gram"), F.log10((F.col("n") - 0.5) / F.col("t")).alias("cost"))
    # Grams that training lacks walk down the trie; esc is what the escapes have cost so far. What has
    # its cost leaves the walk. Short contexts and nodes number 258 or 258 squared, so they are broadcast.
    state = counted.where("n = 0").select("gram", F.lit(0.0).alias("esc"), F.lit(0).cast("long").alias("out_d"), F.lit(0).cast("long").alias("out_x"))
    for size in range(order + 1, 0, -1):
        own = nodes[size].select(F.col("g").alias("_g"), F.col("n").alias("_n"))
        around = (top if size == order + 1 else contexts(size)).select(F.col("c").alias("_c"), "t", "d", "x")
        own = F.broadcast(own) if size <= 2 else own
        around = F.broadcast(around) if size <= 3 else around
        keyed = state.withColumn("_g", _tail("gram", size)).withColumn("_c", F.shiftright("_g", BITS))
        met = keyed.join(own, "_g", "left").join(around, "_c", "left")
        known = F.col("d").isNotNull()
        total, kinds = F.col("t") - F.col("out_x"), F.col("d") - F.col("out_d")
        met = settle(met.select(
            "gram",
            F.when(F.col("_n").isNull() & known & (kinds > 0), F.col("esc") + F.log10(kinds / (2 * total))).otherwise(F.col("esc")).alias("esc"),
            F.when(F.col("_n").isNotNull(), F.col("esc") + F.log10((F.col("_n") - 0.5) / total)).alias("cost"),
            F.coalesce("d", F.lit(0).cast("long")).alias("out_d"),
            F.coalesce("x", F.lit(0).cast("long")).alias("out_x"),
        ))
        out = out.unionByName(met.where("cost IS NOT NULL").select("gram", "cost"))
        state = met.where("cost IS NULL").drop("cost")
    rest = F.greatest(F.lit(END) - F.col("out_d"), F.lit(1))
    return out.unionByName(state.select("gram", (F.col("esc") - F.log10(rest)).alias("cost")))


def _distinct(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sum of n."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _once(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs; a plain sort is several times as fast as an argsort."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(first, append=len(keys))


def _kinds(keys: list[np.ndarray]) -> np.ndarray:
    """Distinct keys in order."""
    flat = np.concatenate([np.zeros(0, np.int64), *keys])
    flat.sort()
    new = np.ones(len(flat), bool)
    np.not_equal(flat[1:], flat[:-1], out=new[1:])
    return flat[new]


class Costs:
    """The costs of distinct keys, found by buckets of mixed keys instead of a binary search."""

    def __init__(self, keys: np.ndarray, cost: np.ndarray):
        self.shift = np.uint64(64 - max(1, min(len(keys).bit_length(), 31)))
        bucket = self._bucket(keys)
        order = np.argsort(bucket)
        self.keys, self.cost = keys[order], cost[order]
        held = np.bincount(bucket, minlength=1 << (64 - int(self.shift)))
        self.start = (np.cumsum(held) - held).astype(np.int32)

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64)) >> self.shift).view(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Costs of keys that all have one, as double."""
        at = self.start[self._bucket(keys)]
        left = np.flatnonzero(self.keys[at] != keys)
        while len(left):
            at[left] += 1
            left = left[self.keys[at[left]] != keys[left]]
        return self.cost[at].astype(np.float64)


def _keys(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the words of each text, their offsets, the grams of each text and their offsets.

    Words are negative, grams are not; every text has END_WORD as its last word.
    """
    tokens = Tokens(texts, lower=True)
    place = np.arange(len(tokens)) + np.repeat(np.arange(len(texts)), np.diff(tokens.offsets))
    offsets = tokens.offsets + np.arange(len(texts) + 1)
    words = np.full(offsets[-1], END_WORD)
    words[place] = tokens.hashes().view(np.int64) | np.int64(-(2**63))
    return words, offsets, *grams(Tokens(texts), order)


def distinct_keys(batches: Iterable[pa.RecordBatch], order: int, pending: int = PENDING) -> np.ndarray:
    """Distinct keys of all texts, in order; beside them, those of few slices wait to be merged."""
    keys, held = np.zeros(0, np.int64), []
    for part in slices(batches, "_text", SLICE):
        words, _, found, _ = _keys(part.column("_text"), order)
        held.append(_kinds([words, found]))
        if sum(map(len, held)) > pending:
            keys, held = _kinds([keys, *held]), []
    return _kinds([keys, *held])


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values of each text; every text has some."""
    return np.add.reduceat(values, offsets[:-1])


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text: str = "text", order: int = ORDER, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Counts are learnt from all rows that aren't ``held_out`` (null: not), and all rows are
    scored. Each task counts the grams and words of its texts, Spark adds the counts up
    and makes the trie's costs with joins by node. Costs go to chunks of texts that ask
    for their keys once, so neither trie nor vocabulary is ever in one place. A null text
    is empty and has its end only; repeated rows count as often as they occur; without
    training rows all symbols, and all tokens, cost the same; an empty table gives none.
    """
    if not 1 <= order <= 5:
        raise ValueError("order must be 1 to 5")
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    rows = docs.select(F.pmod(F.xxhash64(F.col(f"`{id_col}`"), body), F.lit(chunks)).alias("chunk"), F.col(f"`{id_col}`").alias("_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), body.alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _distinct(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))

        for part in slices(batches, "_text", SLICE):
            train = ~part.column("held_out").to_numpy(zero_copy_only=False)
            words, at, found, to = _keys(part.column("_text"), order)
            keys, trained = np.concatenate([words, found]), np.concatenate([np.repeat(train, np.diff(at)), np.repeat(train, np.diff(to))])
            learnt, n = _once(keys[trained])
            others = _once(keys[~trained])[0]
            held.append((np.concatenate([learnt, others]), np.concatenate([n, np.zeros(len(others), np.int64)])))
            if sum(len(k) for k, _ in held) > HELD:
                held = [merged()]
            if len(held[0][0]) > HELD // 2:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop(0)], ["key", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], ["key", "n"])

    counted = settle(rows.select("held_out", "_text").mapInArrow(count, "key long, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n")))
    n_train, kinds = counted.where("key < 0 AND n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    costs = model(counted.where("key >= 0").withColumnRenamed("key", "gram"), order).withColumnRenamed("gram", "key")
    costs = settle(costs.unionByName(counted.where("key < 0").select("key", F.col("n").alias("cost"))).withColumn("cost", F.col("cost").cast("float")))
    schema = rows.select(F.col("_id"), "held_out").withColumns({"n_tokens": F.lit(0).cast("long"), "n_known": F.lit(0).cast("long"), "base": F.lit(0.0), "score": F.lit(0.0)}).schema

    def ask(table: pa.Table) -> pa.Table:
        keys = distinct_keys(table.to_batches(), order)
        return pa.table({"chunk": np.full(len(keys), table.column("chunk")[0].as_py()), "key": keys})

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        costs, out = Costs(right.column("key").to_numpy(), right.column("cost").to_numpy()), []
        for part in slices(left.to_batches(), "_text", SLICE):
            words, ends, found, to = _keys(part.column("_text"), order)
            each = np.log10(costs.of(words) + 1)
            value = _sums(costs.of(found), to)
            out.append(pa.RecordBatch.from_arrays([part.column("_id"), part.column("held_out"), pa.array(np.diff(ends)), pa.array(_sums(each > 0, ends).astype(np.int64)), pa.array(_sums(each, ends)), pa.array(value)], schema.names))
        return pa.Table.from_batches(out)

    asked = rows.groupBy("chunk").applyInArrow(ask, "chunk long, key long")
    sent = asked.join(costs, "key").select("chunk", "key", "cost")
    done = rows.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(add_up, schema)
    spread = F.log10(F.lit(float(n_train + kinds + 1)))
    return done.select(F.col("_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * spread).alias("base_score"), "score")
