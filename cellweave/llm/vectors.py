"""Near-duplicate vectors by random-hyperplane signs in several tables and exact cosines."""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.llm.graph import components
from cellweave.llm.text import boundaries, union, whole_groups
from cellweave.session import settle

CELL = 2048
STEP = 512


def _classes(docs: DataFrame, id_col: str, vector: str) -> DataFrame:
    """Rows as (_id, key, raw): raw is the vector's float64 bytes; null where it can't be compared."""
    item = F.col(f"`{vector}`")
    kept = F.transform(item, lambda x: x.cast("double"))
    bad = F.exists(kept, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = item.isNotNull() & (F.size(item) > 0) & ~bad & F.exists(kept, lambda x: x != 0)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.when(whole, kept).alias("_v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("_v")
            lengths = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(col), 0))
            ends = np.cumsum(lengths)
            flat = col.flatten().to_numpy(zero_copy_only=False) + 0.0
            raw = [flat[e - n : e].tobytes() if n else None for n, e in zip(lengths, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(raw, pa.binary())], ["_id", "raw"])

    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), T.StructField("raw", T.BinaryType())])
    return rows.mapInArrow(run, schema).withColumn("key", F.md5("raw"))


def _tables(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a key and number of tables so that a pair at the threshold meets with ``recall``."""
    bits = max(8, ceil(log2(n / 16 + 1)))
    meet = (1 - acos(threshold) / pi) ** bits
    return bits, max(1, ceil(log(1 - recall) / log(1 - meet)))


def near_vectors(docs: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, recall: float = 0.995, seed: int = 5) -> DataFrame:
    """id, n_links, component_id and kept of every row.

    Rows whose vector is null, empty, zero or holds null, NaN or infinity link with
    nothing and are their own component. Equal vectors are one class with a count, so a
    group of copies is never paired; vectors of different length don't link. Classes that
    share a sign key in some table are compared by cosine in double precision, in blocks;
    a pair counts in the first table where it meets. A key held by more than CELL classes
    is dealt over pairs of shares. A null id has a row of its own; kept is id = component_id.
    """
    rows = settle(_classes(docs, id_col, vector))
    classes = settle(rows.where("raw IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("_id").alias("least"), F.first("raw").alias("raw")))
    bits, tables = _tables(classes.count(), threshold, recall)

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            raw, out = batch.column("raw").to_pylist(), [None] * batch.num_rows
            by_size: dict[int, list[int]] = {}
            for i, r in enumerate(raw):
                by_size.setdefault(len(r) // 8, []).append(i)
            for size, at in by_size.items():
                if size not in planes:
                    planes[size] = np.random.default_rng([seed, size]).standard_normal((size, bits * tables))
                x = np.frombuffer(b"".join(raw[i] for i in at)).reshape(len(at), size)
                side = (x @ planes[size] > 0).reshape(len(at), tables, bits)
                key = (side * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)
                for i, k in zip(at, key, strict=True):
                    out[i] = k.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], [*batch.schema.names, "codes"])

    coded = classes.select("key", "copies", "raw").mapInArrow(signs, "key string, copies long, raw binary, codes array<long>")
    keyed = settle(coded).select(F.octet_length("raw").alias("size"), F.posexplode("codes").alias("t", "k"), "key", "copies", "raw", "codes")
    on = ["size", "t", "k"]
    counts = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cells = [*on, "i", "j"]
    dealt = (
        keyed.join(counts, on)
        .withColumn("shares", F.ceil(F.col("n") / CELL))
        .withColumn("own", F.pmod(F.xxhash64("key"), F.col("shares")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
        .select(*on, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "copies", "raw", "codes")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in whole_groups(batches, cells, rows=4096):
            keys, roots, counted = [], [], []
            cuts = [*boundaries(whole, cells).tolist(), whole.num_rows]
            copies, own = whole.column("copies").to_numpy(), whole.column("own").to_numpy()
            codes = whole.column("codes").combine_chunks().flatten().to_numpy().reshape(-1, tables)
            raw, name = whole.column("raw").to_pylist(), whole.column("key").to_pylist()
            table, cross = whole.column("t").to_numpy(), (whole.column("i").to_numpy() != whole.column("j").to_numpy())
            for a, b in zip(cuts, cuts[1:], strict=False):
                x = np.frombuffer(b"".join(raw[a:b])).reshape(b - a, -1)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                parent, links = np.arange(b - a), np.zeros(b - a, np.int64)
                for low in range(0, b - a, STEP):
                    i, j = np.nonzero(np.triu(x[low : low + STEP] @ x[low:].T >= threshold, 1))
                    i, j = i + low, j + low
                    fresh = ~(codes[a + i, : table[a]] == codes[a + j, : table[a]]).any(axis=1)
                    if cross[a]:
                        fresh &= own[a + i] != own[a + j]
                    i, j = i[fresh], j[fresh]
                    np.add.at(links, i, copies[a + j])
                    np.add.at(links, j, copies[a + i])
                    union(parent, i, j)
                at = np.flatnonzero(links)
                keys += [name[a + k] for k in at]
                roots += [name[a + k] for k in parent[at]]
                counted += links[at].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(roots, pa.string()), pa.array(counted, pa.int64())], ["a", "b", "n"])

    found = settle(dealt.repartition(*cells).sortWithinPartitions(*cells).mapInArrow(compare, "a string, b string, n long"))
    linked = found.groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    roots = components(found).withColumnRenamed("node", "key")
    placed = classes.drop("raw").join(roots, "key", "left").join(linked, "key", "left").withColumn("root", F.coalesce("root", "key"))
    heads = placed.groupBy("root").agg(F.min("least").alias("head"))
    of_class = placed.join(heads, "root").select("key", "head", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"))
    joined = rows.drop("raw").join(of_class, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("_id")).otherwise(F.col("head"))
    return joined.select(F.col("_id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("_id").eqNullSafe(own).alias("kept"))
