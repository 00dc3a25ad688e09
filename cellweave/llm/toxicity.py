"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.text import Tokens, slices
from cellweave.session import settle

BUCKETS = 1 << 18
PREFIX = 4
WIDTHS = (1, 2, 3)
TAIL = max(WIDTHS) - 1
#: The classifier learns from at most so many labelled rows of each kind.
MAX_TOXIC, MAX_CLEAN = 2000, 4000
MAX_BYTES = 200_000
EDGE = np.isin(np.arange(256), np.frombuffer(b".,;:!?\"'()", np.uint8))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two buckets per word, of the whole word and of its first bytes, and the offsets.

    Words are lower-cased and lose one mark at their end. Each text has TAIL empty places
    (bucket 0) behind its words, and one more if it has none, so windows never mix texts.
    """
    tokens = Tokens(texts, lower=True)
    long = np.flatnonzero(tokens.ends - tokens.starts > 1)
    tokens.ends[long] -= EDGE[tokens.data[tokens.ends[long] - 1]]
    whole = tokens.hashes(0)
    tokens.ends = np.minimum(tokens.ends, tokens.starts + PREFIX)
    prefix = tokens.hashes(1)
    counts = np.diff(tokens.offsets)
    room = np.maximum(counts, 1) + TAIL
    offsets = np.concatenate([[0], np.cumsum(room)])
    at = np.arange(len(tokens)) + np.repeat(offsets[:-1] - tokens.offsets[:-1], counts)
    out = np.zeros((offsets[-1], 2), np.int32)
    for k, h in enumerate((whole, prefix)):
        out[at, k] = 1 + (h % np.uint64(BUCKETS - 1)).astype(np.int32)
    return out, offsets


@dataclass
class Net:
    """Embeddings, filters by width, and the output layer over pooled features."""

    table: np.ndarray
    filters: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float

    @classmethod
    def fresh(cls, size: int = 8, filters: int = 8, seed: int = 1) -> Net:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.1, (BUCKETS, size)).astype(np.float32)
        table[0] = 0
        kernels = [rng.normal(0, 0.4 / w**0.5, (w, size, filters)).astype(np.float32) for w in WIDTHS]
        return cls(table, kernels, [np.full(filters, -0.1, np.float32) for _ in WIDTHS], rng.normal(0, 0.3, filters * len(WIDTHS)).astype(np.float32), -1.0)

    def _maps(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Each width's filter values at every place; places too near the end see zeros."""
        for kernel, shift in zip(self.filters, self.shifts, strict=True):
            z = x @ kernel[0]
            for j in range(1, len(kernel)):
                z[:-j] += x[j:] @ kernel[j]
            z += shift
            yield z

    def forward(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Pooled features of each text."""
        x = self.table[ids[:, 0]] + self.table[ids[:, 1]]
        return np.concatenate([np.maximum(np.maximum.reduceat(z, offsets[:-1], axis=0), 0) for z in self._maps(x)], axis=1)

    def scores(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(ids, offsets) @ self.out + self.bias, -30, 30)))

    def step(self, ids: np.ndarray, offsets: np.ndarray, label: np.ndarray, weight: np.ndarray, rate: float, memory: dict) -> float:
        """One Adagrad step on a batch; only the places that won the pooling get a gradient."""
        x = self.table[ids[:, 0]] + self.table[ids[:, 1]]
        pooled, winners = [], []
        for z in self._maps(x):
            top = np.stack([z[a:b].argmax(axis=0) + a for a, b in zip(offsets, offsets[1:], strict=False)])
            pooled.append(np.maximum(np.take_along_axis(z, top, axis=0), 0))
            winners.append(top)
        p = 1 / (1 + np.exp(-np.clip(np.concatenate(pooled, axis=1) @ self.out + self.bias, -30, 30)))
        err = ((p - label) * weight / len(label)).astype(np.float32)

        def update(name: str, value: np.ndarray, grad: np.ndarray) -> None:
            state = memory.setdefault(name, np.full_like(value, 1e-6))
            state += grad * grad
            value -= rate * grad / np.sqrt(state)

        rows, grads = [], []
        slot = 0
        out_grad = np.concatenate(pooled, axis=1).T @ err + 1e-5 * self.out
        for w, (kernel, shift, top, m) in enumerate(zip(self.filters, self.shifts, winners, pooled, strict=True)):
            n = kernel.shape[2]
            d = err[:, None] * self.out[slot : slot + n] * (m > 0)
            slot += n
            kernel_grad = 1e-5 * kernel
            for j in range(len(kernel)):
                at = np.minimum(top + j, len(x) - 1)
                kernel_grad[j] += np.einsum("bf,bfd->df", d, x[at])
                back = (d[:, :, None] * kernel[j].T[None]).reshape(-1, kernel.shape[1])
                for k in range(2):
                    rows.append(ids[at, k].ravel())
                    grads.append(back)
            update(f"k{w}", kernel, kernel_grad)
            update(f"s{w}", shift, d.sum(axis=0))
        update("out", self.out, out_grad)
        bias = np.array([self.bias], np.float32)
        update("bias", bias, np.array([err.sum()], np.float32))
        self.bias = float(bias[0])
        rows, grads = np.concatenate(rows), np.concatenate(grads)
        kinds, at = np.unique(rows, return_inverse=True)
        total = np.zeros((len(kinds), grads.shape[1]), np.float32)
        np.add.at(total, at, grads)
        total[kinds == 0] = 0
        state = memory.setdefault("table", np.full((BUCKETS, grads.shape[1]), 1e-6, np.float32))
        state[kinds] += total * total
        self.table[kinds] -= rate * total / np.sqrt(state[kinds])
        return float(-np.mean(np.where(label == 1, np.log(p + 1e-9), np.log(1 - p + 1e-9))))


def learn(samples: list[tuple[np.ndarray, int]], epochs: int | None = None, batch: int = 64, rate: float = 0.05, seed: int = 1) -> Net:
    """A net from (feature rows, label) of texts; both labels weigh alike. Few texts are seen more often."""
    epochs = epochs or int(np.clip(30_000 // max(len(samples), 1), 6, 40))
    net, memory, rng = Net.fresh(seed=seed), {}, np.random.default_rng(seed)
    labels = np.array([y for _, y in samples], np.float32)
    share = labels.mean() if len(labels) else 0.0
    if not 0 < share < 1:
        net.out[:], net.bias = 0, 3.0 if share else -3.0
        return net
    weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    for epoch in range(epochs):
        order = rng.permutation(len(samples))
        for low in range(0, len(order), batch):
            own = order[low : low + batch]
            offsets = np.concatenate([[0], np.cumsum([len(samples[i][0]) for i in own])])
            net.step(np.concatenate([samples[i][0] for i in own]), offsets, labels[own], weights[own], rate / (1 + 0.3 * epoch), memory)
    return net


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", toxic: str = "toxic", max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_bytes: int = MAX_BYTES) -> Net:
    """A net from at most ``max_toxic`` and ``max_clean`` labelled rows, by hash of the id, of at most ``max_bytes`` each."""
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    known = labels.where(F.col(toxic).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max(toxic).cast("int").alias("_y"))
    both = texts.where(F.octet_length("_text") <= max_bytes).join(known, "_id").select("_id", "_y")
    drawn = [both.where(F.col("_y") == y).select("_id", "_y", F.xxhash64("_id").alias("_at")).orderBy("_at", "_id").limit(n) for y, n in ((1, max_toxic), (0, max_clean))]
    ids = settle(drawn[0].unionByName(drawn[1]).select("_id", "_y").distinct())
    rows = texts.where(F.octet_length("_text") <= max_bytes).join(F.broadcast(ids), "_id").select("_id", "_y", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            found, offsets = features(part.column("_text"))
            cut = [found[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_y"), pa.array(cut, pa.binary())], ["_id", "_y", "f"])

    schema = rows.select("_id", "_y").withColumn("f", F.lit(None).cast("binary")).schema
    got = sorted(((r["_id"], r["f"], r["_y"]) for r in rows.mapInArrow(run, schema).toLocalIterator()), key=lambda r: r[:2])
    return learn([(np.frombuffer(f, np.int32).reshape(-1, 2), y) for _, f, y in got])


def score(docs: DataFrame, net: Net, keep: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """``keep`` columns and the score, 0 to 1, of every row; a null text is an empty one.

    The net has a fixed size, whatever it learnt from, and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_body"))
    schema = rows.drop("_body").withColumn(out, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_body", 1 << 20):
            made = shared.value.scores(*features(part.column("_body"))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(made)], schema.names)

    return rows.mapInArrow(run, schema)


def thresholds(scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", lang: str = "lang", toxic: str = "toxic", steps: int = 200) -> DataFrame:
    """(lang, threshold, f1): for each language the score that parts its labelled rows best.

    Scores are counted in ``steps`` steps by language and label before anything is ordered.
    """
    known = labels.where(F.col(toxic).isin(0, 1)).groupBy(id_col).agg(F.max(toxic).cast("long").alias("_y"))
    level = F.floor(F.col("score") * steps).alias("_step")
    counted = scored.join(known, id_col).groupBy(lang, level).agg(F.sum("_y").alias("hit"), F.sum(1 - F.col("_y")).alias("miss"))
    above = Window.partitionBy(lang).orderBy(F.desc("_step")).rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.withColumns({"tp": F.sum("hit").over(above), "fp": F.sum("miss").over(above), "all": F.sum("hit").over(Window.partitionBy(lang))})
    f1 = 2 * F.col("tp") / (F.col("all") + F.col("tp") + F.col("fp"))
    return summed.groupBy(lang).agg(F.max_by(F.col("_step") / steps, F.struct(f1, -F.col("_step"))).alias("threshold"), F.max(f1).alias("f1"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", toxic: str = "toxic") -> DataFrame:
    """id, lang, score, threshold and toxic of every row, by thresholds calibrated by language.

    A language without labelled rows, or null, takes 0.7.
    """
    net = fit(docs, labels, id_col, text, toxic)
    scored = settle(score(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{lang}`").alias("_lang"), F.col(f"`{text}`").alias("_text")), net, ["_id", "_lang"], "_text"))
    limits = thresholds(scored, labels.withColumnRenamed(id_col, "_id"), "_id", "_lang", toxic).select(F.col("_lang").alias("_of"), "threshold")
    joined = scored.join(limits, F.col("_lang") == F.col("_of"), "left").withColumn("threshold", F.coalesce("threshold", F.lit(0.7)))
    return joined.select(F.col("_id").alias(id_col), F.col("_lang").alias(lang), "score", "threshold", (F.col("score") >= F.col("threshold")).alias("toxic"))
