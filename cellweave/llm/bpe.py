"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.text import mix, slices

CACHE = 400_000


class PerfectHash:
    """A minimal perfect hash over a fixed set of byte strings: n slots for n keys.

    A key's bucket has a displacement that sends all of the bucket's keys to free slots;
    buckets are placed from the largest down, and those of one key name their slot.
    """

    def __init__(self, keys: list[bytes], load: int = 4):
        self.keys, self.n = keys, len(keys)
        self.buckets = max(1, self.n // load)
        for self.seed in range(100):
            hashes = self._hash(keys)
            if len(np.unique(hashes)) == self.n and self._place(hashes):
                return
        raise ValueError("keys must be distinct")

    def _hash(self, keys: Iterable[bytes]) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(k, self.seed) for k in keys], np.uint64)

    def _slots(self, hashes: np.ndarray, move: np.ndarray) -> np.ndarray:
        return (mix(hashes + move.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def _place(self, hashes: np.ndarray) -> bool:
        bucket = (hashes >> np.uint64(20)) % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        taken, self.move = np.zeros(self.n, bool), np.zeros(self.buckets, np.int64)
        self.key_at = np.zeros(self.n, np.int64)
        free = None
        for b in np.argsort(-np.diff(cuts), kind="stable"):
            own = order[cuts[b] : cuts[b + 1]]
            if len(own) == 1:
                free = iter(np.flatnonzero(~taken).tolist()) if free is None else free
                slot = np.array([next(free)])
                self.move[b] = -int(slot[0]) - 1
            elif len(own):
                for low in range(0, 1 << 20, 64):
                    tries = np.arange(low, low + 64)
                    slots = np.sort(self._slots(hashes[own][None, :], tries[:, None]), axis=1)
                    good = ~taken[slots].any(axis=1) & (np.diff(slots, axis=1) > 0).all(axis=1)
                    if good.any():
                        self.move[b] = tries[np.argmax(good)]
                        break
                else:
                    return False
                slot = self._slots(hashes[own], np.full(len(own), self.move[b]))
            else:
                continue
            taken[slot] = True
            self.key_at[slot] = own
        return True

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Index of each key among the keys, -1 where it is none of them."""
        if not keys or not self.n:
            return np.full(len(keys), -1)
        hashes = self._hash(keys)
        move = self.move[((hashes >> np.uint64(20)) % np.uint64(self.buckets)).astype(np.int64)]
        at = self.key_at[np.where(move < 0, -move - 1, self._slots(hashes, np.maximum(move, 0)))]
        known = self.keys
        return np.array([i if known[i] == k else -1 for i, k in zip(at.tolist(), keys, strict=True)], np.int64)


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank, leftmost first, is joined until none is left."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    live = [True] * n
    rank_of = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        # An entry is out of date if its pair no longer spans these bytes.
        if not live[i] or (j := after[i]) >= n or after[j] != end:
            continue
        live[j] = False
        after[i] = end
        if end < n:
            before[end] = i
            if (r := rank_of(piece[i : after[end]])) is not None:
                heappush(heap, (r, i, after[end]))
        if (p := before[i]) >= 0 and (r := rank_of(piece[p:end])) is not None:
            heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Codec:
    """Encodes and decodes with one rank file; answers for pre-tokens are kept up to CACHE of them."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.tokens = PerfectHash(list(self.ranks))
        self.ids = list(self.ranks.values())
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn(self, new: list[str]) -> None:
        raw = [t.encode() for t in new]
        for text, piece, at in zip(new, raw, self.tokens.find(raw).tolist(), strict=True):
            self.known[text] = (self.ids[at],) if at >= 0 else tuple(merged(piece, self.ranks))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text, split by the pattern, without special tokens."""
        pieces = [self.split(t) for t in texts]
        new = set().union(*pieces)
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
        self._learn([t for t in new if t not in self.known])
        of = self.known.__getitem__
        return (list(chain.from_iterable(map(of, p))) for p in pieces)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text (array<int>); a null text has none."""
    rows = docs.withColumn(out, F.col(f"`{text}`").cast("string"))
    schema = docs.withColumn(out, F.array().cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, out):
            made = pa.array(list(codec(path, pattern).encode([t or "" for t in part.column(out).to_pylist()])), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], part.schema.names)

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``rows`` with the bytes that ``ids`` stand for; null ids are no bytes."""
    source = rows.withColumn(out, F.col(f"`{ids}`"))
    schema = rows.withColumn(out, F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            made = pa.array([codec(path, pattern).decode(x or ()) for x in part.column(out).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], part.schema.names)

    return source.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of every row: encoded, decoded and digested in one pass.

    Null and empty texts have no ids; repeated rows each have a row; an empty table gives none.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    schema = rows.select("_id").withColumns({"n_tokens": F.lit(0).cast("long"), "ids_sha256": F.lit(""), "decoded_sha256": F.lit("")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        decimal = {i: str(i) for i in own.ids}.__getitem__
        for part in slices(batches, "_text", 2 << 20):
            counts, coded, decoded = [], [], []
            for ids in own.encode([t or "" for t in part.column("_text").to_pylist()]):
                counts.append(len(ids))
                coded.append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
