"""Words of whole texts as Arrow arrays, for functions that run inside ``mapInArrow``."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 8 << 20
WORD_SQL = r"[^\x20\x09-\x0D]+"


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice stay near ``limit`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        share = np.cumsum(size.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """Offsets per text and the words of all texts; null is a text without words."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    flat, counts = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    full = pc.not_equal(pc.binary_length(flat), 0)
    kept = full.to_numpy(zero_copy_only=False)
    if not kept.all():
        row = np.repeat(np.arange(len(texts)), counts)
        flat, counts = flat.filter(full), np.bincount(row[kept], minlength=len(texts))
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]), flat


def codes(flat: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """A number per word and the distinct words by number."""
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.binary() if pa.types.is_string(flat.type) else pa.large_binary()).to_pylist()


def word_hashes(distinct: list[bytes], seed: int = 0) -> np.ndarray:
    """64-bit hashes of distinct words."""
    hash_of = xxhash.xxh64_intdigest
    return np.fromiter((hash_of(w, seed) for w in distinct), np.uint64, len(distinct))


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 1 << 16) -> Iterator[pa.Table]:
    """From batches sorted by ``keys``: tables that hold whole groups only."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = max(boundaries(table, keys)[-1], 0)
        if last:
            yield table.slice(0, last)
        held, count = table.slice(last).to_batches(), table.num_rows - last
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def boundaries(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where each group of equal keys begins."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        col = table.column(key).combine_chunks()
        if len(col) > 1:
            new[1:] |= pc.fill_null(pc.not_equal(col[1:], col[:-1]), True).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def union(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join u with v, pair by pair; ``parent`` stays flat and points to the least member."""
    while True:
        a, b = parent[u], parent[v]
        apart = a != b
        if not apart.any():
            return
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LONG_WORD = 512
_VALUES = np.random.default_rng(20240229).integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
PIECE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that scatters 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2^64."""
    out = []
    for b in (base, pow(base, -1, 2**64)):
        x = np.full(n, np.uint64(b))
        x[:1] = 1
        out.append(np.cumprod(x))
    return out[0], out[1]


class Tokens:
    """Words of texts as spans of one byte buffer: ``starts``, ``ends`` and ``offsets`` per text."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None and len(at) else np.zeros(0, np.uint8)
        self.data = LOWER[data] if lower else data
        self.texts = at - at[0]
        self.solid = ~BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.texts] = True
        before = np.concatenate([[False], self.solid])
        after = np.concatenate([self.solid, [False]])
        self.starts = np.flatnonzero(after & (~before | edge))
        self.ends = np.flatnonzero(before & (~after | edge))
        self.offsets = np.searchsorted(self.starts, self.texts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; ``which`` 0 and 1 are independent of each other.

        A sum of random values of its bytes times powers of an odd base, mixed with the
        length. Words over LONG_WORD bytes, where such sums get weak, are hashed by XXH3.
        """
        out = np.empty(len(self.starts), np.uint64)
        values = _VALUES[which]
        up, down = powers(_BASES[which], PIECE + LONG_WORD)
        low = 0
        while low < len(out):
            begin = self.starts[low]
            high = max(int(np.searchsorted(self.starts, begin + PIECE)), low + 1)
            a, b = self.starts[low:high] - begin, self.ends[low:high] - begin
            stop = min(int(b[-1]), PIECE + LONG_WORD)
            part = np.zeros(stop + 1, np.uint64)
            np.cumsum(values[self.data[begin : begin + stop]] * up[:stop], out=part[1:])
            out[low:high] = mix((part[np.minimum(b, stop)] - part[a]) * down[a] + (b - a).astype(np.uint64))
            low = high
        for i in np.flatnonzero(self.ends - self.starts > LONG_WORD):
            out[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes(), seed=which)
        return out

    def joined(self, kept: np.ndarray) -> pa.Array:
        """Each text's kept words, joined by one space."""
        keep = np.zeros(len(self.data), bool)
        change = np.zeros(len(self.data) + 1, np.int8)
        change[self.starts[kept]] += 1
        change[self.ends[kept]] -= 1
        keep = np.cumsum(change[:-1], dtype=np.int8) > 0
        at = np.flatnonzero(kept)
        text = np.repeat(np.arange(len(self.texts) - 1), np.diff(self.offsets))[at]
        gaps = self.ends[at[:-1][text[1:] == text[:-1]]] if len(at) > 1 else np.zeros(0, np.int64)
        out = self.data.copy()
        out[gaps] = 32
        keep[gaps] = True
        upto = np.concatenate([[0], np.cumsum(keep)])[self.texts]
        return pa.Array.from_buffers(pa.large_string(), len(self.texts) - 1, [None, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(out[keep])])

    def cut(self, kept: np.ndarray) -> pa.Array:
        """Each text without the words not kept and the blanks behind them; all else as it was."""
        gone = np.flatnonzero(~kept)
        until = np.minimum(np.append(self.starts, len(self.data))[gone + 1], self.texts[1:][np.repeat(np.arange(len(self.texts) - 1), np.diff(self.offsets))[gone]])
        change = np.zeros(len(self.data) + 1, np.int8)
        np.add.at(change, self.starts[gone], 1)
        np.add.at(change, until, -1)
        keep = np.cumsum(change[:-1], dtype=np.int8) == 0
        upto = np.concatenate([[0], np.cumsum(keep)])[self.texts]
        return pa.Array.from_buffers(pa.large_string(), len(self.texts) - 1, [None, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(self.data[keep])])
