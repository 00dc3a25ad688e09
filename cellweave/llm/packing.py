"""Harmonic packing of token pieces into sequences, each worker on its own."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.text import slices

SPECIAL = "<|endoftext|>"
FIELDS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Ids:
    """Little-endian unsigned 32-bit ids of whole texts.

    The rank file holds the vocabulary of the tokenizer file and gives the same ids about
    four times as fast; a text that spells out a special token goes to the tokenizer.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})._core_bpe.encode_to_tiktoken_buffer
        self.path, self.slow = tokenizer, None

    def of(self, text: str) -> bytes:
        if SPECIAL not in text:
            return bytes(self.fast(text, set()))
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def _ids(tokenizer: str, ranks: str, pattern: str) -> Ids:
    return Ids(tokenizer, ranks, pattern)


def lengths(n: int, capacity: int) -> list[tuple[int, int]]:
    """Pieces of n tokens as (length, class): class k has slots of capacity // k tokens.

    What fills its slot but for 1 part in 128 stays whole; else the largest slot below
    its length is cut off.
    """
    out = [(capacity, 1)] * (n // capacity)
    n %= capacity
    while n:
        k = capacity // n
        if capacity // k - n > n // 128:
            k += 1
            while capacity // k > n:
                k += 1
        size = min(n, capacity // k)
        out.append((size, k))
        n -= size
    return out


class Bins:
    """Open bins by class; a class's bin is closed with its fixed number of pieces."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next, self.open = capacity, first, {}

    def add(self, piece: list, k: int) -> list[list]:
        held = self.open.setdefault(k, [])
        held.append(piece)
        return self._close(self.open.pop(k)) if len(held) == k else []

    def _close(self, pieces: list[list]) -> list[list]:
        offset = 0
        for p in pieces:
            p[-2:] = self.next, offset
            offset += p[2]
        self.next += 1
        return pieces

    def rest(self) -> Iterator[list[list]]:
        """What the open bins hold, longest first, each piece in the first bin with room."""
        pieces = sorted((p for held in self.open.values() for p in held), key=lambda p: -p[2])
        bins: list[tuple[list[int], list[list]]] = []
        for p in pieces:
            for room, held in bins:
                if room[0] >= p[2]:
                    break
            else:
                room, held = [self.capacity], []
                bins.append((room, held))
            room[0] -= p[2]
            held.append(p)
        for _, held in bins:
            yield self._close(held)
        self.open = {}


def pack(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, id_col: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A text's ids and ``end_id`` are cut into pieces of reciprocal-capacity classes; a bin
    of class k takes k pieces. Every worker fills bins of its own as rows stream by and
    holds open bins only, at its end it packs what they hold together; so at most a few
    sequences a worker have more padding than rounding makes. A null or empty text is its
    end id; repeated rows are packed each; an empty table gives none. ``with_ids`` adds
    the ids themselves.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    made = {c: F.lit(0).cast("long") for c in FIELDS} | ({"ids": F.array().cast("array<int>")} if with_ids else {})
    schema = rows.select("_id").withColumns(made).schema
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids(tokenizer, ranks, pattern).of
        bins = Bins(capacity, TaskContext.get().partitionId() << 33)
        kind = None

        def table(pieces: list[list]) -> pa.RecordBatch:
            """Pieces are (id, start, length, crc32, doc_tokens, ids, sequence, offset)."""
            cols = [list(c) for c in zip(*pieces, strict=True)]
            out = [pa.array(cols[0], kind), *(pa.array(cols[k], pa.int64()) for k in (1, 2, 3, 4, 6, 7))]
            if with_ids:
                flat = np.frombuffer(b"".join(cols[5]), "<i4")
                out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(cols[2])]).astype(np.int32)), pa.array(flat)))
            return pa.RecordBatch.from_arrays(out, schema.names)

        for part in slices(batches, "_text"):
            kind, done = part.schema.field("_id").type, []
            for name, text_of in zip(part.column("_id").to_pylist(), part.column("_text").to_pylist(), strict=True):
                buf = ids_of(text_of or "") + end
                n, start = len(buf) // 4, 0
                for size, k in lengths(n, capacity):
                    own = buf[4 * start : 4 * (start + size)]
                    done += bins.add([name, start, size, zlib.crc32(own), n, own if with_ids else None, 0, 0], k)
                    start += size
            if done:
                yield table(done)
        for held in bins.rest():
            yield table(held)

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
