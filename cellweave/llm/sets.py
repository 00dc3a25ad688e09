"""Sets of 64-bit names as bits of bounded size, to tell most outsiders inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.text import mix

U = np.uint64
#: Least and most bits of a set; the most are 32 MB.
SET_BITS = (16, 28)


class Names:
    """A set of names as bits: what is not in it is not among the names, the rest may be."""

    def __init__(self, bits: int, words: np.ndarray, values: np.ndarray):
        self.mask = U((1 << bits) - 1)
        self.bits = np.zeros(1 << (bits - 6), U)
        self.bits[words] = values

    def may_hold(self, names: np.ndarray) -> np.ndarray:
        at = mix(names) & self.mask
        return (self.bits[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) != 0


def names_of(rows: DataFrame, name: str) -> Names:
    """The column's names as a set whose size follows their number, 32 MB at most."""
    n = rows.count()
    bits = min(max(SET_BITS[0], (16 * n).bit_length()), SET_BITS[1])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = mix(batch.column(0).to_numpy().view(U)) & U((1 << bits) - 1)
            yield pa.RecordBatch.from_arrays([pa.array((at >> U(6)).astype(np.int64)), pa.array((U(1) << (at & U(63))).view(np.int64))], ["word", "bit"])

    found = rows.select(name).mapInArrow(place, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    return Names(bits, found.column("word").to_numpy(), found.column("bit").to_numpy().view(U))
