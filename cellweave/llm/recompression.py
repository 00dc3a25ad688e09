"""Repeated passages by recompression: rounds name runs and pairs of tokens alike everywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.text import Tokens, mix, powers, slices

CHUNK_BYTES = 8 << 20
ROUNDS = 5
U = np.uint64
OUT = -(2**30)
#: Odd factors whose product's top bit halves the alphabet, another way in each round.
SIDES = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA3B195354A39B70D, 0x8CB92BA72F3D8DD7, 0xDB4F0B9175AE2165, 0xBD9ACF2D8C3A7E4B, 0xE220A8397B1DCDAF)


class Symbols:
    """Symbols of a sequence of texts: names, and the span of words on which each one depends.

    ``low`` and ``high`` bound the words that make a symbol and those that were looked at
    to close it, so any text that holds the same words there has the same symbol there.
    What depends on an end of its text has a bound out of reach.
    """

    def __init__(self, names: np.ndarray, offsets: np.ndarray):
        n = len(names)
        self.names, self.low, self.high = names, np.arange(n, dtype=np.int32), np.arange(1, n + 1, dtype=np.int32)
        full = np.flatnonzero(np.diff(offsets))
        self.begin, self.end = np.zeros(n, bool), np.zeros(n, bool)
        self.begin[offsets[full]] = True
        self.end[offsets[full + 1] - 1] = True

    def _widened(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds after the symbols at ``left`` have looked at their left neighbour, those at ``right`` at their right one."""
        low, high = self.low.copy(), self.high.copy()
        for at, edge, step in ((left, self.begin, -1), (right, self.end, 1)):
            out, at = at[edge[at]], at[~edge[at]]
            low[at] = np.minimum(low[at], self.low[at + step])
            high[at] = np.maximum(high[at], self.high[at + step])
            if step < 0:
                low[out] = OUT
            else:
                high[out] = -OUT
        return low, high

    def name_runs(self) -> None:
        """Give each maximal run of one symbol a name made of the symbol and the run's length.

        Also a single symbol is known to be no run by its neighbours.
        """
        n = len(self.names)
        if not n:
            return
        new = self.begin.copy()
        new[1:] |= self.names[1:] != self.names[:-1]
        first = np.flatnonzero(new)
        length = np.diff(first, append=n)
        last = first + length - 1
        low, high = self._widened(first, last)
        names, run = self.names[first], length > 1
        names[run] = mix(names[run] * U(0x9E3779B97F4A7C15) + length[run].astype(U))
        self.names, self.low, self.high = names, np.minimum(low[first], low[last]), np.maximum(high[first], high[last])
        self.begin, self.end = self.begin[first], self.end[last]

    def name_pairs(self, round_no: int) -> None:
        """Join each symbol of the left half of the alphabet with a following one of the right half."""
        n = len(self.names)
        if n < 2:
            return
        right = (self.names * U(SIDES[round_no % len(SIDES)])) >> U(63) != 0
        joins = np.zeros(n, bool)
        joins[:-1] = ~right[:-1] & right[1:] & ~self.end[:-1]
        second = np.zeros(n, bool)
        second[1:] = joins[:-1]
        # What stays alone does so for the neighbour with which it could have been joined.
        alone = ~(joins | second)
        low, high = self._widened(np.flatnonzero(alone & right), np.flatnonzero(alone & ~right))
        at = np.flatnonzero(joins)
        names = self.names.copy()
        names[at] = mix(self.names[at] * U(0xA0761D6478BD642F) + (self.names[at + 1] ^ U(round_no + 1)) * U(0xE7037ED1A0B428DB))
        low[at] = np.minimum(self.low[at], self.low[at + 1])
        high[at] = np.maximum(self.high[at], self.high[at + 1])
        keep = ~second
        self.end[at] = self.end[at + 1]
        self.names, self.low, self.high, self.begin, self.end = names[keep], low[keep], high[keep], self.begin[keep], self.end[keep]


def parse(names: np.ndarray, offsets: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    """The symbols of the last round. Runs are named in the first round and every fourth."""
    symbols = Symbols(names, offsets)
    for k in range(rounds):
        if k % 4 == 0:
            symbols.name_runs()
        symbols.name_pairs(k)
    return symbols


def _windows(first: np.ndarray, second: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each window of ``width`` words, the same for equal windows."""
    n = len(first)
    out = []
    for x, base in ((first, 0x9E3779B97F4A7C15), (second, 0xC2B2AE3D27D4EB4F)):
        up, down = powers(base, n)
        upto = np.concatenate([[U(0)], np.cumsum(x * up)])
        out.append(mix((upto[width:] - upto[: n - width + 1]) * down[: n - width + 1]))
    return out[0], out[1]


def _inside(offsets: np.ndarray, width: int) -> np.ndarray:
    """Which positions of the whole sequence begin a window inside one text."""
    ok = np.zeros(max(int(offsets[-1]) - width + 1, 0), bool)
    change = np.zeros(len(ok) + 1, np.int64)
    long = np.diff(offsets) >= width
    np.add.at(change, offsets[:-1][long], 1)
    np.add.at(change, offsets[1:][long] - width + 1, -1)
    return np.cumsum(change[:-1]) > 0


def _candidates(symbols: Symbols, shared: np.ndarray, inside: np.ndarray, width: int) -> np.ndarray:
    """Windows that may occur again: all but those that hold the whole span of an unshared symbol."""
    lone = ~_among(symbols.names, shared) & (symbols.low >= 0) & (symbols.high - symbols.low <= width)
    change = np.zeros(len(inside) + 1, np.int64)
    np.add.at(change, np.clip(symbols.high[lone] - width, 0, len(inside)), 1)
    np.add.at(change, np.clip(symbols.low[lone] + 1, 0, len(inside)), -1)
    return np.flatnonzero(inside & (np.cumsum(change[:-1]) == 0))


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of x are in the sorted array."""
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def _counted(*keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys and whether each occurs more than once."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.diff([*first, len(order)]) > 1


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(chunk, h) of the rows whose keys occur in another row, or more than once in their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        again = False

        def decide(table: pa.RecordBatch, before: bool, last: bool) -> tuple[pa.RecordBatch, bool]:
            """Rows decided; the last row waits for the next batch unless this is the last."""
            n = table.num_rows
            same = np.ones(n - 1, bool)
            for key in keys:
                x = table.column(key).to_numpy()
                same &= x[1:] == x[:-1]
            hit = table.column("many").to_numpy(zero_copy_only=False).copy()
            hit[1:] |= same
            hit[:-1] |= same
            hit[0] |= before
            if not last:
                hit = hit[:-1]
            at = pa.array(np.flatnonzero(hit))
            carried = bool(same[-1]) if n > 1 else before
            return pa.RecordBatch.from_arrays([table.column("chunk").take(at), table.column(keys[0]).take(at)], ["chunk", "h"]), carried

        for batch in batches:
            if not batch.num_rows:
                continue
            table = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            out, again = decide(table, again, False)
            held = table.slice(table.num_rows - 1)
            yield out
        if held is not None:
            yield decide(held, again, True)[0]

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "chunk long, h long")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None, width: int = 35, layout: bool = False, chunk_bytes: int = CHUNK_BYTES, rounds: int = ROUNDS) -> DataFrame:
    """``keep`` columns (the id), n_words, n_removed and kept_text of every row: words outside of all repeated windows.

    The kept words are joined by one space; with ``layout`` the text keeps its blanks.

    A window of ``width`` consecutive words is repeated if its words also start anywhere
    else, in the same text or another. Names are hashes of what they stand for, so all
    tasks name a run, pair or word alike. Symbols of the last round are exchanged once by
    name; a window that holds the span of a symbol that occurs only once can't be
    repeated. The others are exchanged by 96-bit sums of their words, which verifies
    them. A name or window counts once per chunk of texts, so a hot one is as many rows
    as chunks. Null and empty texts have no words; fewer than ``width`` words: nothing is
    removed; repeated rows are texts like any other; an empty table gives none.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    body = F.col(f"`{text}`").cast("string")
    kept = [id_col] if keep is None else keep
    names = [f"c{k}" for k in range(len(kept))]
    rows = docs.select(F.pmod(F.xxhash64(F.col(f"`{id_col}`"), body), F.lit(chunks)).alias("chunk"), body.alias("_text"), *[F.col(f"`{c}`").alias(n) for n, c in zip(names, kept, strict=True)])

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            tokens = Tokens(part.column("_text"))
            found = parse(tokens.hashes(), tokens.offsets, rounds)
            text = np.flatnonzero(np.diff(tokens.offsets))[np.cumsum(found.begin) - 1]
            chunk = part.column("chunk").to_numpy()[text]
            names, many = _counted(found.names, chunk)
            yield pa.RecordBatch.from_arrays([pa.array(names[1]), pa.array(names[0].view(np.int64)), pa.array(many)], ["chunk", "h", "many"])

    named = _shared(rows.select("chunk", "_text").mapInArrow(symbols, "chunk long, h long, many boolean"), ["h"])

    def windows(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        shared = np.unique(right.column("h").to_numpy().view(U))
        first, second, many = [], [], []
        for part in slices(left.to_batches(), "_text"):
            tokens = Tokens(part.column("_text"))
            inside = _inside(tokens.offsets, width)
            if not inside.any():
                continue
            a, b = tokens.hashes(0), tokens.hashes(1)
            at = _candidates(parse(a, tokens.offsets, rounds), shared, inside, width)
            x, y = _windows(a, b, width)
            first.append(x[at])
            second.append((y[at] >> U(32)).astype(np.uint32))
        if not first:
            return pa.table({"chunk": pa.array([], pa.int64()), "h": pa.array([], pa.int64()), "g": pa.array([], pa.int32()), "many": pa.array([], pa.bool_())})
        (x, y), many = _counted(np.concatenate(first), np.concatenate(second))
        return pa.table({"chunk": np.full(len(x), int(key[0].as_py())), "h": x.view(np.int64), "g": y.view(np.int32), "many": many})

    marked = rows.groupBy("chunk").cogroup(named.groupBy("chunk")).applyInArrow(windows, "chunk long, h long, g int, many boolean")
    repeated = _shared(marked, ["h", "g"])
    schema = rows.select(*names).withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept_text": F.lit("")}).schema

    def strip(left: pa.Table, right: pa.Table) -> pa.Table:
        found, out = np.unique(right.column("h").to_numpy().view(U)), []
        for part in slices(left.to_batches(), "_text"):
            tokens = Tokens(part.column("_text"))
            inside, covered = _inside(tokens.offsets, width), np.zeros(len(tokens), bool)
            if inside.any() and len(found):
                x, _ = _windows(tokens.hashes(0), tokens.hashes(1), width)
                starts = np.flatnonzero(inside & _among(x, found))
                change = np.zeros(len(tokens) + 1, np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + width, -1)
                covered = np.cumsum(change[:-1]) > 0
            gone = np.diff(np.concatenate([[0], np.cumsum(covered)])[tokens.offsets])
            n, joined = np.diff(tokens.offsets), (tokens.cut if layout else tokens.joined)(~covered).cast(pa.string())
            out.append(pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(n), pa.array(gone), joined], schema.names))
        return pa.Table.from_batches(out)

    done = rows.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(strip, schema)
    return done.toDF(*kept, "n_words", "n_removed", "kept_text")
