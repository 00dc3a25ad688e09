"""Alignment of two tokenizers: shared ends before space-marked tokens, windows of ids, counted links."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.text import slices
from cellweave.session import settle

SLICE = 1 << 20
CHUNK_BYTES = 8 << 20
WINDOW_IDS = 64
MEMO = 400_000
GROUP_LINKS = 4096
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
B_MARK = np.int32(1 << 30)


class Pair:
    """Both tokenizers and the bytes of their tokens.

    The rank file holds the vocabulary of the byte-level tokenizer file and gives the same
    ids faster; without special tokens their strings are plain text.
    """

    def __init__(self, ranks: str, pattern: str, pieces: str):
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.a = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes = [b""] * (max(table.values()) + 1)
        for token, i in table.items():
            self.a_bytes[i] = token
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))
        ]
        self.lengths = [np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes)]
        self.spaced = [np.array([t.startswith(b" ") for t in table]) for table in (self.a_bytes, self.b_bytes)]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each whole text by both; none where its bytes aren't those of a space and the text."""
        a = [self.a.encode_ordinary(" " + t) if t else [] for t in texts]
        b = self.b.encode(texts, num_threads=1)
        for k, text in enumerate(texts):
            want = b" " + text.encode()
            if not text or b"".join(map(self.a_bytes.__getitem__, a[k])) != want or b"".join(map(self.b_bytes.__getitem__, b[k])) != want:
                a[k], b[k] = [], []
        return a, b


@lru_cache(maxsize=2)
def _pair(ranks: str, pattern: str, pieces: str) -> Pair:
    """One pair per worker process."""
    return Pair(ranks, pattern, pieces)


def _column(values: np.ndarray, size: int, new: np.ndarray) -> np.ndarray:
    """``new`` behind the first ``size`` values, in an array that grows by doubling."""
    if size + len(new) > len(values):
        values = np.concatenate([values, np.empty(size + len(new), np.int64)])
    values[size : size + len(new)] = new
    return values


def _shared_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A, and of B, that end where one of the other ends."""
    is_end = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 1, bool)
    is_end[b_ends] = True
    shared = np.flatnonzero(is_end[a_ends])
    is_end[b_ends] = False
    is_end[a_ends] = True
    return shared, np.flatnonzero(is_end[b_ends])


class Windows:
    """Alignments of windows by their id tuples: the groups as text, and the id pairs with their links.

    A window of more than WINDOW_IDS ids is not remembered beyond its slice, so the memory
    of a remembered one is bounded; their number is bounded by MEMO. The distinct new
    windows of a slice are aligned together.
    """

    def __init__(self, pair: Pair):
        self.pair = pair
        self.spelt = pa.array([f"{i}{end}" for table, ends in ((pair.a_bytes, ",|"), (pair.b_bytes, ",;")) for i in range(len(table)) for end in ends], pa.large_string())
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.number: dict[int, int] = {}
        self.texts: list[str] = []
        self.starts, self.pairs, self.links = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.size = 0

    def _learn(self, keys: list[bytes]) -> None:
        ids = np.frombuffer(b"".join(keys), np.int32)
        window = np.repeat(np.arange(len(keys)), [len(k) // 4 for k in keys])
        right = ids >= B_MARK
        a, b, a_window = ids[~right], ids[right] - B_MARK, window[~right]
        last_a, last_b = _shared_ends(np.cumsum(self.pair.lengths[0][a]), np.cumsum(self.pair.lengths[1][b]))
        n_a, n_b, of = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1), a_window[last_a]
        first_a, first_b = last_a - n_a + 1, last_b - n_b + 1
        # The groups as text: every id with the sign behind it, A's before B's in each group.
        sign = np.empty(len(ids), np.int64)
        sign[np.arange(len(a)) + np.repeat(first_b, n_a)] = 2 * a.astype(np.int64)
        sign[np.arange(len(b)) + np.repeat(last_a + 1, n_b)] = 2 * (len(self.pair.a_bytes) + b.astype(np.int64))
        sign[last_a + first_b] += 1
        sign[last_a + 1 + last_b] += 1
        spelt = self.spelt.take(pa.array(sign))
        at = np.frombuffer(spelt.buffers()[1], np.int64)[np.concatenate([[0], np.cumsum(np.bincount(window, minlength=len(keys)))])].tolist()
        text = spelt.buffers()[2].to_pybytes().decode()
        self.texts += [text[x : y - 1] for x, y in zip(at, at[1:], strict=False)]
        links = n_a * n_b
        few = links <= GROUP_LINKS
        each = np.where(few, links, 0)
        group = np.repeat(np.arange(len(of)), each)
        step = np.arange(len(group)) - np.repeat(np.cumsum(each) - each, each)
        pairs = [a[first_a[group] + step // n_b[group]].astype(np.int64) << 32 | b[first_b[group] + step % n_b[group]]]
        owner, times = [of[group]], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(~few).tolist():
            x, n = np.unique(a[first_a[g] : last_a[g] + 1].astype(np.int64), return_counts=True)
            y, m = np.unique(b[first_b[g] : last_b[g] + 1].astype(np.int64), return_counts=True)
            pairs.append((x[:, None] << 32 | y).ravel())
            times.append(np.outer(n, m).ravel())
            owner.append(np.full(len(pairs[-1]), of[g]))
        distinct, at_pair = np.unique(np.concatenate(pairs), return_inverse=True)
        code, times = _added(np.concatenate(owner) * max(len(distinct), 1) + at_pair, np.concatenate(times))
        numbers = self.number
        place = np.array([numbers.setdefault(p, len(numbers)) for p in distinct.tolist()], np.int64)
        ends = np.cumsum(np.bincount(code // max(len(distinct), 1), minlength=len(keys)))
        done = len(self.texts) - len(keys)
        self.starts = _column(self.starts, done + 1, self.size + ends)
        self.pairs = _column(self.pairs, self.size, place[code % max(len(distinct), 1)])
        self.links = _column(self.links, self.size, times)
        self.size += len(code)

    def align(self, keys: list[bytes]) -> np.ndarray:
        """The number of each window's alignment."""
        found = list(map(self.known.get, keys))
        new = list(dict.fromkeys(k for k, x in zip(keys, found, strict=True) if x is None))
        if new:
            fresh = {k: n for n, k in enumerate(new, len(self.texts))}
            self._learn(new)
            found = [fresh[k] if x is None else x for k, x in zip(keys, found, strict=True)]
            self.known.update((k, n) for k, n in fresh.items() if len(k) <= 4 * WINDOW_IDS)
        return np.array(found, np.int64)


def _added(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, with the sum of n."""
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
    return np.fromiter(chain.from_iterable(lists), np.int32, offsets[-1]), offsets


def _window_keys(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray) -> list[bytes]:
    """The ids of both sides of each window, whose ends are given, as one byte string."""
    a_len, b_len = np.diff(a_end, prepend=0), np.diff(b_end, prepend=0)
    both = np.empty(len(a) + len(b), np.int32)
    both[np.arange(len(a)) + np.repeat(b_end - b_len, a_len)] = a
    both[np.arange(len(b)) + np.repeat(a_end, b_len)] = b + B_MARK
    raw, cuts = both.tobytes(), [0, *(4 * (a_end + b_end)).tolist()]
    return [raw[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]


def _aligned(pair: Pair, windows: Windows, texts: list[str]) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Figures and groups of each text, then (text, pair number, links) of all its distinct id pairs, by text."""
    (a, a_at), (b, b_at) = map(_flat, pair.encode(texts))
    # Both sides have the same bytes in every text, so byte positions agree over all texts.
    shared_a, shared_b = _shared_ends(np.cumsum(pair.lengths[0][a]), np.cumsum(pair.lengths[1][b]))
    text = np.searchsorted(a_at, shared_a, side="right") - 1
    n_groups = np.bincount(text, minlength=len(texts))
    each = np.diff(shared_a, prepend=-1) * np.diff(shared_b, prepend=-1)
    upto, cuts = np.concatenate([[0], np.cumsum(each)]), np.concatenate([[0], np.cumsum(n_groups)])
    anchor = np.append(text[1:] != text[:-1], True)[: len(text)]
    anchor[:-1] |= pair.spaced[0][a[shared_a[:-1] + 1]] & pair.spaced[1][b[shared_b[:-1] + 1]]
    at = windows.align(_window_keys(a, b, shared_a[anchor] + 1, shared_b[anchor] + 1))
    ends, found = np.concatenate([[0], np.cumsum(np.bincount(text[anchor], minlength=len(texts)))]).tolist(), at.tolist()
    groups = [";".join(map(windows.texts.__getitem__, found[x:y])) for x, y in zip(ends, ends[1:], strict=False)]
    starts, kinds = windows.starts, max(len(windows.number), 1)
    size = starts[at + 1] - starts[at]
    place = np.arange(int(size.sum())) + np.repeat(starts[at] - np.cumsum(size) + size, size)
    code, links = _added(np.repeat(text[anchor], size) * kinds + windows.pairs[place], windows.links[place])
    figures = [np.diff(a_at), np.diff(b_at), n_groups.astype(np.int64), upto[cuts[1:]] - upto[cuts[:-1]]]
    return figures, groups, code // kinds, code % kinds, links


def align(docs: DataFrame, ranks: str, pattern: str, pieces: str, id_col: str = "doc_id", text: str = "text", with_groups: bool = False) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row; the groups too if asked for.

    Each whole text is encoded by both tokenizers (ranks: A, pieces: B). Ends that both
    share before tokens that begin with a space cut it into windows of ids, each distinct
    window is aligned once per memo. Byte offsets where tokens of both end cut the text
    into groups, written ``a1,a2|b1;a3|b2``; all pairs of a group are links. An id pair's
    count is the number of rows that hold it linked. Texts go through Spark once: a task
    keeps, by chunk, its texts' pairs as numbers into the chunk's own dictionary; only
    dictionaries are joined with the counts. A null or empty text, or one that a tokenizer
    changes, has zeros and an empty string; repeated rows count each; rows of a null id
    are rows; an empty table gives none.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    long, longs, string = (F.lit(None).cast(kind) for kind in ("long", "array<long>", "string"))
    made = {c: long for c in FIGURES} | {"groups_sha256": string} | ({"groups": string} if with_groups else {})
    schema = rows.select(F.when(F.lit(True), F.col("_id")).alias("_id")).withColumns(made | {"chunk": long, "at": F.lit(None).cast("array<int>"), "links": longs, "pairs": longs, "held": longs}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(ranks, pattern, pieces)
        windows, part_id, done, kind = Windows(pair), TaskContext.get().partitionId() << 32, 0, pa.null()
        held, size = [], 0

        def chunk() -> pa.RecordBatch:
            """The rows held and, as the last, the chunk's dictionary."""
            number = np.concatenate([h[3] for h in held])
            used, local = np.unique(number, return_inverse=True)
            keys = np.fromiter(windows.number, np.int64, len(windows.number))[used]
            counts = np.concatenate([h[2] for h in held])
            n = len(counts)
            starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            last = np.append(starts, starts[-1])

            def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(last, pa.int32()), pa.array(values, kind))

            def only(values: np.ndarray) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(np.append(np.zeros(n + 1, np.int32), np.int32(len(values)))), pa.array(values, pa.int64()))

            cols = [pa.concat_arrays([*(h[0] for h in held), pa.nulls(1, kind)])]
            cols += [pa.array(np.append(np.concatenate([h[1][k] for h in held]), 0), pa.int64()) for k in range(len(FIGURES))]
            for k in range(5, 7 if with_groups else 6):
                cols.append(pa.array([*(g for h in held for g in h[k]), None], pa.string()))
            cols.append(pa.array(np.full(n + 1, part_id + done), pa.int64()))
            cols += [lists(local, pa.int32()), lists(np.concatenate([h[4] for h in held]), pa.int64()), only(keys), only(np.bincount(local, minlength=len(used)))]
            return pa.RecordBatch.from_arrays(cols, schema.names)

        for part in slices(batches, "_text", SLICE):
            kind = part.schema.field("_id").type
            texts = [t or "" for t in part.column("_text").to_pylist()]
            figures, groups, of, number, links = _aligned(pair, windows, texts)
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            held.append((part.column("_id"), figures, np.bincount(of, minlength=len(texts)), number, links, digests, groups if with_groups else None))
            size += sum(map(len, texts))
            if size >= CHUNK_BYTES or len(windows.texts) > MEMO:
                yield chunk()
                held, size, done = [], 0, done + 1
                if len(windows.texts) > MEMO:
                    windows.clear()
        if held:
            yield chunk()

    found = settle(rows.mapInArrow(run, schema))
    words = found.where("pairs IS NOT NULL AND size(pairs) > 0").select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("k", "_")).select("chunk", "k", F.col("_.pairs").alias("pair"), F.col("_.held").alias("n"))
    counted = settle(words.groupBy("pair").agg(F.sum("n").alias("n")))
    # One row per id of A, which its vocabulary bounds.
    best = counted.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    ranked = counted.join(F.broadcast(best), F.shiftright("pair", 32) == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("top"))
    asked = words.select(F.col("chunk").alias("part"), "k", "pair").join(ranked, "pair").select("part", "k", "n", "top")
    own = ["_id", *made]
    out = found.select(*own).withColumns({"n_best": long, "count_sum": long}).schema

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        n, top = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, bool)
        k = right.column("k").to_numpy()
        n[k], top[k] = right.column("n").to_numpy(), right.column("top").to_numpy()
        at, links = left.column("at").combine_chunks(), left.column("links").combine_chunks()
        counts = np.diff(at.offsets.to_numpy())
        at, links = at.flatten().to_numpy(), links.flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(counts)])
        sums = [np.concatenate([[0], np.cumsum(links * x[at])]) for x in (top, n)]
        keep = [left.column(c) for c in own]
        return pa.table([*keep, *(pa.array((s[ends[1:]] - s[ends[:-1]]).astype(np.int64)) for s in sums)], out.names)

    texts = found.where("groups_sha256 IS NOT NULL").select(*own, "chunk", "at", "links")
    done = texts.groupBy("chunk").cogroup(asked.groupBy("part")).applyInArrow(add_up, out)
    names = [*FIGURES, "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else [])]
    return done.select(F.col("_id").alias(id_col), *names)
