"""Near duplicates by 64-bit SimHash, compared bit-sliced."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.graph import components
from cellweave.llm.text import boundaries, mix, slices, union, whole_groups, words
from cellweave.session import settle

CELL = 4096
#: Nodes and bytes of text of one share of a group of candidates.
SHARE, SHARE_BYTES = 2048, 4 << 20
#: Candidates of ``keep_one`` differ in so many of 256 bits at most, and are drawn for so large a
#: share of equal bits: what is expected of 4 and 5 shingles of Jaccard 0.8, the worst of all sizes.
RADIUS, AGREE = 68, 0.8125
WORK = 1 << 17
#: Tables of samples whose components are found before the others are compared.
FIRST = 4


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further hash words of the same shingles; word 0 is the hash itself."""
    if not word:
        return hashes
    x = hashes + np.uint64(0x9E3779B97F4A7C15 * word & 2**64 - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shingles(texts: pa.Array, shingle: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a slice of texts, one text after the other, and their number by text."""
    offsets, flat = words(texts, lower=True)
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), flat), " ")
    sizes = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    hash_of = xxhash.xxh64_intdigest
    hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    for i, text in enumerate(joined.cast(pa.binary() if pa.types.is_string(joined.type) else pa.large_binary())):
        n = offsets[i + 1] - offsets[i]
        if not n:
            continue
        raw = text.as_py()
        if n <= shingle:
            hashes.append(np.array([hash_of(raw, seed)], np.uint64))
        else:
            ends = np.cumsum(sizes[offsets[i] : offsets[i + 1]] + 1)
            starts = np.concatenate([[0], ends[:-1]])
            spans = zip(starts[: n - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
            hashes.append(np.fromiter((hash_of(raw[a:b], seed) for a, b in spans), np.uint64, n - shingle + 1))
        counts[i] = len(hashes[-1])
    return np.concatenate(hashes), counts


def _as_sets(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes once and in order, and their number by text."""
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], np.bincount(text[new], minlength=len(counts))


def _prints(h: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints (texts, width) from shingle hashes."""
    out = np.zeros((len(counts), width), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        ends = np.cumsum(counts[full])
        starts = ends - counts[full]
        for k in range(width):
            mixed = _mixed(h, k)
            for b in range(64):
                ones = np.concatenate([[0], np.cumsum((mixed >> np.uint64(b)) & np.uint64(1), dtype=np.int64)])
                out[full, k] |= (2 * (ones[ends] - ones[starts]) > counts[full]).astype(np.uint64) << np.uint64(b)
    return out


def _of_slice(texts: pa.Array, shingle: int, seed: int, width: int = 1) -> np.ndarray:
    """Fingerprints (rows, width) of a slice of texts."""
    return _prints(*_shingles(texts, shingle, seed), width)


def fingerprints(docs: DataFrame, text: str = "text", keep: Iterable[str] = ("doc_id",), shingle: int = 4, seed: int = 42, width: int = 1) -> DataFrame:
    """``keep`` columns and the fingerprint words ``f0`` to ``f<width-1>`` (long) of every row.

    Words are runs of other characters than ASCII blanks, A-Z lower-cased; shingles count
    as often as they occur. A bit is set if over half the shingle hashes (XXH64) have it.
    Fewer words than a shingle: the whole sequence is one. No words or null: zero.
    """
    keep, made = list(keep), [f"f{k}" for k in range(width)]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_text"))
    schema = rows.drop("_text").withColumns({c: F.lit(0).cast("long") for c in made}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            prints = _of_slice(part.column("_text"), shingle, seed, width).view(np.int64)
            cols = [*(part.column(i) for i in range(len(keep))), *(pa.array(np.ascontiguousarray(prints[:, k])) for k in range(width))]
            yield pa.RecordBatch.from_arrays(cols, [*keep, *made])

    return rows.mapInArrow(run, schema)


def _planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes: word t of plane b holds bit b of prints 64 t to 64 t + 63."""
    padded = np.zeros((-(-len(prints) // 64) * 64, prints.shape[1]), np.uint64)
    padded[: len(prints)] = prints
    rows = [np.packbits(((padded[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1)).astype(np.uint8), bitorder="little") for b in range(64 * prints.shape[1])]
    return np.stack(rows).view(np.uint64)


def _within(planes: np.ndarray, query: np.ndarray, tile: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries and lane masks at ``radius`` or fewer differing bits.

    Each entry compares one print with a tile of 64. Counters are vertical and start at
    such a value that they overflow beyond the radius; a pair of planes enters through one
    full adder, its carry moves up. Tiles whose lanes have all overflowed are abandoned.
    """
    bits = max(1, int(radius).bit_length())
    full, none = np.uint64(2**64 - 1), np.uint64(0)
    entry = np.arange(len(query))
    start = 2**bits - 1 - radius
    count = [np.full(len(query), full if start >> k & 1 else none) for k in range(bits)]
    over = np.zeros(len(query), np.uint64)
    for b in range(0, len(planes), 2):
        word = query[:, b // 64] >> np.uint64(b % 64)
        x = planes[b][tile] ^ (none - (word & np.uint64(1)))
        y = planes[b + 1][tile] ^ (none - ((word >> np.uint64(1)) & np.uint64(1)))
        half = count[0] ^ x
        carry = (count[0] & x) | (half & y)
        count[0] = half ^ y
        for k in range(1, bits):
            count[k], carry = count[k] ^ carry, count[k] & carry
        over |= carry
        if b % 8 == 6:
            alive = (lanes & ~over) != 0
            if not alive.all():
                entry, query, tile, lanes, over = entry[alive], query[alive], tile[alive], lanes[alive], over[alive]
                count = [c[alive] for c in count]
                if not len(entry):
                    break
    return entry, lanes & ~over


def _forest(prints: np.ndarray, first: np.ndarray, radius: int, root: np.ndarray | None = None) -> np.ndarray:
    """Least index linked with each print, inside groups that begin at ``first``; equal roots are linked already."""
    n = len(prints)
    start = np.repeat(first, np.diff([*first, n]))
    parent, planes, at = np.arange(n), _planes(prints), np.arange(n)
    if root is not None:
        order = np.lexsort((root, start))
        new = np.ones(n, bool)
        new[1:] = (root[order[1:]] != root[order[:-1]]) | (start[order[1:]] != start[order[:-1]])
        parent[order] = order[new][np.cumsum(new) - 1]
    tiles = np.where(start < at, at // 64 - start // 64 + 1, 0)
    upto = np.concatenate([[0], np.cumsum(tiles)])
    for low in range(0, int(upto[-1]), WORK):
        item = np.arange(low, min(low + WORK, int(upto[-1])))
        row = np.searchsorted(upto, item, side="right") - 1
        tile = start[row] // 64 + item - upto[row]
        lanes = np.full(len(item), np.uint64(2**64 - 1))
        head = tile == start[row] // 64
        lanes[head] &= np.uint64(2**64 - 1) << (start[row][head] % 64).astype(np.uint64)
        tail = tile == row // 64
        lanes[tail] &= (np.uint64(1) << (row[tail] % 64).astype(np.uint64)) - np.uint64(1)
        entry, hits = _within(planes, prints[row], tile, lanes, radius)
        for k in range(0, len(entry), 1 << 14):
            part = hits[k : k + (1 << 14)]
            e, lane = np.nonzero(np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            union(parent, row[entry[k + e]], tile[entry[k + e]] * 64 + lane)
    return parent


def _forest_edges(keyed: DataFrame, width: int, radius: int) -> DataFrame:
    """Edges (a, b) of a spanning forest of the nodes in ``keyed`` that share (t, k) within the radius.

    ``keyed``: t, k, node, f0.. . A key with more than CELL nodes is dealt over pairs of
    shares, each pair a group of its own, so no task holds more than two shares. If it has
    a column root, nodes of equal root are linked already and the edges join roots.
    """
    keys, prints, known = ["t", "k", "i", "j"], [f"f{w}" for w in range(width)], "root" in keyed.columns
    own = "root" if known else "node"
    several = F.min("root") < F.max("root") if known else F.lit(True)
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"), several.alias("several")).where("n > 1 AND several").drop("several")
    dealt = (
        keyed.join(sizes, ["t", "k"])
        .withColumn("shares", F.ceil(F.col("n") / CELL))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("shares")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
        .select("t", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), own, *prints)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            node = table.column(own).to_numpy()
            least = _forest(np.stack([table.column(c).to_numpy() for c in prints], axis=1).view(np.uint64), boundaries(table, keys), radius, node if known else None)
            moved = np.flatnonzero(node != node[least])
            yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[least[moved]])], ["a", "b"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def _signed(mask: int) -> int:
    return mask - (1 << 64) * (mask >> 63)


def _with_keys(prints: DataFrame, keys: list[Column]) -> DataFrame:
    each = F.array(*[F.struct(F.lit(t).alias("t"), k.alias("k")) for t, k in enumerate(keys)])
    return prints.withColumn("_", F.explode(each)).select("_.t", "_.k", *prints.columns)


def links(prints: DataFrame, radius: int = 4, blocks: int = 6) -> DataFrame:
    """Edges (a, b) that connect all of ``prints`` (node, f0) within ``radius`` bits; none is lost.

    Of ``blocks`` blocks of bits, ``blocks - radius`` agree within the radius, so prints
    that share such a choice are compared. More blocks make longer keys and more tables:
    take 8 for some 10^10 documents.
    """
    if not 0 <= radius < blocks:
        raise ValueError("radius must be below the number of blocks")
    edge = [64 * k // blocks for k in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edge, edge[1:], strict=False)]
    masks = [sum(x) for x in combinations(block, blocks - radius)]
    return _forest_edges(_with_keys(prints, [F.col("f0").bitwiseAND(F.lit(_signed(m))) for m in masks]), 1, radius)


def wide_links(prints: DataFrame, width: int, radius: int, agree: float = AGREE, seed: int = 7) -> DataFrame:
    """Edges (a, b) that connect ``prints`` (node, f0..) that differ in at most ``radius`` bits.

    Prints that agree on some sample of bits are compared on all. The samples lengthen
    with the logarithm of the number of prints, so that chance puts about as many into a
    group as a tile of bit planes compares at once, and there are so many that a pair whose
    share of equal bits is ``agree`` is missed in 1 of 100 cases at most. What the first
    samples have linked is one root to the others, so a group of near copies has an edge a
    member and not one for each sample.
    """
    bits, rng = 64 * width, np.random.default_rng(seed)
    length = max(12, ceil(log2(max(prints.count(), 1) / 64 + 1)))
    keys = []
    for _ in range(ceil(log(0.01) / log(1 - agree**length))):
        drawn = rng.choice(bits, length, replace=False).tolist()
        masks = [sum(1 << (b % 64) for b in drawn if b // 64 == w) for w in range(width)]
        keys.append(F.xxhash64(*[F.col(f"f{w}").bitwiseAND(F.lit(_signed(m))) for w, m in enumerate(masks) if m]))
    roots = components(_forest_edges(_with_keys(prints, keys[:FIRST]), width, radius))
    rooted = settle(prints.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    further = _forest_edges(_with_keys(rooted, keys[FIRST:]), width, radius)
    return rooted.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(further)


def _alike(h: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """Least index linked with each of the sets, those of Jaccard ``similarity`` or more being linked.

    A set is compared with all before it that aren't linked with it yet, a growing number
    at a time, since in a group of copies the first one met links it.
    """
    parent, ends = np.arange(len(counts)), np.cumsum(counts)
    code = np.unique(h, return_inverse=True)[1]
    held = np.zeros(len(code) and int(code.max()) + 1, bool)
    for u in range(1, len(counts)):
        own = code[ends[u] - counts[u] : ends[u]]
        held[own] = True
        small, large = np.minimum(counts[:u], counts[u]), np.maximum(counts[:u], counts[u])
        left, take = np.flatnonzero((small >= similarity * large - 1e-9) & (small > 0)), 1
        while len(left := left[parent[left] != parent[u]]):
            v, left, take = left[:take], left[take:], take * 8
            n = counts[v]
            upto = np.cumsum(n)
            common = np.add.reduceat(held[code[np.repeat(ends[v] - upto, n) + np.arange(upto[-1])]].astype(np.int64), upto - n)
            v = v[common >= similarity * (n + counts[u] - common) - 1e-9]
            union(parent, np.full(len(v), u), v)
        held[own] = False
    return parent


def _verified(texts: DataFrame, shingle: int, similarity: float, seed: int) -> DataFrame:
    """Edges (a, b) that connect all ``texts`` (root, node, text) of equal root whose shingle sets
    have Jaccard ``similarity`` or more. A root with very many or long texts is dealt over pairs of shares."""
    keys = ["root", "i", "j"]
    load = F.ceil(F.greatest(F.count(F.lit(1)) / SHARE, F.sum(F.octet_length("text")) / SHARE_BYTES))
    large = settle(texts.groupBy("root").agg(load.alias("shares")).where("shares > 1"))
    dealt = (
        texts.join(large, "root", "left")
        .withColumn("shares", F.coalesce("shares", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("shares")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
        .select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups((x for b in batches for x in slices([b], "text")), keys, 1 << 11):
            node, cuts = table.column("node").to_numpy(), [*boundaries(table, keys).tolist(), table.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b - a > 1:
                    linked = _alike(*_as_sets(*_shingles(table.column("text").slice(a, b - a).combine_chunks(), shingle, seed)), similarity)
                    moved = np.flatnonzero(linked != np.arange(b - a))
                    yield pa.RecordBatch.from_arrays([pa.array(node[a + moved]), pa.array(node[a + linked[moved]])], ["a", "b"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, blocks: int = 6) -> DataFrame:
    """id, fingerprint (long) and component_id, the least id reachable through links.

    Equal fingerprints are linked; rows without words share fingerprint zero. Rows with a
    null id take part and return with a null id; a component of null ids has a null
    component_id. Repeated rows return as often as they occur. An empty table gives none.
    """
    rows = settle(fingerprints(docs, text, [id_col], shingle).withColumnRenamed(id_col, "_id"))
    prints = settle(rows.groupBy("f0").agg(F.min("_id").alias("least")))
    roots = components(links(prints.select(F.col("f0").alias("node"), "f0"), radius, blocks)).withColumnRenamed("node", "f0")
    placed = prints.join(roots, "f0", "left").withColumn("root", F.coalesce("root", "f0"))
    heads = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rows.join(placed.join(heads, "root").select("f0", "component_id"), "f0")
    return found.select(F.col("_id").alias(id_col), F.col("f0").alias("fingerprint"), "component_id")


def hex_of(fingerprint: Column | str) -> Column:
    """16 lower-case hex digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, width: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component of near duplicates: the one with the least id.

    Two texts are linked if the Jaccard similarity of their sets of shingles is
    ``similarity`` or more. Fingerprints of ``width`` words over the sets only find
    groups of candidates, RADIUS of their bits apart; within a group all are compared by
    their shingles. Texts without words are copies of each other, never of a text with
    words. Null ids come last; of rows with equal ids one of a component stays.
    All columns return.
    """
    taken = set(docs.columns)
    tag = next(n for n in (f"_tag{k}" for k in range(len(taken) + 1)) if n not in taken)
    rows = settle(docs.withColumn(tag, F.monotonically_increasing_id()))
    plain = rows.select(F.col(f"`{id_col}`").alias("_id"), F.col(tag).alias("_tag"), F.col(f"`{text}`").cast("string").alias("text"))
    words_of = [f"f{k}" for k in range(width)]
    made = ["_sum", *words_of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            h, n = _as_sets(*_shingles(part.column("text"), shingle, seed))
            upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h), dtype=np.uint64)])
            ends = np.cumsum(n)
            own = np.column_stack([upto[ends] - upto[ends - n], _prints(h, n, width)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(np.ascontiguousarray(own[:, k])) for k in range(width + 1))], ["_id", "_tag", *made])

    schema = plain.drop("text").withColumns({c: F.lit(0).cast("long") for c in made}).schema
    tagged = settle(plain.mapInArrow(run, schema))
    order = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_tag"))
    nodes = settle(tagged.groupBy(*made).agg(F.min(order).alias("least")).withColumn("node", F.col("least._tag")))
    groups = components(wide_links(nodes.select("node", *words_of), width, RADIUS * width // 4))
    texts = plain.join(groups.withColumnRenamed("node", "_tag"), "_tag").select("root", F.col("_tag").alias("node"), "text")
    roots = components(_verified(settle(texts), shingle, similarity, seed))
    heads = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("least").alias("least"))
    gone = tagged.select("_tag").join(heads.select("least._tag"), "_tag", "left_anti")
    return rows.join(gone.withColumnRenamed("_tag", tag), tag, "left_anti").drop(tag)
