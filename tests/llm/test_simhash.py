"""SimHash against a brute-force version."""

import re

import numpy as np
import pytest
import xxhash

from cellweave.llm import simhash


def brute(rows):
    prints = []
    for _, text in rows:
        words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0)
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {c: min((rows[i][0] for i in range(len(rows)) if label[i] == c and rows[i][0] is not None), default=None) for c in label}
    return sorted(((r[0], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, label, strict=True)), key=str)


def corpus():
    rng = np.random.default_rng(3)
    vocab = ["Über", "the", "A", "b c", "x y", "Ünit", "k", "réd", "ON", "of"] + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(rng.choice(vocab, rng.integers(1, 300)))
        rows.append((3 * i + 5, "  ".join(words)))
        for _ in range(rng.integers(0, 4)):
            copy = list(words)
            copy[rng.integers(0, len(copy))] = "zz"
            rows.append((1000 - len(rows), "\n".join(copy)))
    rows += [(None, "the a of"), (4000, "the a of"), (4001, None), (4002, ""), (4003, " \t\n"), (4003, " \t\n"), (4004, "x " * 30000)]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, f0 int, component_id int").repartition(7)
    found = simhash.near_duplicates(docs)
    got = sorted(((r[0], r[1], r[2]) for r in found.select("doc_id", simhash.hex_of("fingerprint"), "component_id").collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("cell", [8, 4096])
def test_hot_key_is_dealt(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    base = 0x123456789ABCDEF0
    near = sorted({base ^ (1 << a) ^ (1 << b) for a in range(8) for b in range(8, 16)})
    prints = spark.createDataFrame([(p,) for p in near], "f0 long").selectExpr("f0 AS node", "f0")
    edges = {(r.a, r.b) for r in simhash.links(prints).collect()}
    label = {p: p for p in near}
    for a, b in edges:
        old, new = label[a], label[b]
        label = {k: new if v == old else v for k, v in label.items()}
    assert len(set(label.values())) == 1 and all((a ^ b).bit_count() <= 4 or cell for a, b in edges)


def test_empty_and_keep_one(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    words = [f"w{i}" for i in range(200)]
    near = " ".join([*words[:120], "zz", *words[121:]])
    rows = [(7, " ".join(words), "a"), (3, near, "b"), (9, " ".join(reversed(words)), "c"), (None, near, "d"), (3, near, "e"), (11, None, None)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, _tag0 string"))
    assert kept.columns == ["doc_id", "text", "_tag0"]
    assert sorted(r.doc_id for r in kept.collect()) == [3, 9, 11]
    assert simhash.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def alike(a, b, n=5):
    sets = [{tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_keep_one_at_the_bound(spark):
    """Pairs just below Jaccard 0.8 stay whole, pairs at 0.8 or just above lose one side."""
    rng, rows, want = np.random.default_rng(8), [], {True: 0, False: 0}
    for k in range(300):
        n = int(rng.integers(6, 400))
        words = [f"p{k}w{i}" for i in range(n)]
        tail = int(rng.integers(0, 1 + n // 3))
        pair = " ".join(words), " ".join([*words[: n - tail], *(f"q{k}w{i}" for i in range(tail))])
        if 0.55 <= (j := alike(*pair)) < 1:
            want[j >= 0.8] += 1
            rows += [(2 * len(rows), pair[0], j >= 0.8), (2 * len(rows) + 1, pair[1], j >= 0.8)]
    rows += [(10**6 + k, " ".join(f"s{k}w{i}" for i in range(8 + d)), True) for k in range(0, 200, 2) for d in (0, 1)]
    assert all(alike(a[1], b[1]) == 0.8 for a, b in zip(rows[-200::2], rows[-199::2]))
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, near boolean").repartition(5)).collect()
    assert want[True] > 50 and want[False] > 50
    assert sum(not r.near for r in kept) == 2 * want[False]
    assert sum(r.near for r in kept) <= 1.05 * (want[True] + 100)


@pytest.mark.parametrize("share", [3, 2048])
def test_group_is_dealt_over_shares(spark, monkeypatch, share):
    monkeypatch.setattr(simhash, "SHARE", share)
    words = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join([*words[:k], f"z{k}", *words[k + 1 :]])) for k in range(20, 60)]
    assert [r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [20]


def test_texts_without_words_drop_no_others(spark):
    rows = [(1, ""), (2, None), (3, " \n")] + [(10 + k, " ".join(f"e{k}w{i}" for i in range(6))) for k in range(400)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [1, *range(10, 410)]


def test_group_of_near_copies_has_an_edge_a_member(spark):
    """Pipeline of round 3: not an edge for each of the samples of bits that two members agree on."""
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2, (60, 256))
    bits = np.concatenate([centre[0] ^ (rng.random((300, 256)) < 0.05), centre[1:] ^ 0])
    prints = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view(np.int64)
    rows = spark.createDataFrame([(k, *map(int, p)) for k, p in enumerate(prints)], "node long, f0 long, f1 long, f2 long, f3 long")
    edges = [r for r in simhash.wide_links(rows, 4, simhash.RADIUS).collect() if r.a != r.b]
    assert len(edges) <= 450
    parent = list(range(len(prints)))
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert parent == [0] * 300 + list(range(300, len(prints)))
