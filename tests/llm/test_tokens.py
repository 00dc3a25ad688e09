"""BPE against the public library, packing by round trip, vectors and repeats by brute force."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellweave.llm import bpe, line_chunks, packing, recompression, vectors

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", None, "it's   a test\n\n  x", "日本語 über", "<|endoftext|> a", "\x1c\x85\xa0 x", "a" * 20000, "\U0001f600‍", "  ", "12345 67'll"]


@pytest.fixture(scope="module")
def library():
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_bpe_equals_library(library, text):
    own = bpe.codec(RANKS, public_tokenizers.PATTERN)
    ids = next(iter(own.encode([text])))
    assert ids == library.encode_ordinary(text) and own.decode(ids).decode() == text


def test_perfect_hash_is_minimal():
    own = bpe.codec(RANKS, public_tokenizers.PATTERN).tokens
    assert sorted(own.key_at.tolist()) == list(range(own.n))
    assert own.find(own.keys[::997]).tolist() == list(range(0, own.n, 997)) and own.find([b"no such token"]).tolist() == [-1]
    assert bpe.PerfectHash([]).find([b"x"]).tolist() == [-1]


def test_bpe_frames(spark, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a b", "y"), (1, "a", "z")], "doc_id long, text string, _text string")
    got = bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = [(r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted([(i, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(b).hexdigest()) for i, x, b in want], key=key)
    back = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert all(bytes(r.bytes) == (r.text or "").encode() for r in back.collect())
    assert bpe.digests(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


@given(st.integers(0, 5000))
def test_piece_lengths(n):
    pieces = packing.lengths(n, 1024)
    assert sum(s for s, _ in pieces) == n and all(0 < s <= 1024 // k for s, k in pieces)


def test_packing_round_trip(spark):
    rng = np.random.default_rng(1)
    texts = ODD + [" ".join(rng.choice(["alpha", "beta", "gam", "ü"], rng.integers(1, 3000))) for _ in range(120)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, length int").repartition(5)
    got = packing.pack(docs, JSON, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(JSON)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        want, at = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            own = want[at : at + r.length]
            assert r.start == at and r.ids == own and r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) and r.doc_tokens == len(want)
            at += r.length
        assert at == len(want)
    padding = total = 0
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        total += at
        padding += 1024 - at
    assert padding < 0.03 * total
    assert packing.pack(docs.limit(0), JSON, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("cell", [16, 2048])
def test_vectors(spark, monkeypatch, cell):
    monkeypatch.setattr(vectors, "CELL", cell)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    rows = [(int(i), (base[i % 40] + 0.08 * rng.normal(size=16) * (i % 5)).tolist()) for i in rng.permutation(600)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [None] + [1.0] * 15), (1004, []), (1005, [1.0, 2.0]), (None, base[0].tolist()), (1006, [float("inf")] * 16)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit(1)).withColumn("n", F.lit("z"))
    got = vectors.near_vectors(docs, recall=0.9999).collect()
    full = [(i, np.array(v)) for i, v in rows if v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    x = np.stack([v for _, v in full])
    x /= np.sqrt((x * x).sum(1))[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    heads = {c: min(i for (i, _), d in zip(full, label, strict=True) if d == c and i is not None) for c in set(label)}
    want = {i: (int(near[k].sum()), heads[label[k]]) for k, (i, _) in enumerate(full)}
    for r in got:
        links, head = want.get(r.vec_id, (0, r.vec_id))
        assert (r.n_links, r.component_id, r.kept) == (links, head, r.vec_id == head)
    assert len(got) == len(rows) and vectors.near_vectors(docs.limit(0)).count() == 0


def test_repeats(spark):
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(400)]
    passages = [list(rng.choice(vocab, n)) for n in (34, 35, 36, 60, 200)]
    rows = []
    for i in range(80):
        words = list(rng.choice(vocab, rng.integers(0, 150)))
        for _ in range(rng.integers(0, 3)):
            at = rng.integers(0, len(words) + 1)
            words[at:at] = passages[rng.integers(0, 5)]
        rows.append((i, " \n".join(words)))
    rows += [(100, "z " * 120), (101, "ab ba " * 60), (102, None), (103, ""), (104, " ".join(passages[4][:40])), (105, " ".join(passages[4][:40])), (None, "q " * 10), (106, "z " * 36 + "tail"), (107, "z " * 35 + "end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("chunk", F.lit("c")).withColumn("kept_text", F.lit(1)).repartition(6)
    words = [WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    want = {}
    for (i, _), w in zip(rows, words, strict=True):
        gone = {j for k in range(len(w) - 34) if count[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        want[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    for size in (300, 1 << 20):
        got = recompression.remove_repeats(docs, chunk_bytes=size).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in got} == want and len(got) == len(rows)
    kept = recompression.remove_repeats(docs, keep=["doc_id", "text", "chunk"], layout=True).where("n_removed = 0 AND text IS NOT NULL")
    assert kept.where("kept_text <> text").count() == 0
    assert recompression.remove_repeats(docs.limit(0)).count() == 0


def brute_chunks(rows, spread=4):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    chunks = []
    for i, text in rows:
        if text is None:
            continue
        lines, own = text.split("\n"), []
        for k, line in enumerate(lines):
            own.append(line)
            if k == len(lines) - 1 or md5((md5(lines[k - 1]) if k else "") + md5(line))[:2] < f"{256 // spread:02x}":
                chunks.append((i, "\n".join(own), sum(bool(x.strip(" \t\r\f\v")) for x in own) > 1))
                own = []
    seen, left = set(), defaultdict(list)
    for i, part, multi in chunks:
        if not multi or part not in seen:
            left[i].append(part)
        seen.add(part)
    return {i: None if t is None else "\n".join(left[i]) for i, t in rows}


def test_line_chunks(spark):
    rng = np.random.default_rng(6)
    lines = [f"line {i}" for i in range(60)] + ["", " ", "\t"]
    rows = [(i, "\n".join(rng.choice(lines, rng.integers(0, 25)))) for i in range(60)]
    rows += [(60 + i, "\n".join([f"head {i}", *lines[:40]])) for i in range(20)] + [(100, None), (101, ""), (102, "\n\n"), (103, "x\n" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_lines", F.lit(1)).withColumn("_held", F.lit("h")).withColumn("_id", F.lit(2)).repartition(4)
    got = line_chunks.remove_repeated(docs)
    assert got.columns == docs.columns and {r.doc_id: r.text for r in got.collect()} == brute_chunks(rows)
    twice = spark.createDataFrame([(1, "a\nb\nc\nd\ne\nf"), (1, "a\nb\nc\nd\ne\nf"), (None, "a\nb\nc\nd\ne\nf")], "doc_id long, text string")
    assert len({r.text for r in line_chunks.remove_repeated(twice).where("doc_id = 1").collect()}) == 1
    assert line_chunks.remove_repeated(docs.limit(0)).count() == 0


def brute_passages(rows):
    solid = lambda x: bool(x.strip(" \t\r\f\v"))
    seen, left = set(), {}
    for i, text in rows:
        lines = [] if text is None else text.split("\n")
        full, gone = [k for k, x in enumerate(lines) if solid(x)], set()
        for a, b in zip(full, full[1:], strict=False):
            if (lines[a], lines[b]) in seen:
                gone.update(range(a, b + 1))
            seen.add((lines[a], lines[b]))
        left[i] = None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return left


def test_line_passages(spark):
    rng = np.random.default_rng(6)
    lines = [f"line {i}" for i in range(60)] + ["", " ", "\t"]
    rows = [(i, "\n".join(rng.choice(lines, rng.integers(0, 25)))) for i in range(60)]
    rows += [(60 + i, "\n".join([f"head {i}", "short", "passage", f"tail {i}"])) for i in range(20)]
    rows += [(90, "c\nd\ne"), (91, "c\nd\ne"), (100, None), (101, ""), (102, "\n\n"), (103, "x\n" * 3000), (104, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_lines", F.lit(1)).withColumn("_gone", F.lit("h")).repartition(4)
    done = line_chunks.remove_passages(docs)
    got = {r.doc_id: r.text for r in done.collect()}
    assert done.columns == docs.columns and got == brute_passages(rows)
    assert all(got[60 + i] == f"head {i}\ntail {i}" for i in range(1, 20)) and got[91] == ""
    assert line_chunks.remove_passages(docs.limit(0)).count() == 0
