"""Tokenizer alignment against a brute-force version that uses the tokenizer files themselves."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from cellweave.llm import alignment
from cellweave.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, "it's   a test\n\n  x", "日本語 über", "<|endoftext|> a </s> <s>", "▁x", "a▁b c", "x" * 3000, "\U0001f600‍ \x00y", "  ", " ", "12345 67'll\t\r\n", "naïve café", "the cat the cat", "<0x41> the"]


def byte_table():
    """The byte that each character of a byte-level token stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def brute(texts):
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model, of = sentencepiece.SentencePieceProcessor(model_file=PATHS[2]), byte_table()
    rows, held = [], defaultdict(set)
    for k, text in enumerate(texts):
        a = a_model.encode(" " + (text or ""), add_special_tokens=False)
        b = b_model.encode(text or "")
        a_bytes = [bytes(of[c] for c in a_model.id_to_token(i)) for i in a.ids]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_model.id_to_piece(i)]]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            rows.append(([], [], [], []))
            continue
        ends = []
        for part in (a_bytes, b_bytes):
            at, out = 0, []
            for t in part:
                at += len(t)
                out.append(at)
            ends.append(out)
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append((a.ids[i:x], b[j:y]))
            i, j = x, y
        links = [(x, y) for left, right in groups for x in left for y in right]
        for link in links:
            held[link].add(k)
        rows.append((a.ids, b, groups, links))
    count = {link: len(s) for link, s in held.items()}
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for a, b, groups, links in rows:
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if said else "", said))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(map(str, r)))


def test_equals_brute_force(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, 1, "q") for i, t in enumerate(ODD)] + [(None, "a b", 1, "q"), (13, "the cat the cat", 1, "q")], "doc_id long, text string, chunk int, pairs string").repartition(3)
    rows = docs.collect()
    want = ordered((r.doc_id, *x) for r, x in zip(rows, brute([r.text for r in rows]), strict=True))
    assert ordered(alignment.align(docs, *PATHS, with_groups=True).collect()) == want
    assert alignment.align(docs.limit(0), *PATHS).count() == 0


def test_small_memo_and_chunks_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).coalesce(1)
    rows = docs.select("doc_id", "text").collect()
    want = ordered((r.doc_id, *x[:-1]) for r, x in zip(rows, brute([r.text for r in rows]), strict=True))
    assert ordered(alignment.align(docs, *PATHS).collect()) == want
    pair = alignment._pair(*PATHS)
    texts = [r.text for r in rows]
    whole, cut = alignment.Windows(pair), alignment.Windows(pair)
    first = alignment._aligned(pair, whole, texts)[1]
    again = []
    for t in texts:
        again += alignment._aligned(pair, cut, [t])[1]
        cut.clear()
    assert first == again


def test_query_returns_every_document(spark):
    found = QUERIES["op11_alignment"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = ordered((r.doc_id, *x[:-1]) for r, x in zip(rows, brute([r.text for r in rows]), strict=True))
    assert ordered(found.collect()) == want
