"""The corpus pipeline: each stage against a brute-force version of it on the stage's own input."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from .test_tokens import brute_chunks
from cellweave.session import settle

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark):
    """Each stage's input and result, by name."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = settle(stage(spark, docs, FOLDER))
        out[name] = docs.collect(), done.collect(), docs.columns, done.columns
        docs = done
    return out


def test_columns_stay(steps):
    for name, (_, _, before, after) in steps.items():
        assert after == before or name == "packing"


def test_quality_stage_keeps_clean_documents(spark, steps):
    before, after, _, _ = steps["quality_classifier"]
    rows = {r.doc_id: r for r in before}
    assert all(rows[r.doc_id] == r for r in after)
    kept = {r.doc_id for r in after}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    clean = [r.doc_id in kept for r in labels if r.quality == 1]
    junk = [r.doc_id in kept for r in labels if r.quality == 0]
    assert np.mean(clean) > 0.95 and (not junk or np.mean(junk) < 0.5)


def test_line_stage(steps):
    before, after, _, _ = steps["line_dedup"]
    want = brute_chunks(sorted((r.doc_id, r.text) for r in before))
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)


def test_near_duplicate_stage(steps):
    before, after, _, _ = steps["simhash_near_dedup"]

    def shingles(text):
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text).split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    kept = {r.doc_id for r in after}
    sets = {r.doc_id: shingles(r.text) for r in before}
    alike = lambda a, b: len(a & b) / len(a | b)
    ids = sorted(sets)
    near = [(i, j) for k, i in enumerate(ids) for j in ids[:k] if alike(sets[i], sets[j]) >= 0.85]
    both = [(i, j) for i, j in near if i in kept and j in kept]
    assert len(both) <= 0.03 * len(near)
    for i in set(ids) - kept:
        assert max(alike(sets[i], sets[j]) for j in ids if j != i) > 0.5


def test_substring_stage(steps):
    before, after, _, _ = steps["substring_dedup"]
    words = {r.doc_id: WORD.findall(r.text) for r in before}
    count = Counter(tuple(w[k : k + 35]) for w in words.values() for k in range(len(w) - 34))
    old = {r.doc_id: r.text for r in before}
    for r in after:
        w = words[r.doc_id]
        gone = {j for k in range(len(w) - 34) if count[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        assert WORD.findall(r.text) == [x for j, x in enumerate(w) if j not in gone]
        assert gone or r.text == old[r.doc_id]


def test_packing_stage(steps):
    before, after, _, _ = steps["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    held = {}
    for r in sorted(after, key=lambda r: (r.doc_id, r.start)):
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        held.setdefault(r.doc_id, []).extend(r.ids)
    assert held == {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 0] for r in before}


def test_stages_take_odd_tables(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, None, None, None, None, "x"), (None, "a b c", "en", "s", 5, None), (2, "", "en", "s", 0, "y"), (2, "", "en", "s", 0, "y"), (3, long, None, "s", 1, "z"), (3, long, None, "s", 1, "z"), (4, "the cat\n" * 50, "xx", None, None, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _id string").withColumn("f0", F.lit(1)).withColumn("perplexity", F.lit("p"))
    for table in (settle(docs), settle(docs.limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            done = stage(spark, table, FOLDER)
            assert name == "packing" or done.columns == docs.columns
            n = len(done.collect())
            assert n >= 3 if table.count() else n == 0
