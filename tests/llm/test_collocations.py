"""Collocations against a brute-force version."""

import re
from collections import Counter

import numpy as np
import pytest

from cellweave.llm import collocations
from cellweave.llm.queries import QUERIES


def brute(rows, least=10, absorbed=50, top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    found = []
    for key, a in counts.items():
        lang, words = key[0], key[1:]
        if len(words) < 2 or a < least:
            continue
        cuts = [(1000000 * a * a // (counts[lang, *words[:k]] * counts[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.append((lang, words, a, counts[lang, *words[:k]], counts[lang, *words[k:]], score))
    gone = {(x[0], part) for x in found if len(x[1]) == 3 for part in (x[1][:2], x[1][1:]) if 100 * x[2] >= absorbed * counts[x[0], *part]}
    out = []
    for lang in totals:
        own = sorted((x for x in found if x[0] == lang and (lang, x[1]) not in gone), key=lambda x: (-x[5], -x[2], " ".join(x[1]).encode()))
        out += [(lang, k + 1, " ".join(x[1]), x[2], x[3], x[4], totals[lang], x[5]) for k, x in enumerate(own[:top])]
    return sorted(out)


def corpus():
    rng = np.random.default_rng(11)
    words = ["the", "The", "New", "York", "über", "a.b", "q!", "x,", "of", "日本", "\x85", "z\n", "é", "c\td"] + [f"w{k}" for k in range(30)]
    rows = [(str(rng.choice(["en", "de"])), " ".join(rng.choice(words, int(rng.integers(0, 60)), p=None))) for _ in range(300)]
    rows += [("en", "new york city and New York City")] * 40 + [(None, "alpha beta gamma. beta gamma")] * 12 + [("und", "alpha beta")] * 3
    rows += [("fr", None), ("fr", ""), ("fr", " .\n"), ("", "a a a a a a a a a a a a a"), ("en", "long " * 20000), ("xx", "one")]
    return rows


@pytest.mark.parametrize("budget", [collocations.BUDGET, 7])
def test_equals_brute_force(spark, budget):
    rows = corpus()
    docs = spark.createDataFrame([(i, x, t, 1) for i, (x, t) in enumerate(rows)], "doc_id long, lang string, text string, name int").repartition(6)
    assert sorted(map(tuple, collocations.collocations(docs, budget=budget).collect())) == brute(rows)


def test_top_and_limits(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, collocations.collocations(docs, least=3, absorbed=80, top=5).collect())) == brute(rows, 3, 80, 5)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_names_that_clash_are_drawn_anew(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "a b a b")] * 6, "lang string, text string")
    drawn, plain = [], collocations.word_counts

    def clashing(docs, lang, text, seed):
        drawn.append(seed)
        found = plain(docs, lang, text, seed)
        return found.selectExpr("lang", "word", "1L AS name", "n") if seed == 0 else found

    monkeypatch.setattr(collocations, "word_counts", clashing)
    assert [tuple(r)[2:5] for r in collocations.collocations(docs).collect()] == [("a b", 12, 12)] and drawn == [0, 1]


def test_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_001, 4_000_000_000_003, 5_000_000_000_009
    frame = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    from pyspark.sql import functions as F

    got = frame.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 1000000 * a * a // (left * right)


def test_full_bins_are_dealt_over_groups():
    groups = collocations.Groups(np.array([1, 5, 9]), np.array([3, 100, 4]), 10)
    assert groups.width[5] == 10 and groups.base[1] == 0 and groups.base[5] == 1 and groups.base[9] == 11


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text").collect()]
    found = QUERIES["op13_collocations"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows)
