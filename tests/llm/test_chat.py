"""Conversation windows: exact round trips, budgets, history and masks."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cellweave.llm import chat
from cellweave.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "\\", "<", "[", "/", "s>", " ", "\n", "x", "INST]"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(CONTROL), max_size=12).map("".join), st.lists(st.sampled_from(CONTROL), max_size=6).map("".join))
def test_turns_survive(text, role):
    assert chat.unescape(chat.escape(text)) == text
    turns = [("user", text), (role, text), ("assistant", text), ("system", text), (role, "")]
    assert chat.parsed("".join(chat.formatted(*t)[0] for t in turns)) == turns
    whole, at, size = chat.formatted("assistant", text)
    assert chat.unescape(whole[at : at + size]) == text


def corpus():
    rng = np.random.default_rng(5)
    words = ["the", "cat", "über", "[INST]", "</s>", "<s>", "日本", "\\", "<<SYS>>"]
    rows = []
    for conv in range(40):
        n = int(rng.integers(1, 9)) if conv % 10 else 150
        for turn in range(n):
            role = "system" if turn == 0 and conv % 3 == 0 else ["user", "assistant", "tool"][int(rng.integers(0, 3))]
            size = int(rng.integers(0, 30)) if rng.random() < 0.97 else 400
            rows.append((conv, turn, role, " ".join(rng.choice(words, size))))
    rows += [(None, 0, "user", "a"), (None, 1, None, None), (None, None, "assistant", "first"), (77, 3, "assistant", "same"), (77, 3, "assistant", "same"), (78, 0, "system", "s " * 300), (78, 1, "assistant", "")]
    return rows


def expected(rows):
    """Turn and loss digests of each conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(*r, "c", 5) for r in corpus()]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string, start int").repartition(5)


@pytest.mark.parametrize("budget,history,reserve", [(2048, 256, 256), (120, 30, 20), (64, 16, 16), (16, 0, 0)])
def test_read_back(spark, frame, budget, history, reserve):
    found = chat.windows(frame, RANKS, PATTERN, budget=budget, history=history, reserve=reserve)
    got = {r[0]: tuple(r)[1:5] for r in chat.digests(found).collect()}
    assert got == expected(corpus())


def test_windows_by_rule(spark, frame):
    budget, history, reserve = 120, 30, 20
    room = budget - history - reserve
    with open(RANKS, "rb") as lines:
        import base64

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    count = lambda s: len(tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(s))
    found = chat.windows(frame, RANKS, PATTERN, budget=budget, history=history, reserve=reserve).collect()
    rows = corpus()
    for conv in range(40):
        own = [(r[2], r[3]) for r in rows if r[0] == conv]
        sizes = [count(chat.formatted(*t)[0]) for t in own]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        place = {int(s): k for k, s in enumerate(starts[:-1])}
        mine = sorted((w for w in found if w.conv_id == conv), key=lambda w: w.window_start)
        firsts = [place[w.window_start] for w in mine]
        assert firsts[0] == 0
        for w, first, upto in zip(mine, firsts, [*firsts[1:], len(own)], strict=True):
            turns, new = chat.parsed(w.text), own[first:upto]
            assert turns[w.n_repeated :] == new
            assert sum(sizes[first:upto]) <= room or upto - first == 1
            repeated = turns[: w.n_repeated]
            kept_system = own[0][0] == "system" and sizes[0] <= reserve and first > 0
            assert not kept_system or repeated[0] == own[0]
            back = repeated[1:] if kept_system else repeated
            fits = [k for k in range(first) if starts[k] >= starts[first] - history and not (kept_system and k == 0)]
            assert back == own[first - len(back) : first] and (len(back) == len(fits) or sizes[first] > room)
            assert w.n_tokens == sum(sizes[first:upto]) + sum(sizes[first - len(back) : first]) + (sizes[0] if kept_system else 0)
            assert w.over_budget == (w.n_tokens > budget) and (w.n_tokens <= budget or upto - first == 1)
            assert [chat.unescape(w.text[s.start : s.start + s.length]) for s in w.spans] == [t for r, t in new if r == "assistant"]


def test_one_conversation_over_many_partitions(spark):
    rows = [(1, k, "system" if k == 0 else ["user", "assistant"][k % 2], f"turn {k} " * (k % 7)) for k in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = chat.windows(frame, RANKS, PATTERN, budget=200, history=40, reserve=40)
        got = {r[0]: tuple(r)[1:5] for r in chat.digests(found).collect()}
        assert got == expected(rows) and found.where("NOT over_budget AND window_start > 0 AND text NOT LIKE '<<SYS>> %'").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table_and_bad_budget(spark, frame):
    assert chat.digests(chat.windows(frame.limit(0), RANKS, PATTERN)).count() == 0
    with pytest.raises(ValueError):
        chat.windows(frame, RANKS, PATTERN, budget=100, history=90, reserve=5)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    found = QUERIES["op12_chat"](spark, folder)
    assert found.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    done = found.collect()
    assert {r[0]: tuple(r)[1:5] for r in done} == expected(rows) and len(done) == len({r[0] for r in rows})
