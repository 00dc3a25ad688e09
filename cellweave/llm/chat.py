"""Conversations as budgeted training windows: turn-aligned spans, system turn, limited history, loss spans."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.text import slices, whole_groups
from cellweave.session import settle

BUDGET, HISTORY, RESERVE = 2048, 256, 256
SLICE = 1 << 20
BLOCK = 1024
#: What opens and closes a turn of each role; any other role is spelt out.
MARKS = {"user": ("[INST] ", " [/INST]\n"), "assistant": ("<s> ", " </s>\n"), "system": ("<<SYS>> ", " <</SYS>>\n")}
OPEN_ROLE, CLOSE_ROLE, CLOSE_OTHER = "[ROLE] ", " [/ROLE] ", " </s>\n"
_CONTROL = re.compile(r"<(\\*)(?=/?s>|</?SYS>>)|\[(\\*)(?=/?(?:INST|ROLE)\])")
_TURN = re.compile(r"(?:(\[INST\]|<s>|<<SYS>>)|\[ROLE\] (.*?) \[/ROLE\]) (.*?) (?:\[/INST\]|</s>|<</SYS>>)\n", re.DOTALL)
_ROLE_OF = {opened.strip(): role for role, (opened, _) in MARKS.items()}


def escape(text: str) -> str:
    """The text with a backslash more behind the first sign of every control string, and of every escaped one."""
    return _CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """What ``escape`` was given."""
    return _CONTROL.sub(lambda m: m[0][:-1] if len(m[0]) > 1 else m[0], text)


def formatted(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A turn by the template, with the start and length of its text there."""
    if role in MARKS:
        opened, closed = MARKS[role]
    else:
        opened, closed = f"{OPEN_ROLE}{escape(role or '')}{CLOSE_ROLE}", CLOSE_OTHER
    body = escape(text or "")
    return f"{opened}{body}{closed}", len(opened), len(body)


def parsed(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted window."""
    return [(_ROLE_OF[m[1]] if m[1] else unescape(m[2]), unescape(m[3])) for m in _TURN.finditer(text)]


@lru_cache(maxsize=2)
def _encoding(ranks: str, pattern: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _spans(turns: list[dict], slice_no: int, room: int) -> list[list[dict]]:
    """A slice's turns as spans of at most ``room`` tokens, or of one turn: what crosses the slice's end is
    the last turn, which stays with the others if they fit together."""
    if len(turns) > 1 and turns[-1]["end"] > (slice_no + 1) * room and turns[-1]["end"] - turns[0]["start"] > room:
        return [turns[:-1], turns[-1:]]
    return [turns]


def _window(span: list[dict], before: list[dict], system: dict | None, budget: int, history: int) -> tuple:
    """(window_start, text, spans, n_tokens, n_repeated, over_budget) of one span after the turns before it."""
    at = span[0]["start"]
    repeated = [t for t in before if t["start"] >= at - history and t["end"] <= at and not (system and t["start"] == 0)]
    total = sum(t["tokens"] for t in span) + (system["tokens"] if system and at else 0) + sum(t["tokens"] for t in repeated)
    while repeated and total > budget:
        total -= repeated.pop(0)["tokens"]
    head = ([system] if system and at else []) + repeated
    text, spans, size = [], [], 0
    for k, turn in enumerate(head + span):
        if k >= len(head) and turn["role"] == "assistant":
            spans.append({"start": size + turn["body"], "length": turn["body_length"]})
        text.append(turn["turn_text"])
        size += len(turn["turn_text"])
    return at, "".join(text), spans, total, len(head), total > budget


def windows(rows: DataFrame, ranks: str, pattern: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", budget: int = BUDGET, history: int = HISTORY, reserve: int = RESERVE) -> DataFrame:
    """conv, window_start, text, spans, n_tokens, n_repeated and over_budget of every training window.

    Turns are formatted, escaped and tokenised each on its own, so a window's tokens are the
    sum of its turns'. Prefix sums of the tokens of a conversation cut it into spans that
    begin and end with turns and have at most ``budget - history - reserve`` new tokens. A
    window is a span behind the system turn (the first turn, if it is one and has at most
    ``reserve`` tokens; a longer one is a turn like others) and behind the turns that end
    where the span begins, of ``history`` tokens at most. ``spans`` are the code points of
    the window's own assistant texts; repeated turns (``n_repeated``, at the front) are under
    no span, so each assistant text is a target once. A turn that alone exceeds the room
    is a span of its own, whole; if the budget is passed, it gives up its history and
    is marked ``over_budget``.

    Rows are range-partitioned by conversation and turn, so a conversation of any length
    spreads over many tasks; sums of earlier partitions shift the later ones. Windows are
    made of slices of the prefix sums, which tokens bound.

    Null texts are empty ones, null roles empty names; a null conv is a conversation of its
    own; null turns come first; equal turns follow by role and hash of the text; repeated
    rows are turns each; an empty table gives none.
    """
    room = budget - history - reserve
    if min(room, history, reserve) < 0 or history > room or not room:
        raise ValueError("the budget must leave new tokens at least as much room as history")
    key = F.coalesce(F.col(f"`{conv}`").cast("string"), F.lit(""))
    body, name = F.col(f"`{text}`").cast("string"), F.col(f"`{role}`").cast("string")
    raw = rows.select(F.col(f"`{conv}`").isNull().alias("none"), key.alias("key"), F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), name.alias("role"), body.alias("body"))
    sort = ["none", "key", "turn", "role", "print", "row"]
    sorted_rows = raw.withColumns({"print": F.xxhash64("body"), "row": F.monotonically_increasing_id()}).repartitionByRange(*sort).sortWithinPartitions(*sort).select("none", "key", "conv", "role", "body")
    made = "none boolean, key string, role string, turn_text string, body int, body_length int, tokens long, part int, before long"
    schema = raw.select("conv").schema.simpleString()[7:-1].replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part_id, last, before = _encoding(ranks, pattern).encode_ordinary, TaskContext.get().partitionId(), None, 0
        for batch in slices(batches, "body", SLICE):
            out = []
            for none, key, role, text in zip(*(batch.column(c).to_pylist() for c in ("none", "key", "role", "body")), strict=True):
                if (none, key) != last:
                    last, before = (none, key), 0
                turn_text, start, length = formatted(role, text)
                tokens = len(encode(turn_text))
                out.append((role, turn_text, start, length, tokens, part_id, before))
                before += tokens
            cols = list(zip(*out, strict=True))
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("none"), batch.column("key"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), batch.column("conv")], [x.split()[0] for x in made.split(", ")] + ["conv"])

    turns = settle(sorted_rows.mapInArrow(run, f"{made}, {schema}"))
    totals = turns.groupBy("none", "key", "part").agg(F.sum("tokens").alias("total"))
    earlier = Window.partitionBy("none", "key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only a partition's first conversation can have begun in an earlier one: a row per partition at most.
    shift = settle(totals.withColumn("shift", F.sum("total").over(earlier)).where("shift > 0").select("none", "key", "part", "shift"))
    placed = turns.join(F.broadcast(shift), ["none", "key", "part"], "left").withColumn("start", F.col("before") + F.coalesce("shift", F.lit(0))).drop("before", "shift", "part")
    placed = placed.withColumns({"end": F.col("start") + F.col("tokens"), "slice": F.expr(f"start div {room}")})
    next_begin = (F.col("slice") + 1) * room
    copied = (F.col("tokens") <= history) & (F.col("start") >= next_begin - history)
    kinds = F.when(copied, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(1)))
    own = placed.withColumn("kind", F.explode(kinds)).withColumn("slice", F.when(F.col("kind") == 1, F.col("slice")).otherwise(F.col("slice") + 1))
    last = placed.groupBy("none", "key").agg(F.max("slice").alias("last")).where("last > 0")
    system = placed.where((F.col("start") == 0) & (F.col("role") == "system") & (F.col("tokens") <= reserve)).join(last, ["none", "key"])
    # A long conversation's copies of its system turn are made by many tasks.
    blocks = system.withColumn("block", F.explode(F.expr(f"sequence(0, last div {BLOCK})"))).repartition("none", "key", "block")
    ends = F.expr(f"sequence(greatest(1, block * {BLOCK}), least(last, block * {BLOCK} + {BLOCK - 1}))")
    copies = blocks.withColumn("slice", F.explode(ends)).withColumn("kind", F.lit(2)).select(*own.columns)
    grouped = own.unionByName(copies).repartition("none", "key", "slice").sortWithinPartitions("none", "key", "slice", "kind", "start")
    out = "window_start long, text string, spans array<struct<start: int, length: int>>, n_tokens long, n_repeated int, over_budget boolean"
    columns = ("role", "turn_text", "body", "body_length", "tokens", "start", "end", "kind", "slice")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups((b for batch in batches for b in slices([batch], "turn_text", SLICE)), ["none", "key", "slice"], rows=4096):
            convs, done = [], []
            plain = table.select(columns).to_pylist()
            groups: list[tuple[int, list[dict]]] = []
            nones, keys = table.column("none").to_pylist(), table.column("key").to_pylist()
            for k, t in enumerate(plain):
                if not k or (nones[k], keys[k], t["slice"]) != (nones[k - 1], keys[k - 1], plain[k - 1]["slice"]):
                    groups.append((k, []))
                groups[-1][1].append(t)
            for first, group in groups:
                new = [t for t in group if t["kind"] == 1]
                if not new:
                    continue
                system = next((t for t in group if t["kind"] == 2), None)
                if new[0]["start"] == 0 and new[0]["role"] == "system" and new[0]["tokens"] <= reserve:
                    system = new[0]
                before = [t for t in group if t["kind"] == 0] + new
                for span in _spans(new, new[0]["slice"], room):
                    convs.append(first)
                    done.append(_window(span, before, system, budget, history))
            cols = list(zip(*done, strict=True)) or [[]] * 6
            types = (pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])), pa.int64(), pa.int32(), pa.bool_())
            conv_col = table.column("conv").combine_chunks().take(pa.array(convs, pa.int64()))
            yield pa.RecordBatch.from_arrays([conv_col, *(pa.array(list(c), t) for c, t in zip(cols, types, strict=True))], ["conv", "window_start", "text", "spans", "n_tokens", "n_repeated", "over_budget"])

    return grouped.mapInArrow(assemble, f"{schema}, {out}").withColumnRenamed("conv", conv)


def digests(found: DataFrame, conv: str = "conv_id") -> DataFrame:
    """conv, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from windows.

    A conversation's windows stream by in order and are hashed as they come, so none is held whole.
    """
    key = F.coalesce(F.col(f"`{conv}`").cast("string"), F.lit(""))
    rows = found.select(F.col(f"`{conv}`").isNull().alias("none"), key.alias("key"), F.col(f"`{conv}`").alias("conv"), "window_start", "text", "spans", "n_repeated")
    ordered = rows.repartition("none", "key").sortWithinPartitions("none", "key", "window_start")
    schema = rows.select("conv").schema.simpleString()[7:-1].replace(":", " ", 1)
    out = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, kind = None, None, None

        def row() -> pa.RecordBatch:
            conv_value, turns, loss, n_turns, loss_chars, chars = state
            return pa.RecordBatch.from_arrays([conv_value, *(pa.array([x]) for x in (n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))], ["conv", *(x.split()[0] for x in out.split(", "))])

        for batch in slices(batches, "text", SLICE):
            done = []
            for k, (none, key, text, spans, repeated) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("none", "key", "text", "spans", "n_repeated")), strict=True)):
                if (none, key) != last:
                    if state:
                        done.append(row())
                    last, state = (none, key), [batch.column("conv").slice(k, 1), hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                for role, body in parsed(text)[repeated:]:
                    state[1].update(f"{role}\n{body}\n".encode())
                    state[3] += 1
                for span in spans:
                    body = unescape(text[span["start"] : span["start"] + span["length"]])
                    state[2].update(body.encode())
                    state[4] += len(body)
                state[5] += len(text)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if state:
            yield row()

    return ordered.mapInArrow(run, f"{schema}, {out}").withColumnRenamed("conv", conv)
