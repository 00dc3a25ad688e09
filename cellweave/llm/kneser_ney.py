"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.ppm import BITS, END, grams
from cellweave.llm.sets import names_of
from cellweave.llm.text import Tokens, slices
from cellweave.operators.sizing import join_small
from cellweave.session import settle

ORDER = 4
TRUSTED_DOCS = 6000
TRUSTED_BYTES = 32 << 20
TRUSTED_TEXT_BYTES = 1 << 20
SLICE = 1 << 20
SHARDS = 8


def _trusted(labels: DataFrame, id_col: str, quality: str, fold: int) -> DataFrame:
    """Ids labelled 1: of fold 0, from which the model learns, or of fold 1, which sets the thresholds."""
    ids = labels.where(F.col(quality) == 1).select(F.col(id_col).alias("_id")).distinct()
    return ids.where(F.pmod(F.xxhash64(F.lit("fold"), "_id"), F.lit(2)) == fold)


def trusted_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", quality: str = "quality", max_docs: int = TRUSTED_DOCS, max_bytes: int = TRUSTED_BYTES, max_text: int = TRUSTED_TEXT_BYTES) -> DataFrame:
    """(_id, _text) of trusted texts of the first fold, by hash of the id, within all bounds.

    Texts of over ``max_text`` bytes, or over ``max_bytes``, are left out before the sum, so a
    long one can't shut out the rest. Raises if that leaves none of the trusted texts.
    """
    good = _trusted(labels, id_col, quality, 0)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text")).where("_id IS NOT NULL AND _text <> ''")
    sizes = texts.select("_id", F.octet_length("_text").alias("_size"), F.xxhash64("_id").alias("_at"))
    trusted = sizes.join(good, "_id", "left_semi")
    drawn = trusted.where(F.col("_size") <= min(max_text, max_bytes)).orderBy("_at", "_id", "_size").limit(max_docs)
    upto = F.sum("_size").over(Window.orderBy("_at", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0))
    ids = settle(drawn.withColumn("_upto", upto).where(F.col("_upto") <= max_bytes).select("_id").distinct())
    if ids.isEmpty() and not trusted.isEmpty():
        raise ValueError(f"every trusted text exceeds {min(max_text, max_bytes)} bytes")
    return texts.join(F.broadcast(ids), "_id")


def train(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(size, gram, logp, backoff): natural-log probability of a gram's last symbol after the others, and the
    log weight that the gram, as a context, gives to shorter ones (null where it never is one).

    Counts of the longest grams are occurrences, those of shorter ones the number of
    different symbols before them. Discounts for counts 1, 2 and 3 or more come from the
    counts of counts of each size. All sums and joins are sharded by gram or context.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", SLICE):
            keys, n = np.unique(grams(Tokens(part.column("_text")), order)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["gram", "n"])

    nodes = settle(texts.select("_text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    sizes: list[DataFrame] = [nodes]
    for size in range(order, 0, -1):
        tail = F.col("gram").bitwiseAND(F.lit((1 << (BITS * size)) - 1))
        sizes.append(settle(sizes[-1].groupBy(tail.alias("gram")).agg(F.count(F.lit(1)).alias("n"))))
    lower, out = None, []
    for size, counted in zip(range(1, order + 2), sizes[::-1], strict=True):
        n1, n2, n3, n4 = (max(x or 0, 0) for x in counted.agg(*[F.sum((F.col("n") == k).cast("long")) for k in (1, 2, 3, 4)]).first())
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        cut = [min(max(d, 0.05), k) for k, d in ((1, 1 - 2 * y * n2 / max(n1, 1)), (2, 2 - 3 * y * n3 / max(n2, 1)), (3, 3 - 4 * y * n4 / max(n3, 1)))]
        less = F.when(F.col("n") == 1, cut[0]).when(F.col("n") == 2, cut[1]).otherwise(cut[2])
        keyed = counted.withColumns({"context": F.shiftright("gram", BITS), "less": less})
        contexts = keyed.groupBy("context").agg(F.sum("n").alias("t"), F.sum("less").alias("d")).withColumn("weight", F.col("d") / F.col("t"))
        joined = keyed.join(contexts, "context")
        if lower is None:
            below = F.lit(1.0 / END)
        else:
            joined = joined.withColumn("short", F.col("gram").bitwiseAND(F.lit((1 << (BITS * (size - 1))) - 1))).join(lower, "short")
            below = F.col("p_short")
        probs = settle(joined.select("gram", "context", ((F.col("n") - F.col("less")) / F.col("t") + F.col("weight") * below).alias("p")))
        out.append((size, probs, contexts))
        lower = probs.select(F.col("gram").alias("short"), F.col("p").alias("p_short"))
    table = None
    for size, probs, contexts in out:
        rows = probs.select(F.lit(size).alias("size"), "gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("backoff"))
        backs = contexts.select(F.lit(size - 1).alias("size"), F.col("context").alias("gram"), F.lit(None).cast("double").alias("logp"), F.log("weight").alias("backoff"))
        both = rows.unionByName(backs)
        table = both if table is None else table.unionByName(both)
    return settle(table.groupBy("size", "gram").agg(F.max("logp").alias("logp"), F.max("backoff").alias("backoff")))


class Shard:
    """The grams of one share of the model, sorted, by size."""

    def __init__(self, size: np.ndarray, gram: np.ndarray, logp: np.ndarray, backoff: np.ndarray):
        self.by = {}
        for s in np.unique(size):
            at = np.flatnonzero(size == s)
            at = at[np.argsort(gram[at])]
            self.by[int(s)] = gram[at], logp[at], backoff[at]

    def look_up(self, size: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in ``keys`` of the grams that the share has, with logp and backoff."""
        if size not in self.by:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        gram, logp, backoff = self.by[size]
        at = np.minimum(np.searchsorted(gram, keys), len(gram) - 1)
        hit = np.flatnonzero(gram[at] == keys)
        return hit, logp[at[hit]], backoff[at[hit]]


def _joined(keys: np.ndarray, size: int, shards: list) -> tuple[np.ndarray, np.ndarray]:
    """logp and backoff of each key, met with one shard after the other; nan where there is none."""
    logp, backoff = np.full(len(keys), np.nan), np.full(len(keys), np.nan)
    for shard in shards:
        hit, a, b = shard.value.look_up(size, keys)
        logp[hit], backoff[hit] = a, b
    return logp, backoff


def costs(keys: np.ndarray, order: int, shards: list) -> np.ndarray:
    """log probability of the last symbol of each distinct gram."""
    total, open_ = np.zeros(len(keys)), np.arange(len(keys))
    for size in range(order + 1, 0, -1):
        logp, _ = _joined(keys[open_] & ((1 << (BITS * size)) - 1), size, shards)
        found = ~np.isnan(logp)
        total[open_[found]] += logp[found]
        open_ = open_[~found]
        if not len(open_):
            return total
        _, weight = _joined((keys[open_] & ((1 << (BITS * size)) - 1)) >> BITS, size - 1, shards)
        total[open_] += np.nan_to_num(weight)
    total[open_] -= np.log(END)
    return total


def perplexities(docs: DataFrame, model: DataFrame, keep: list[str], text: str = "text", out: str = "perplexity", order: int = ORDER, shards: int = SHARDS, ids: DataFrame | None = None) -> DataFrame:
    """``keep`` columns, the perplexity (per byte, the end included) of every row as ``out`` and its ``<out>_symbols``.

    The model's size is bounded by the trusted sample; it is dealt into ``shards`` and each
    is broadcast. A task joins the distinct grams of a slice with one shard after another.
    Given ``ids``, one column, only rows are scored whose first kept column may be one of
    them; what is left out surely is none. They are told by bits of a set of 32 MB at most,
    inside the same task, so no text is shuffled to be filtered.
    """
    spark, parts = docs.sparkSession, []
    for k in range(shards):
        rows = model.where(F.pmod(F.xxhash64("gram"), F.lit(shards)) == k).toPandas()
        parts.append(spark.sparkContext.broadcast(Shard(*(rows[c].to_numpy() for c in ("size", "gram")), *(rows[c].to_numpy(float) for c in ("logp", "backoff")))))
    own = [] if text in keep else [F.col(f"`{text}`").cast("string").alias("_body")]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *own)
    place = keep.index(text) if text in keep else len(keep)
    body = rows.columns[place]
    names = None
    if ids is not None:
        names = spark.sparkContext.broadcast(names_of(ids.select(F.xxhash64(ids.columns[0]).alias("name")), "name"))
        rows = rows.withColumn("_name", F.xxhash64(F.col(f"`{keep[0]}`")))
    schema = rows.select(*rows.columns[: len(keep)]).withColumns({out: F.lit(0.0), f"{out}_symbols": F.lit(0).cast("long")}).schema

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch if names is None else batch.filter(pa.array(names.value.may_hold(batch.column("_name").to_numpy().view(np.uint64))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(wanted(batches), body, SLICE):
            coded, offsets = grams(Tokens(part.column(place)), order)
            keys, at = np.unique(coded, return_inverse=True)
            mean = np.add.reduceat(costs(keys, order, parts)[at], offsets[:-1]) / np.diff(offsets)
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(np.exp(-mean)), pa.array(np.diff(offsets))], schema.names)

    return rows.mapInArrow(run, schema)


def thresholds(scored: DataFrame, quantile: float, slack: float) -> tuple[DataFrame, float | None]:
    """(_of, own) by language from (_lang, perplexity) of trusted texts, and that of all of them."""
    level = F.percentile_approx("perplexity", quantile, 10000) * slack
    return settle(scored.groupBy(F.col("_lang").alias("_of")).agg(level.alias("own"))), scored.agg(level).first()[0]


def _passes(limit: Column, evidence: float) -> Column:
    """Whether a text's cost beyond the limit is within the evidence; without a text or a limit it is."""
    return (F.col("perplexity_symbols") == 1) | F.coalesce(F.col("perplexity_symbols") * F.log(F.col("perplexity") / limit) <= evidence, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text: str, quality: str, order: int, max_docs: int, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The model and the ids of the trusted rows that set the thresholds."""
    return train(trusted_sample(docs, labels, id_col, text, quality, max_docs, max_bytes), order), _trusted(labels, id_col, quality, 1)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", quality: str = "quality", quantile: float = 0.98, slack: float = 1.05, evidence: float = 8.0, order: int = ORDER, max_docs: int = TRUSTED_DOCS, max_bytes: int = TRUSTED_BYTES) -> DataFrame:
    """id, lang, perplexity, threshold and kept of every row.

    A language's threshold is ``slack`` times the ``quantile`` of the perplexities of all
    trusted texts of the half from which the model did not learn. A row is rejected if its text costs more than the threshold allows by
    over ``evidence`` nats, so a few odd bytes don't reject a short text, nor is an empty one. A language without any, or null, takes the quantile of all
    languages, and without trusted texts every row is kept. The model learns from at most
    ``max_docs`` trusted texts and ``max_bytes``. A null text is an empty one and kept; rows of a
    null id return, they are trusted by no label; repeated rows each have a row; an empty
    table gives none.
    """
    model, good = fit(docs, labels, id_col, text, quality, order, max_docs, max_bytes)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{lang}`").cast("string").alias("_lang"), F.col(f"`{text}`").alias("_text"))
    scored = settle(perplexities(rows, model, ["_id", "_lang"], "_text", order=order))
    bounds, overall = thresholds(scored.join(good, "_id", "left_semi"), quantile, slack)
    limit = F.coalesce("own", F.lit(overall).cast("double"))
    return join_small(scored, bounds, F.col("_lang") == F.col("_of"), "left", settled=True).select(
        F.col("_id").alias(id_col), F.col("_lang").alias(lang), "perplexity", limit.alias("threshold"), _passes(limit, evidence).alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", quality: str = "quality", quantile: float = 0.98, slack: float = 1.05, evidence: float = 8.0, order: int = ORDER, max_docs: int = TRUSTED_DOCS, max_bytes: int = TRUSTED_BYTES) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all columns.

    Rows that may be trusted are scored for the thresholds, of which ids and perplexities are
    left, then all rows, to be filtered as they stream by; no text is shuffled or stored. Null
    texts, null ids, repeated rows and empty tables are as for ``classify``.
    """
    model, good = fit(docs, labels, id_col, text, quality, order, max_docs, max_bytes)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{lang}`").cast("string").alias("_lang"), F.col(f"`{text}`").alias("_text"))
    trusted = perplexities(rows, model, ["_id", "_lang"], "_text", order=order, ids=good).join(good, "_id", "left_semi")
    bounds, overall = thresholds(settle(trusted), quantile, slack)
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    place = {c: n for n, c in zip(names, docs.columns, strict=True)}
    scored = perplexities(plain, model, names, place[text], order=order)
    joined = join_small(scored, bounds, F.col(place[lang]).cast("string") == F.col("_of"), "left", settled=True)
    limit = F.coalesce("own", F.lit(overall).cast("double"))
    return joined.where(_passes(limit, evidence)).select(*names).toDF(*docs.columns)
