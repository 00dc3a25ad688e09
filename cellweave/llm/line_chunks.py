"""Repeated passages of lines, in content-defined chunks; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.session import settle

SPREAD = 4


def _held(rows: DataFrame, **made: Column) -> DataFrame:
    """``rows`` with further columns that are computed once a row.

    A generator over one struct keeps the optimizer from moving an array into the lambda
    functions that index it, where it would be computed for every element.
    """
    packed = F.explode(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))).alias("_held")
    return rows.select("*", packed).select(*rows.columns, "_held.*")


def _chunks(rows: DataFrame, body: Column, spread: int) -> DataFrame:
    """``rows`` with _chunks: (first, last, body, multi) of the chunks of lines of ``body``.

    A chunk ends after a line at which the hash over the hashes of the line and the one
    before it is below 1/spread of its range, so that inserted or deleted lines move no
    other boundary. ``multi``: two lines or more have more than blanks.
    """
    lines = F.split(body, "\n")
    rows = _held(rows, _lines=lines, _hashes=F.transform(lines, F.md5))
    bound = F.lit(f"{256 // spread:02x}")
    rolled = lambda i: F.md5(F.concat(F.coalesce(F.get("_hashes", i - 1), F.lit("")), F.get("_hashes", i)))
    ends = F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: (i == F.size("_lines") - 1) | (F.substring(rolled(i), 1, 2) < bound))
    rows = _held(rows, _ends=F.when(F.col("_lines").isNotNull(), ends))
    firsts = F.transform("_ends", lambda e, k: F.struct(F.coalesce(F.get("_ends", k - 1) + 1, F.lit(0)).alias("first"), e.alias("last")))
    inside = lambda c: F.slice("_lines", c["first"] + 1, c["last"] - c["first"] + 1)
    solid = lambda c: F.size(F.filter(inside(c), lambda x: F.rtrim(F.translate(x, "\t\r\f\v", "    ")) != ""))
    chunks = F.transform(firsts, lambda c: F.struct(c["first"].alias("first"), c["last"].alias("last"), F.array_join(inside(c), "\n").alias("body"), (solid(c) > 1).alias("multi")))
    return _held(rows, _chunks=chunks).drop("_lines", "_hashes", "_ends")


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text: str = "text", spread: int = SPREAD) -> DataFrame:
    """``docs`` with repeated chunks of two lines or more taken out of ``text``; all columns return.

    Of equal chunks the first stays: the one with the least id (null first), then the
    least hash of its text, then the least place in it. Hashes are counted over all texts
    at once; chunks whose hash occurs again are compared byte by byte before any is
    removed. A chunk counts once per task before it is shuffled, and what is removed goes
    back to its row as places. A null text stays null, a text that loses all its chunks
    becomes empty, chunks of one line or of blank lines stay. Rows with equal id and text
    are one document and stay alike. An empty table gives none.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain, place = docs.toDF(*names), dict(zip(docs.columns, names, strict=True))
    name, whole = F.col(place[id_col]), F.col(place[text])
    body = whole.cast("string")
    rows = plain.where(body.isNotNull()).select(name.alias("_id"), F.xxhash64(body).alias("_print"), body.alias("_body"))
    chunked = _chunks(rows, F.col("_body"), spread).select("_id", "_print", F.posexplode("_chunks").alias("_place", "_c"))
    chunked = chunked.where("_c.multi").select("_id", "_print", "_place", F.xxhash64("_c.body").alias("_hash"), F.col("_c.body").alias("_part"))
    again = chunked.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    same = settle(chunked.join(again, "_hash", "left_semi"))
    where = F.struct("_id", "_print", "_place")
    firsts = same.groupBy("_hash", "_part").agg(F.min(where).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    gone = same.join(firsts, ["_hash", "_part"]).where(~where.eqNullSafe(F.col("_first")))
    gone = gone.groupBy("_id", "_print").agg(F.collect_set("_place").alias("_gone"))
    keyed = plain.withColumns({"_id": name, "_print": F.xxhash64(body)})
    joined = keyed.alias("l").join(gone.alias("r"), F.expr("l._print = r._print AND l._id <=> r._id"), "left").select("l.*", "r._gone")
    marked = _chunks(joined, F.when(F.col("_gone").isNotNull(), body), spread)
    left = F.transform(F.filter("_chunks", lambda c, k: ~F.array_contains("_gone", k)), lambda c: c["body"])
    out = F.when(F.col("_gone").isNull(), whole).otherwise(F.array_join(left, "\n"))
    return marked.select(*[out.alias(c) if c == place[text] else F.col(c) for c in names]).toDF(*docs.columns)


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines of repeated passages of two lines or more; all columns return.

    Two lines with more than blanks that follow each other, but for blank ones, are a
    pair. Of equal pairs the first stays, in the order of ``remove_repeated``; the lines
    of all others go, with the blank ones between them. So a passage is found from its
    second line on wherever it lies, and every line that goes also stands at an earlier
    place that stays. Pairs whose 64-bit hash occurs again are compared by MD5. A null
    text stays null; rows with equal id and text are one document and stay alike.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain, place = docs.toDF(*names), dict(zip(docs.columns, names, strict=True))
    name, whole = F.col(place[id_col]), F.col(place[text])
    body = whole.cast("string")
    rows = plain.where(body.isNotNull()).select(name.alias("_id"), F.xxhash64(body).alias("_print"), F.split(body, "\n").alias("_text"))
    rows = _held(rows, _lines=F.col("_text")).drop("_text")
    solid = F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: F.rtrim(F.translate(F.get("_lines", i), "\t\r\f\v", "    ")) != "")
    rows = _held(rows, _solid=solid).where(F.size("_solid") > 1)
    both = lambda k: F.concat(F.get("_lines", F.get("_solid", k)), F.lit("\n"), F.get("_lines", F.get("_solid", k + 1)))
    pair = lambda k: F.struct(F.get("_solid", k).alias("first"), F.get("_solid", k + 1).alias("last"), F.xxhash64(both(k)).alias("hash"), F.unhex(F.md5(both(k))).alias("md5"))
    pairs = rows.select("_id", "_print", F.explode(F.transform(F.sequence(F.lit(0), F.size("_solid") - 2), pair)).alias("_p")).select("_id", "_print", "_p.*")
    again = pairs.groupBy("hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("hash")
    same = settle(pairs.join(again, "hash", "left_semi"))
    where = F.struct("_id", "_print", "first")
    firsts = same.groupBy("md5").agg(F.min(where).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    gone = same.join(firsts, "md5").where(~where.eqNullSafe(F.col("_first")))
    gone = gone.groupBy("_id", "_print").agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last")))).alias("_gone"))
    keyed = plain.withColumns({"_id": name, "_print": F.xxhash64(body)})
    joined = keyed.alias("l").join(gone.alias("r"), F.expr("l._print = r._print AND l._id <=> r._id"), "left").select("l.*", "r._gone")
    marked = _held(joined, _lines=F.when(F.col("_gone").isNotNull(), F.split(body, "\n")))
    marked = _held(marked, _left=F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone"))
    out = F.when(F.col("_gone").isNull(), whole).otherwise(F.array_join(F.transform("_left", lambda i: F.get("_lines", i)), "\n"))
    return marked.select(*[out.alias(c) if c == place[text] else F.col(c) for c in names]).toDF(*docs.columns)
