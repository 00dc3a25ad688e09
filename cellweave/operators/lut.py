"""Colour table lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cellweave.functions.color import color_linear, decode_rgb, rgb_to_hex
from cellweave.operators.sizing import join_small
from cellweave.session import settle


def lut_spans(lut: DataFrame) -> DataFrame:
    """Half-open spans [_from, _to) of each table (_lut), with the entries that bound them.

    The span below the first entry has no ``_from`` and no ``_lo``, the last one no
    ``_to`` and no ``_hi``. Of entries with equal value the least is met from below
    (``_hi``, ``_at``), the greatest from above (``_lo``).
    """
    entry = F.struct("v", "r", "g", "b")
    values = lut.where(~F.col("is_nv")).groupBy("lut_id", "v").agg(F.min(entry).alias("_at"), F.max(entry).alias("_lo"))
    w = W.partitionBy("lut_id").orderBy("v")
    spans = values.select(
        F.col("lut_id").alias("_lut"), F.col("v").alias("_from"), F.lead("v").over(w).alias("_to"), "_lo", "_at",
        F.lead("_at").over(w).alias("_hi"), F.lag("v").over(w).alias("_before"),
    )
    none = F.lit(None).cast(spans.schema["_at"].dataType)
    below = spans.where(F.col("_before").isNull()).select(
        "_lut", F.lit(None).cast("double").alias("_from"), F.col("_from").alias("_to"), none.alias("_lo"), none.alias("_at"), F.col("_at").alias("_hi")
    )
    return spans.drop("_before").unionByName(below)


def _bucket(v: Column) -> Column:
    """The slice of a table's range that holds the value: -1 below its first entry, ``_count`` from its last one on."""
    inside = F.least(F.floor((v - F.col("_first")) / F.col("_width")), F.col("_count"))
    return F.when(v < F.col("_first"), F.lit(-1).cast("bigint")).when(v >= F.col("_last"), F.col("_count")).otherwise(inside)


def _spanned(pixels: DataFrame, lut: DataFrame, v: Column) -> DataFrame:
    """``pixels`` with the span that holds the value; a missing value has none.

    A table's range is cut into as many equal slices as it has entries. A span stands in
    each slice it meets, together at most two a entry, and a pixel is joined by table and
    slice, so it meets the spans of one slice and the pixels of one table spread over
    slices where the join is shuffled.
    """
    spans = settle(lut_spans(lut))
    ranges = spans.groupBy("_lut").agg(F.min("_to").alias("_first"), F.max("_from").alias("_last"), F.count(F.lit(1)).alias("_count"))
    ranges = settle(ranges.withColumn("_width", F.when(F.col("_last") > F.col("_first"), (F.col("_last") - F.col("_first")) / F.col("_count")).otherwise(F.lit(1.0))))
    least = F.when(F.col("_from").isNull(), F.lit(-1).cast("bigint")).otherwise(_bucket(F.col("_from")))
    most = F.when(F.col("_to").isNull(), F.col("_count")).otherwise(_bucket(F.col("_to")))
    sliced = spans.join(ranges, "_lut").withColumn("_slice", F.explode(F.sequence(least, most))).select("_lut", "_slice", "_from", "_to", "_lo", "_at", "_hi")
    placed = join_small(pixels, ranges.withColumnRenamed("_lut", "_table"), pixels["lut_id"] == F.col("_table"), "left", settled=True)
    low = F.col("_from").isNull() | (v >= F.col("_from"))
    high = F.col("_to").isNull() | (v < F.col("_to"))
    placed = placed.withColumn("_place", F.when(v.isNotNull(), _bucket(v))).drop("_table", "_first", "_last", "_count", "_width")
    return join_small(placed, settle(sliced), (F.col("lut_id") == F.col("_lut")) & (F.col("_place") == F.col("_slice")) & low & high, "left", settled=True)


SPAN = ("_lut", "_slice", "_place", "_from", "_to", "_lo", "_at", "_hi")


def _upper(v: Column) -> Column:
    """The first entry not below the value."""
    return F.when(v == F.col("_from"), F.col("_at")).otherwise(F.col("_hi"))


def _closest(v: Column) -> Column:
    """Closest entry, the lower one on a tie; NULL for a missing value."""
    near = F.col("_hi").isNull() | (v - F.col("_at.v") <= F.col("_hi.v") - v)
    return F.when(F.col("_at").isNotNull() & near, F.col("_at")).otherwise(F.col("_hi"))


def lut_bracket(pixels: DataFrame, lut: DataFrame, value: str = "value") -> DataFrame:
    """Add ``lo`` and ``hi``, the last entry not above the value and the first not below it."""
    v = F.col(value)
    return _spanned(pixels, lut, v).withColumns({"lo": F.col("_lo"), "hi": _upper(v)}).drop(*SPAN)


def lut_nearest(pixels: DataFrame, lut: DataFrame, value: str = "value") -> DataFrame:
    """Add ``entry``, the closest entry of the table."""
    return _spanned(pixels, lut, F.col(value)).withColumn("entry", _closest(F.col(value))).drop(*SPAN)


def lut_colors(pixels: DataFrame, lut: DataFrame, mode: str = "linear", value: str = "value") -> DataFrame:
    """Add ``rgb``: interpolated or nearest colour; a missing value takes the nodata entry."""
    v = F.col(value)
    found = _spanned(pixels, lut, v)
    if mode == "linear":
        found = found.withColumn("_up", _upper(v))
        color = color_linear(v, F.col("_lo"), F.col("_up"))
    elif mode == "nearest":
        found = found.withColumn("_up", _closest(v))
        color = F.struct(*[F.col(f"_up.{n}").alias(n) for n in "rgb"])
    else:
        raise ValueError(f"unknown colour mode {mode!r}")
    nodata = lut.where("is_nv").groupBy(F.col("lut_id").alias("_nv_lut")).agg(F.min(F.struct("r", "g", "b")).alias("_nv"))
    joined = join_small(found, nodata, found["lut_id"] == F.col("_nv_lut"), "left")
    known = v.isNotNull() & F.col("_lut").isNotNull()
    return joined.withColumn("rgb", F.when(known, color).when(v.isNull(), F.col("_nv"))).drop(*SPAN, "_up", "_nv", "_nv_lut")


def palette_linear(value: Column, palette: Sequence[tuple]) -> Column:
    """Interpolated colour of a constant palette ((v, r, g, b), ...) as one generated expression."""
    entries = sorted(palette)
    first, last = entries[0], entries[-1]

    def solid(entry: tuple) -> Column:
        return F.struct(*[F.lit(int(c)).alias(n) for c, n in zip(entry[1:4], "rgb")])

    result = F.when(value.isNull(), F.lit(None)).when(value <= F.lit(float(first[0])), solid(first))
    for lo, hi in zip(entries, entries[1:]):
        t = (value - F.lit(float(lo[0]))) / F.lit(float(hi[0]) - float(lo[0]))
        mixed = F.struct(
            *[F.rint(F.lit(a) + F.lit(b - a) * t).cast("int").alias(n) for a, b, n in zip(lo[1:4], hi[1:4], "rgb")]
        )
        result = result.when(value < F.lit(float(hi[0])), mixed)
    return result.otherwise(solid(last))


def palette_nearest(value: Column, palette: Sequence[tuple]) -> Column:
    """Closest colour of a constant palette, the lower entry on a tie."""
    entries = sorted(palette)

    def solid(entry: tuple) -> Column:
        return F.struct(*[F.lit(int(c)).alias(n) for c, n in zip(entry[1:4], "rgb")])

    result = F.when(value.isNull(), F.lit(None))
    for lo, hi in zip(entries, entries[1:]):
        result = result.when(value <= F.lit((float(lo[0]) + float(hi[0])) / 2), solid(lo))
    return result.otherwise(solid(entries[-1]))


def lut_audit(lut: DataFrame, encodings: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Entries whose decoded value misses their own by more than ``tolerance`` steps."""
    decoded = decode_rgb(F.col("r"), F.col("g"), F.col("b"), F.col("type"), F.col("scale"), F.col("offset"))
    rows = join_small(lut.where(~F.col("is_nv")), encodings, "lut_id").withColumn("decoded", decoded)
    off = F.abs(F.col("decoded") - F.col("v"))
    return rows.where(off > F.col("scale") * tolerance + 1e-9).select("lut_id", "v", "r", "g", "b", "decoded")


def legend_mismatches(legend: DataFrame, lut: DataFrame) -> DataFrame:
    """Classes whose registry colour and table colour differ, or that only one side has."""
    table = lut.where(~F.col("is_nv")).select(
        F.col("lut_id").alias("dataset_id"), F.col("v").cast("int").alias("class"), rgb_to_hex(F.col("r"), F.col("g"), F.col("b")).alias("lut_color")
    )
    both = legend.select("dataset_id", "class", F.upper("color").alias("legend_color")).join(
        table, ["dataset_id", "class"], "full"
    )
    return both.where(~F.col("legend_color").eqNullSafe(F.col("lut_color")))
