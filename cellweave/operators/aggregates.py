"""Composites, pivots, summaries and percentiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.functions.geometry import all_vertices, bbox, exterior_rings
from cellweave.functions.numeric import deg_to_m, round_even
from cellweave.operators.ranking import running_total
from cellweave.operators.sizing import join_small
from cellweave.session import settle

CELL = ("layer", "row", "col")


def sum_where(df: DataFrame, key: str, pred: Column, value: str, out: str = "total") -> DataFrame:
    """Sum of the matching rows; a present group of missing values gives zero."""
    return df.where(pred).groupBy(key).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(out))


def pivot_sum(df: DataFrame, key: str, pivot: str, values: Mapping[str, str], value: str) -> DataFrame:
    """One summed column per listed code; NULL where a group lacks the code."""
    return _pivot(df, key, pivot, values, F.coalesce(F.sum(value), F.lit(0.0)), value)


def pivot_max(df: DataFrame, key: str, pivot: str, values: Mapping[str, str], value: str) -> DataFrame:
    """One maximum column per listed code."""
    return _pivot(df, key, pivot, values, F.max(value), value)


def _pivot(df: DataFrame, key: str, pivot: str, values: Mapping[str, str], agg: Column, value: str) -> DataFrame:
    cells = df.where(F.col(pivot).isin(list(values))).groupBy(key, pivot).agg(agg.alias("_v"))
    wide = cells.groupBy(key).pivot(pivot, list(values)).agg(F.max("_v"))
    return wide.withColumnsRenamed(dict(values))


def composite_mean(obs: DataFrame, keys: Sequence[str] = CELL, value: str = "value") -> DataFrame:
    """Mean over time; masked observations do not count."""
    return obs.groupBy(*keys).agg(F.avg(value).alias(value))


def composite_mode(obs: DataFrame, keys: Sequence[str] = CELL, value: str = "value") -> DataFrame:
    """Most frequent value over time, the smallest on a tie.

    Counting (cell, value) first keeps every aggregate small, however many
    observations one cell has.
    """
    counts = obs.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    if dict(obs.dtypes)[value] in ("tinyint", "smallint", "int"):
        # Count and code in one BIGINT keep the second aggregate hash-based: the count
        # in the upper half, and below it the distance to the largest code.
        top = F.lit(2**31 - 1).cast("bigint")
        packed = F.shiftleft("_n", 32).bitwiseOR(top - F.col(value))
        code = top - F.col("_best").bitwiseAND(F.lit(2**32 - 1))
        best = counts.groupBy(*keys).agg(F.max(packed).alias("_best"))
        return best.select(*keys, code.cast(dict(obs.dtypes)[value]).alias(value))
    best = F.min(F.struct((-F.col("_n")).alias("_rank"), F.col(value).alias("_v")))
    return counts.groupBy(*keys).agg(best.alias("_best")).select(*keys, F.col("_best._v").alias(value))


def mosaic(obs: DataFrame, keys: Sequence[str] = CELL, value: str = "value", order: str = "img_ord") -> DataFrame:
    """The last image with a value on top."""
    seen = obs.where(F.col(value).isNotNull())
    return seen.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def first_image(obs: DataFrame, order: str = "img_ord") -> DataFrame:
    """Observations of the first image of the collection."""
    return obs.where(F.col(order) == obs.agg(F.min(order)).scalar())


def layer_summary(pixels: DataFrame, meta: DataFrame) -> DataFrame:
    """Shape, resolution in metres, valid cells and mean per layer."""
    stats = pixels.groupBy("layer").agg(F.count("value").alias("valid_px"), round_even(F.avg("value"), 2).alias("mean"))
    return meta.join(stats, "layer", "left").select(
        "layer",
        F.col("height").alias("n_rows"),
        F.col("width").alias("n_cols"),
        round_even(deg_to_m(F.col("sx")), 0).alias("res_m"),
        F.coalesce("valid_px", F.lit(0)).alias("valid_px"),
        "mean",
    )


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, n_null) in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "n_null")


def percentile_exact(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = ("layer",)) -> DataFrame:
    """Exact percentiles with linear interpolation, per key: (keys, prob, value).

    Equal values are counted first, then ranked by a distributed running total, so
    neither a hot key nor a hot value lands in one task.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(counts, [value], F.col("_n"), keys, out="_upto")
    totals = settle(ranked.groupBy(*keys).agg(F.sum("_n").alias("_total")))  # needs no window
    wanted = totals.select(*keys, "_total", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    at = F.col("prob") * (F.col("_total") - 1)
    wanted = wanted.select(*keys, "prob", (at - F.floor(at)).alias("_t"), F.floor(at).alias("_lo"), F.ceil(at).alias("_hi"))
    spans = ranked.withColumn("_from", F.col("_upto") - F.col("_n"))

    def holds(position: str) -> Column:
        return (F.col("_from") <= F.col(position)) & (F.col(position) < F.col("_upto"))

    hit = join_small(spans, wanted, list(keys), settled=True).where(holds("_lo") | holds("_hi"))
    picked = hit.groupBy(*keys, "prob").agg(
        F.max(F.when(holds("_lo"), F.col(value))).alias("_a"),
        F.max(F.when(holds("_hi"), F.col(value))).alias("_b"),
        F.max("_t").alias("_t"),
    )
    return picked.select(*keys, "prob", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_t")).alias(value))


def percentile_stretch(
    pixels: DataFrame, lo: float = 0.02, hi: float = 0.98, keys: Sequence[str] = ("layer",), accuracy: int | None = None
) -> DataFrame:
    """(keys, p_lo, p_hi): exact, or approximate in one pass when ``accuracy`` is given."""
    if accuracy:
        both = F.percentile_approx("value", [lo, hi], accuracy)
        return pixels.groupBy(*keys).agg(both.alias("_p")).select(
            *keys, F.col("_p")[0].alias("p_lo"), F.col("_p")[1].alias("p_hi")
        )
    found = percentile_exact(pixels, "value", [lo, hi], keys)
    return found.groupBy(*keys).agg(
        F.max(F.when(F.col("prob") == lo, F.col("value"))).alias("p_lo"),
        F.max(F.when(F.col("prob") == hi, F.col("value"))).alias("p_hi"),
    )


def normalize_minmax(df: DataFrame, col: str, keys: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Rescale to 0..1, per key or over the table; NULL where all values are equal."""
    out = out or f"{col}_norm"

    def scaled(lo: Column, hi: Column) -> Column:
        return F.try_divide(F.col(col) - lo, hi - lo)

    if not keys:
        ends = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("e")).scalar()
        return df.withColumn(out, scaled(ends["lo"], ends["hi"]))
    ends = settle(df.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi")))
    return join_small(df, ends, list(keys), "left", settled=True).withColumn(out, scaled(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def distinct_keys(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """(stage, n) for each named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n") for name, df in stages.items()
    ]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


def observe_stage(df: DataFrame, observation) -> DataFrame:
    """Count rows as they pass, without a second pass; read ``observation.get`` after an action."""
    return df.observe(observation, F.count(F.lit(1)).alias("n"))


def group_datasets(collections: DataFrame) -> DataFrame:
    """Distinct datasets per collection group."""
    members = collections.select("group", F.explode("datasets").alias("dataset_id")).distinct()
    return members.groupBy("group").agg(F.count(F.lit(1)).alias("n_datasets"))


def polygon_boxes(polygons: DataFrame) -> DataFrame:
    """(id, min_x, min_y, max_x, max_y) of polygons with a vertex."""
    rings = polygons.select("id", exterior_rings(F.col("parts")).alias("_r"))
    return rings.where(F.size(all_vertices(F.col("_r"))) > 0).select("id", bbox(F.col("_r")).alias("b")).select("id", "b.*")


def _lines(points: DataFrame, by: Sequence[str], seq: str, lon: str, lat: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct(F.col(seq), F.col(lon), F.col(lat))))
    return points.groupBy(*by).agg(
        F.transform(ordered, lambda v: F.array(v[lon].cast("double"), v[lat].cast("double"))).alias("coordinates")
    )


def to_linestrings(shapes: DataFrame, key: str = "shape_id", seq: str = "seq", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(key, coordinates): the vertices of each shape in sequence, one line whatever its size."""
    return _lines(shapes.where(F.col(key).isNotNull()), [key], seq, lon, lat)


def linestring_parts(
    shapes: DataFrame, max_vertices: int, key: str = "shape_id", seq: str = "seq", lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    """(key, part, coordinates): each shape as numbered consecutive parts of at most ``max_vertices``.

    No row or task has to hold a whole shape.
    """
    points = shapes.where(F.col(key).isNotNull()).select(key, seq, lon, lat)
    ranked = running_total(points, [seq], keys=[key], out="_rank")
    return _lines(ranked.withColumn("part", F.expr(f"(_rank - 1) div {int(max_vertices)}")), [key, "part"], seq, lon, lat)


def lut_segments(lut: DataFrame) -> DataFrame:
    """Consecutive entries (lut_id, lo, hi) of each table; the first has no lo, the last no hi."""
    entry = F.struct("v", "r", "g", "b")
    numbered = lut.where(~F.col("is_nv")).withColumn("lo", entry)
    w = W.partitionBy("lut_id").orderBy("v")
    inner = numbered.select("lut_id", "lo", F.lead("lo").over(w).alias("hi"))
    edge = numbered.select("lut_id", "lo", F.lag("lo").over(w).alias("_before")).where(F.col("_before").isNull())
    below = edge.select("lut_id", F.lit(None).cast(inner.schema["lo"].dataType).alias("lo"), F.col("lo").alias("hi"))
    return inner.unionByName(below)
