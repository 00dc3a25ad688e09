"""Equi joins of indicators, attributes, layers and registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.numeric import ratio, round_even
from cellweave.operators.ranking import dedupe_first
from cellweave.operators.sizing import join_small


def join_indicators(base: DataFrame, tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Star of left joins on one key; rows absent from ``base`` do not appear."""
    for table in tables:
        base = base.join(table, key, "left")
    return base


def share_of_total(
    df: DataFrame, key: str, code: str, value: str, total_codes: Sequence[str], part_codes: Sequence[str], n: int = 4
) -> DataFrame:
    """(key, total, part, share) in one conditional aggregation.

    Keys without a total row do not appear; a missing part counts as zero.
    """
    is_total, is_part = F.col(code).isin(list(total_codes)), F.col(code).isin(list(part_codes))
    sums = (
        df.where(is_total | is_part)
        .groupBy(key)
        .agg(
            F.sum(F.when(is_total, F.col(value))).alias("total"),
            F.coalesce(F.sum(F.when(is_part, F.col(value))), F.lit(0.0)).alias("part"),
            F.count_if(is_total).alias("_n"),
        )
    )
    return sums.where("_n > 0").drop("_n").withColumn("share", round_even(ratio(F.col("part"), F.col("total")), n))


def attach(polygons: DataFrame, attrs: DataFrame, key: str) -> DataFrame:
    """Attributes onto geometry; every polygon stays."""
    return polygons.join(attrs, key, "left")


def shape_routes(trips: DataFrame, routes: DataFrame, order_by: str = "trip_id") -> DataFrame:
    """First trip per shape with its route's attributes."""
    one = dedupe_first(trips.select("shape_id", "route_id", order_by), "shape_id", order_by)
    return join_small(one.select("shape_id", "route_id"), routes, "route_id", "left")


def shapes_with_routes(shapes: DataFrame, trips: DataFrame, routes: DataFrame, order_by: str = "trip_id") -> DataFrame:
    """One row per shape at most gains route attributes."""
    return shapes.join(shape_routes(trips, routes, order_by), "shape_id", "left")


def stack_layers(
    pixels: DataFrame, layers: Sequence[str], keys: Sequence[str] = ("row", "col"), value: str = "value"
) -> DataFrame:
    """One column per layer, cell by cell, in one aggregation."""
    cells = pixels.where(F.col("layer").isin(list(layers)))
    return cells.groupBy(*keys).pivot("layer", list(layers)).agg(F.max(value))


def unstack_layers(wide: DataFrame, layers: Sequence[str], keys: Sequence[str] = ("row", "col")) -> DataFrame:
    """Back to one row per layer and cell; cells without a value are left out."""
    return wide.unpivot(list(keys), list(layers), "layer", "value").where(F.col("value").isNotNull())


def overlay(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("row", "col")) -> DataFrame:
    """Cells present in both co-registered rasters."""
    return left.join(right, list(keys), "inner")


def dangling_refs(edges: DataFrame, registry: DataFrame, ref: str, key: str) -> DataFrame:
    """References without a registry entry."""
    known = registry.select(F.col(key).alias(ref)).distinct()
    return join_small(edges.where(F.col(ref).isNotNull()), known, ref, "left_anti")


def discover(collections: DataFrame, assets: DataFrame) -> DataFrame:
    """Collection to dataset to asset rows."""
    members = collections.select(
        F.col("id").alias("collection_id"), "group", F.explode("datasets").alias("dataset_id")
    )
    return members.join(assets, "dataset_id")


def union_batches(*frames: DataFrame) -> DataFrame:
    """Concatenate by column name; absent columns become NULL."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
