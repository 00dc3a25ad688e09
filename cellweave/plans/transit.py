"""Transit stops, shapes and routes as GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.color import hex_color
from cellweave.functions.text import text_or
from cellweave.operators.aggregates import to_linestrings
from cellweave.operators.filters import drop_null
from cellweave.operators.joins import shape_routes
from cellweave.operators.nested import KEEP_NULLS, line_geometry, point_geometry, to_feature


def stop_features(stops: DataFrame) -> DataFrame:
    """(stop_id, feature): stops with a position."""
    placed = drop_null(stops, ["stop_lat", "stop_lon"])
    props = {
        "stop_id": text_or(F.col("stop_id"), None),
        "stop_name": text_or(F.col("stop_name")),
        "stop_code": text_or(F.col("stop_code"), None),
    }
    return to_feature(placed, point_geometry(F.col("stop_lon"), F.col("stop_lat")), props, keep=["stop_id"])


def shape_lines(shapes: DataFrame) -> DataFrame:
    """(shape_id, coordinates) in point sequence."""
    return to_linestrings(shapes, "shape_id", "shape_pt_sequence", "shape_pt_lon", "shape_pt_lat")


def shape_features(shapes: DataFrame) -> DataFrame:
    """(shape_id, feature)."""
    return to_feature(
        shape_lines(shapes), line_geometry(F.col("coordinates")), {"shape_id": F.col("shape_id")}, keep=["shape_id"]
    )


def route_features(shapes: DataFrame, trips: DataFrame, routes: DataFrame, order_by: str = "trip_id") -> DataFrame:
    """(shape_id, part, feature text): lines with their route's attributes.

    A shape no trip uses carries its id alone; a used one keeps missing attributes
    as nulls.
    """
    attributes = routes.select("route_id", "route_short_name", "route_long_name", "route_type", "route_color")
    matched = shape_routes(trips, attributes, order_by).withColumn("_used", F.lit(True))
    rows = shape_lines(shapes).join(matched, "shape_id", "left")
    full = F.struct(
        "shape_id",
        text_or(F.col("route_id"), None).alias("route_id"),
        text_or(F.col("route_short_name")).alias("route_short_name"),
        text_or(F.col("route_long_name")).alias("route_long_name"),
        F.col("route_type").cast("int").alias("route_type"),
        hex_color(F.col("route_color")).alias("route_color"),
    )

    def text(properties: Column) -> Column:
        geometry = line_geometry(F.col("coordinates"))
        return F.to_json(
            F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")), KEEP_NULLS
        )

    return rows.select(
        "shape_id", F.when(F.col("_used"), text(full)).otherwise(text(F.struct("shape_id"))).alias("feature")
    )
