"""Solar pixel table and neighbourhood averages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.grid import GridMeta
from cellweave.functions.numeric import round_even
from cellweave.operators.filters import drop_null
from cellweave.operators.grid import align, clip_bbox
from cellweave.operators.nested import merge_props
from cellweave.operators.ranking import dedupe_first
from cellweave.operators.spatial import zonal_stats

# The box (west, east, south, north), the layers and the anchor.
BOX = (-51.40, -50.90, -30.45, -29.85)
LAYERS = ("GHI", "PVOUT", "DNI", "GTI", "DIF")
ANCHOR = "GHI"


def solar_pixels(
    rasters: Mapping[str, DataFrame], metas: Mapping[str, GridMeta], box: Sequence[float] = BOX, anchor: str = ANCHOR, keys: Sequence[str] = ()
) -> DataFrame:
    """Clip every layer to the box, align on the anchor, drop empty cells, round."""
    clipped, windows = {}, {}
    for name, pixels in rasters.items():
        clipped[name], windows[name] = clip_bbox(pixels, metas[name], *box)
    names = list(rasters)
    table = drop_null(align(clipped, windows, anchor, keys), names, how="all")
    return table.select(*keys, "x", "y", *[round_even(F.col(n), 3).alias(n) for n in names])


def solar_zones(pixels: DataFrame, polygons: DataFrame, layers: Sequence[str] = LAYERS) -> DataFrame:
    """One row per neighbourhood feature with pixels: count, means and maxima."""
    stats = zonal_stats(pixels, polygons, layers, keys=("id", "name", "ord"))
    return stats.withColumnRenamed("n_pixels", "n_solar_pixels")


def solar_features(polygons: DataFrame, zones: DataFrame) -> DataFrame:
    """The polygons with the statistics merged into their properties, first row per id."""
    return merge_props(polygons, dedupe_first(zones, "id", "ord").drop("name", "ord"), "id")
