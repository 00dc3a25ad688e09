"""Whole tile sets as moments of each tile, and their SQL by separate lines of tile pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.grid import GridMeta

HALF = 20037508.342789244
RADIUS = "6378137.0::DOUBLE"


def packed(red: str = "r", green: str = "g", blue: str = "b") -> Column:
    """One whole number per colour."""
    return F.col(red).cast("bigint") + 256 * F.col(green).cast("bigint") + 65536 * F.col(blue).cast("bigint")


def tile_moments(blocks: DataFrame, code: Column) -> DataFrame:
    """(layer, z, x, y, n_px, codes, codes_px, codes_py): every pixel's code, alone and times its place in the tile.

    ``blocks`` holds the whole tile set as rectangles of equal pixels.
    """
    wide, high = (F.col(f"{p}1").cast("bigint") - F.col(f"{p}0") + 1 for p in ("px", "py"))
    places_px, places_py = (F.expr(f"(cast({p}0 as bigint) + {p}1) * ({p}1 - {p}0 + 1) div 2") for p in ("px", "py"))
    rows = blocks.select(
        "layer", "z", "x", "y", code.alias("code"), wide.alias("wide"), high.alias("high"), places_px.alias("places_px"), places_py.alias("places_py")
    )
    return rows.groupBy("layer", "z", "x", "y").agg(
        F.sum(F.expr("wide * high")).alias("n_px"), F.sum(F.expr("code * wide * high")).alias("codes"),
        F.sum(F.expr("code * places_px * high")).alias("codes_px"), F.sum(F.expr("code * places_py * wide")).alias("codes_py"),
    )


def _lines(grid: GridMeta, z: int, across: bool) -> str:
    """Tile pixel columns (or rows) of a zoom with the raster column (or row) each centre lies in."""
    import math

    west, south, east, north = grid.extent
    size = 2 * HALF / 256 / 2**z
    if grid.crs == "EPSG:4326":
        west, east = (6378137.0 * math.radians(v) for v in (west, east))
        south, north = (6378137.0 * math.log(math.tan(math.pi / 4 + math.radians(v) / 2)) for v in (south, north))
    first, last = (int((v + HALF) / size) for v in (west, east)) if across else (int((HALF - v) / size) for v in (north, south))
    place = f"(g + 0.5::DOUBLE) * {size!r}::DOUBLE"
    at = f"(-{HALF!r}::DOUBLE + {place})" if across else f"({HALF!r}::DOUBLE - {place})"
    if grid.crs == "EPSG:4326":
        at = f"degrees({at} / {RADIUS})" if across else f"degrees(2 * atan(exp({at} / {RADIUS})) - pi() / 2)"
    step = f"({at} - ({grid.ox!r}::DOUBLE)) / {grid.sx!r}::DOUBLE" if across else f"({grid.oy!r}::DOUBLE - {at}) / {grid.sy!r}::DOUBLE"
    return f"SELECT {z} AS z, g // 256 AS t, floor({step})::BIGINT AS cell, count(*) AS n, sum(g % 256)::BIGINT AS places FROM (SELECT unnest(range({first - 1}, {last + 2})) AS g) GROUP BY ALL"


def moments_sql(cells: str, code: str, grid: GridMeta, zooms: range = range(8, 16)) -> str:
    """SQL of ``tile_moments`` of a raster whose axes stay axes on the tile plane.

    A cell covers a rectangle of each tile it meets, so sums over its pixels are products
    of sums over columns and over rows.
    """
    across, down = (" UNION ALL ".join(_lines(grid, z, axis) for z in zooms) for axis in (True, False))
    return f"""SELECT layer, a.z AS z, a.t AS x, d.t AS y, sum(a.n * d.n)::BIGINT AS n_px, sum(code * a.n * d.n)::BIGINT AS codes,
      sum(code * a.places * d.n)::BIGINT AS codes_px, sum(code * a.n * d.places)::BIGINT AS codes_py
    FROM (SELECT layer, "row", "col", {code} AS code FROM ({cells})) c JOIN ({across}) a ON a.cell = c."col" JOIN ({down}) d ON d.cell = c."row" AND d.z = a.z
    GROUP BY layer, a.z, a.t, d.t"""
