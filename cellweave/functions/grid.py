"""Raster georeferencing, pixel windows and the XYZ tile scheme."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellweave.functions.projection import GEOGRAPHIC, MERCATOR_HALF_WORLD

TILE_SIZE = 256


@dataclass(frozen=True)
class GridMeta:
    """A north-up raster: origin at the top-left corner."""

    width: int
    height: int
    sx: float
    sy: float
    ox: float
    oy: float
    crs: str = GEOGRAPHIC
    nodata: float | None = None

    @property
    def cells(self) -> int:
        return self.width * self.height

    @property
    def extent(self) -> tuple[float, float, float, float]:
        """west, south, east, north."""
        return self.ox, self.oy - self.height * self.sy, self.ox + self.width * self.sx, self.oy

    def window(self, w: float, e: float, s: float, n: float) -> tuple[int, int, int, int]:
        """Row and column ranges, end-exclusive, of a box within the raster."""
        c0 = max(0, math.floor((w - self.ox) / self.sx))
        c1 = min(self.width, math.ceil((e - self.ox) / self.sx))
        r0 = max(0, math.floor((self.oy - n) / self.sy))
        r1 = min(self.height, math.ceil((self.oy - s) / self.sy))
        return r0, max(r0, r1), c0, max(c0, c1)

    def clipped(self, w: float, e: float, s: float, n: float) -> GridMeta:
        """The georeferencing of that window."""
        r0, r1, c0, c1 = self.window(w, e, s, n)
        return replace(
            self, width=c1 - c0, height=r1 - r0, ox=self.ox + c0 * self.sx, oy=self.oy - r0 * self.sy
        )

    def columns(self) -> dict[str, Column]:
        """The fields as literals."""
        return {
            "width": F.lit(self.width),
            "height": F.lit(self.height),
            "sx": F.lit(float(self.sx)),
            "sy": F.lit(float(self.sy)),
            "ox": F.lit(float(self.ox)),
            "oy": F.lit(float(self.oy)),
        }


def bbox_window(m: dict[str, Column], w: Column, e: Column, s: Column, n: Column) -> Column:
    """STRUCT<r0, r1, c0, c1> of a box, end-exclusive, within the raster."""
    zero = F.lit(0).cast("bigint")
    c0 = F.greatest(zero, F.floor((w - m["ox"]) / m["sx"]))
    c1 = F.least(m["width"].cast("bigint"), F.ceil((e - m["ox"]) / m["sx"]))
    r0 = F.greatest(zero, F.floor((m["oy"] - n) / m["sy"]))
    r1 = F.least(m["height"].cast("bigint"), F.ceil((m["oy"] - s) / m["sy"]))
    return F.struct(r0.alias("r0"), r1.alias("r1"), c0.alias("c0"), c1.alias("c1"))


def pixel_center(m: dict[str, Column], row: Column, col: Column) -> tuple[Column, Column]:
    """Centre x, y of a cell."""
    return m["ox"] + (col + F.lit(0.5)) * m["sx"], m["oy"] - (row + F.lit(0.5)) * m["sy"]


def nearest_cell(m: dict[str, Column], x: Column, y: Column) -> tuple[Column, Column]:
    """Row and column of a position; outside positions take the edge cell."""
    col = ((x - m["ox"]) / m["sx"]).cast("bigint")
    row = ((m["oy"] - y) / m["sy"]).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return (
        F.least(F.greatest(row, zero), m["height"].cast("bigint") - 1),
        F.least(F.greatest(col, zero), m["width"].cast("bigint") - 1),
    )


def tile_xy(lon: Column, lat: Column, z: Column) -> Column:
    """STRUCT<x, y, px, py>: XYZ tile of a position and the pixel within it."""
    n = F.pow(F.lit(2.0), z)
    fx = (lon + 180.0) / 360.0 * n
    fy = (1 - F.asinh(F.tan(F.radians(lat))) / F.pi()) / 2 * n
    x, y = F.floor(fx), F.floor(fy)
    return F.struct(
        x.alias("x"),
        y.alias("y"),
        F.floor((fx - x) * TILE_SIZE).cast("int").alias("px"),
        F.floor((fy - y) * TILE_SIZE).cast("int").alias("py"),
    )


def tile_bounds(z: Column, x: Column, y: Column) -> Column:
    """STRUCT<west, south, east, north> of a tile in degrees."""
    n = F.pow(F.lit(2.0), z)

    def lon(v: Column) -> Column:
        return v / n * 360.0 - 180.0

    def lat(v: Column) -> Column:
        return F.degrees(F.atan(F.sinh(F.pi() * (1 - 2 * v / n))))

    return F.struct(
        lon(x).alias("west"), lat(y + 1).alias("south"), lon(x + 1).alias("east"), lat(y).alias("north")
    )


def tile_pixel_size(z: Column) -> Column:
    """Edge length of a tile pixel in Web Mercator metres."""
    return F.lit(2 * MERCATOR_HALF_WORLD / TILE_SIZE) / F.pow(F.lit(2.0), z)
