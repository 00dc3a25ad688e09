"""Raster windows, resampling, reprojection, overviews and tiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.grid import (
    TILE_SIZE,
    GridMeta,
    bbox_window,
    nearest_cell,
    pixel_center,
    tile_pixel_size,
)
from cellweave.functions.numeric import mask_nodata, round_even, set_nodata
from cellweave.functions.projection import (
    MERCATOR_HALF_WORLD,
    WEB_MERCATOR,
    is_separable,
    transform,
)
from cellweave.operators.sizing import BROADCAST_ROWS, join_small

META_FIELDS = ("width", "height", "sx", "sy", "ox", "oy")
MAX_EXPORT_PIXELS = 1e13


def with_centers(pixels: DataFrame, meta: GridMeta) -> DataFrame:
    """Add the centre x, y of every cell."""
    x, y = pixel_center(meta.columns(), F.col("row"), F.col("col"))
    return pixels.withColumns({"x": x, "y": y})


def clean_cells(pixels: DataFrame, nodata: float | None = None) -> DataFrame:
    """NaN and nodata cells become NULL."""
    return pixels.withColumn("value", mask_nodata(F.col("value"), nodata))


def fill_cells(pixels: DataFrame, nodata: float) -> DataFrame:
    """NULL cells become the nodata value."""
    return pixels.withColumn("value", set_nodata(F.col("value"), nodata))


def clip_bbox(pixels: DataFrame, meta: GridMeta, w: float, e: float, s: float, n: float) -> tuple[DataFrame, GridMeta]:
    """Cut a box out of one raster and move the origin.

    The window is known before the scan, so the row and column ranges are pushed down.
    """
    r0, r1, c0, c1 = meta.window(w, e, s, n)
    inside = (F.col("row") >= r0) & (F.col("row") < r1) & (F.col("col") >= c0) & (F.col("col") < c1)
    moved = pixels.where(inside).withColumns({"row": F.col("row") - r0, "col": F.col("col") - c0})
    return moved, meta.clipped(w, e, s, n)


def clip_layers(pixels: DataFrame, raster_meta: DataFrame, w: float, e: float, s: float, n: float) -> tuple[DataFrame, DataFrame]:
    """The same for many rasters, each with its own georeferencing row."""
    m = {f: F.col(f) for f in META_FIELDS}
    windows = raster_meta.withColumn("_w", bbox_window(m, *[F.lit(float(v)) for v in (w, e, s, n)]))
    moved_meta = windows.withColumns(
        {
            "width": F.greatest(F.col("_w.c1") - F.col("_w.c0"), F.lit(0)),
            "height": F.greatest(F.col("_w.r1") - F.col("_w.r0"), F.lit(0)),
            "ox": F.col("ox") + F.col("_w.c0") * F.col("sx"),
            "oy": F.col("oy") - F.col("_w.r0") * F.col("sy"),
        }
    ).drop("_w")
    joined = join_small(pixels, windows.select("layer", "_w.*"), "layer")
    inside = (
        (F.col("row") >= F.col("r0")) & (F.col("row") < F.col("r1"))
        & (F.col("col") >= F.col("c0")) & (F.col("col") < F.col("c1"))
    )
    moved = joined.where(inside).withColumns({"row": F.col("row") - F.col("r0"), "col": F.col("col") - F.col("c0")})
    return moved.drop("r0", "r1", "c0", "c1"), moved_meta


def resample_nearest(
    points: DataFrame, source: DataFrame, meta: GridMeta, value: str = "value", out: str = "value",
    keys: Sequence[str] = (), x: str = "x", y: str = "y",
) -> DataFrame:
    """Value of the raster cell at each point; outside points take the edge cell.

    ``keys`` are further columns both sides share (a scene, a layer).
    """
    row, col = nearest_cell(meta.columns(), F.col(x), F.col(y))
    cells = source.select(
        *keys, F.col("row").cast("bigint").alias("_r"), F.col("col").cast("bigint").alias("_c"), F.col(value).alias(out)
    )
    keyed = points.withColumns({"_r": row, "_c": col})
    return join_small(keyed, cells, [*keys, "_r", "_c"], "left").select(*points.columns, out)


def align(
    pixels: Mapping[str, DataFrame], metas: Mapping[str, GridMeta], anchor: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """(x, y, one column per layer) on the grid of the anchor, by default the finest layer.

    Layers of the anchor's shape are combined in one aggregation; others are looked up.
    """
    anchor = anchor or min(metas, key=lambda name: metas[name].sx * metas[name].sy)
    base = metas[anchor]

    def same_grid(name: str) -> bool:
        return (metas[name].width, metas[name].height) == (base.width, base.height)

    same = [n for n in pixels if same_grid(n)]
    stacked = None
    for name in same:
        one = pixels[name].select(*keys, F.lit(name).alias("layer"), "row", "col", "value")
        stacked = one if stacked is None else stacked.unionByName(one)
    present = F.max(F.col("layer") == anchor).alias("_anchor")
    grid = (
        stacked.groupBy(*keys, "row", "col")
        .agg(present, *[F.max(F.when(F.col("layer") == n, F.col("value"))).alias(n) for n in same])
        .where("_anchor")
        .drop("_anchor")
    )
    points = with_centers(grid, base)
    for name in pixels:
        if name not in same:
            points = resample_nearest(points, pixels[name], metas[name], out=name, keys=keys)
    return points.select(*keys, "row", "col", "x", "y", *pixels)


def _axis(a: Column, b: Column, origin: Column, size: Column, count: Column | None) -> Column:
    """Indices of the target cells whose centre may lie between two edges; one spare on each side."""
    u, v = (a - origin) / size, (b - origin) / size
    lo = F.floor(F.least(u, v) - 0.5)
    hi = F.ceil(F.greatest(u, v) - 0.5)
    if count is None:
        return F.sequence(lo, hi)
    lo, hi = F.greatest(lo, F.lit(0)), F.least(hi, count.cast("bigint") - 1)
    return F.when(lo <= hi, F.sequence(lo, F.greatest(lo, hi)))


def _cover(
    pixels: DataFrame, meta: GridMeta, target_crs: str, tox: Column, toy: Column, size: Column,
    width: Column | None, height: Column | None, reach: tuple[float, float] = (0.0, 0.0),
) -> DataFrame:
    """Target cells (_trow, _tcol) whose centre falls into each source cell.

    This is the inverse-mapped nearest lookup turned around: every source cell
    writes the target cells it owns, so no join and no shuffle is needed, and the
    inverse transform of the target centre still decides ownership exactly.
    """
    forward, back = transform(meta.crs, target_crs), transform(target_crs, meta.crs)
    m = meta.columns()
    row, col = F.col("row"), F.col("col")
    west, east = m["ox"] + col * m["sx"], m["ox"] + (col + 1) * m["sx"]
    north, south = m["oy"] - row * m["sy"], m["oy"] - (row + 1) * m["sy"]
    cx = tox + (F.col("_tcol") + 0.5) * size
    cy = toy - (F.col("_trow") + 0.5) * size

    def owns(x: Column | None, y: Column | None) -> Column:
        tests = []
        if x is not None:
            tests.append(F.floor((x - m["ox"]) / m["sx"]) == col)
        if y is not None:
            tests.append(F.floor((m["oy"] - y) / m["sy"]) == row)
        return tests[0] if len(tests) == 1 else tests[0] & tests[1]

    if is_separable(meta.crs, target_crs):
        middle_y, middle_x = (north + south) / 2, (west + east) / 2
        columns = _axis(forward(west, middle_y)[0], forward(east, middle_y)[0], tox, size, width)
        rows = _axis(-forward(middle_x, north)[1], -forward(middle_x, south)[1], -toy, size, height)
        across = pixels.withColumn("_tcol", F.explode(columns)).where(owns(back(cx, toy)[0], None))
        return across.withColumn("_trow", F.explode(rows)).where(owns(None, back(tox, cy)[1]))

    # One projected centre per cell; `reach` bounds how far the cell's image extends from it.
    staged = pixels.withColumns(dict(zip(("_fx", "_fy"), forward(*pixel_center(m, row, col)))))
    fx, fy = F.col("_fx"), F.col("_fy")
    columns = _axis(fx - reach[0], fx + reach[0], tox, size, width)
    rows = _axis(-fy - reach[1], -fy + reach[1], -toy, size, height)
    both = staged.withColumn("_tcol", F.explode(columns)).withColumn("_trow", F.explode(rows)).drop("_fx", "_fy")
    return both.where(owns(*back(cx, cy)))


# The error of an extent falls with the square of the steps: far below a millimetre for a whole UTM zone.
EDGE_STEPS = 1024
REACH_MARGIN = 1.25


def _edge_points(spark, meta: GridMeta) -> DataFrame:
    """Positions (x, y) along the raster's border."""
    west, south, east, north = meta.extent
    steps = [i / EDGE_STEPS for i in range(EDGE_STEPS + 1)]
    points = [(west + (east - west) * t, y) for t in steps for y in (south, north)]
    points += [(x, south + (north - south) * t) for t in steps for x in (west, east)]
    return spark.createDataFrame(points, "x DOUBLE, y DOUBLE")


def _reach(spark, meta: GridMeta, crs: str) -> tuple[float, float]:
    """Half-extent, with a margin, of any cell's image in another system.

    The systems are conformal and smooth, so the stretch over a raster is greatest
    on its border, where it is measured.
    """
    forward = transform(meta.crs, crs)
    edge = _edge_points(spark, meta)
    moved = {}
    for name, dx, dy in (("o", 0.0, 0.0), ("e", meta.sx, 0.0), ("n", 0.0, meta.sy)):
        moved[f"{name}x"], moved[f"{name}y"] = forward(F.col("x") + dx, F.col("y") + dy)
    spans = [F.max(F.abs(F.col(f"e{a}") - F.col(f"o{a}")) + F.abs(F.col(f"n{a}") - F.col(f"o{a}"))) for a in "xy"]
    x, y = edge.select(*[c.alias(n) for n, c in moved.items()]).agg(*spans).first()
    return REACH_MARGIN * x / 2, REACH_MARGIN * y / 2


def target_grid(spark, meta: GridMeta, crs: str, scale: float) -> GridMeta:
    """The grid that holds the whole raster in another system, anchored at multiples of ``scale``."""
    x, y = transform(meta.crs, crs)(F.col("x"), F.col("y"))
    border = _edge_points(spark, meta).select(x.alias("tx"), y.alias("ty"))
    ends = border.agg(F.min("tx"), F.min("ty"), F.max("tx"), F.max("ty")).first()
    ox, oy = math.floor(ends[0] / scale) * scale, math.ceil(ends[3] / scale) * scale
    return GridMeta(
        width=math.ceil((ends[2] - ox) / scale), height=math.ceil((oy - ends[1]) / scale),
        sx=scale, sy=scale, ox=ox, oy=oy, crs=crs, nodata=meta.nodata,
    )


def reproject(pixels: DataFrame, meta: GridMeta, crs: str, scale: float) -> tuple[DataFrame, GridMeta]:
    """Nearest-cell reprojection; target cells outside the source are not produced."""
    target = target_grid(pixels.sparkSession, meta, crs, scale)
    t = target.columns()
    reach = (0.0, 0.0) if is_separable(meta.crs, crs) else _reach(pixels.sparkSession, meta, crs)
    moved = _cover(pixels, meta, crs, t["ox"], t["oy"], t["sx"], t["width"], t["height"], reach)
    return moved.withColumns({"row": F.col("_trow"), "col": F.col("_tcol")}).drop("_trow", "_tcol"), target


def export_window(
    pixels: DataFrame, meta: GridMeta, region: Sequence[float], crs: str, scale: float, max_pixels: float = MAX_EXPORT_PIXELS
) -> tuple[DataFrame, GridMeta]:
    """Region ∩ raster in the target system and scale; too large a grid is refused before any scan."""
    west, south, east, north = map(float, region)
    cut, window = clip_bbox(pixels, meta, west, east, south, north)
    target = target_grid(pixels.sparkSession, window, crs, scale)
    if target.cells > max_pixels:
        raise ValueError(f"export of {target.cells} pixels exceeds {max_pixels:.0f}")
    x, y = pixel_center(window.columns(), F.col("row"), F.col("col"))
    return reproject(cut.where(x.between(west, east) & y.between(south, north)), window, crs, scale)


def tile(pixels: DataFrame, meta: GridMeta, z_min: int = 8, z_max: int = 15) -> DataFrame:
    """Tile pixels (z, x, y, px, py, ...) of zooms ``z_min``..``z_max``, nearest cell.

    Other columns ride along, so encoded channels are never blended. Tiles without
    a cell are not produced.
    """
    half = F.lit(MERCATOR_HALF_WORLD)
    zoomed = pixels.withColumn("z", F.explode(F.array(*[F.lit(z) for z in range(z_min, z_max + 1)])))
    cut = _cover(zoomed, meta, WEB_MERCATOR, -half, half, tile_pixel_size(F.col("z")), None, None)
    others = [c for c in pixels.columns if c not in ("row", "col")]
    n = F.lit(TILE_SIZE).cast("bigint")
    return cut.select(
        "z",
        F.floor(F.col("_tcol") / n).alias("x"),
        F.floor(F.col("_trow") / n).alias("y"),
        F.pmod(F.col("_tcol"), n).cast("int").alias("px"),
        F.pmod(F.col("_trow"), n).cast("int").alias("py"),
        *others,
    )


def _lines(spark, meta: GridMeta, z_min: int, z_max: int, across: bool) -> DataFrame:
    """(z, col, x, px0, px1) of the tile columns each raster column fills, or (z, row, y, py0, py1) of rows."""
    forward, back = transform(meta.crs, WEB_MERCATOR), transform(WEB_MERCATOR, meta.crs)
    half, size, m = F.lit(MERCATOR_HALF_WORLD), tile_pixel_size(F.col("z")), meta.columns()
    cell, tile_no, p = ("col", "x", "px") if across else ("row", "y", "py")
    line, at = F.col(cell), F.col("_at")
    if across:
        edges = [forward(m["ox"] + (line + k) * m["sx"], m["oy"])[0] for k in (0, 1)]
        place = (back(-half + (at + 0.5) * size, half)[0] - m["ox"]) / m["sx"]
    else:
        edges = [-forward(m["ox"], m["oy"] - (line + k) * m["sy"])[1] for k in (0, 1)]
        place = (m["oy"] - back(-half, half - (at + 0.5) * size)[1]) / m["sy"]
    lines = spark.range(meta.width if across else meta.height).withColumnRenamed("id", cell)
    zoomed = lines.withColumn("z", F.explode(F.array(*[F.lit(z) for z in range(z_min, z_max + 1)])))
    owned = zoomed.withColumn("_at", F.explode(_axis(*edges, -half, size, None))).where(F.floor(place) == line)
    n = F.lit(TILE_SIZE).cast("bigint")
    within = F.pmod(at, n).cast("int")
    return owned.groupBy("z", cell, F.floor(at / n).alias(tile_no)).agg(F.min(within).alias(f"{p}0"), F.max(within).alias(f"{p}1"))


def tile_blocks(pixels: DataFrame, meta: GridMeta, z_min: int = 8, z_max: int = 15) -> DataFrame:
    """All pixels of ``tile`` as rectangles (z, x, y, px0, px1, py0, py1, ...) of equal pixels, ends included.

    Where axes stay axes a cell fills one rectangle of each tile it meets, so one that
    covers 60 x 60 pixels of a fine zoom is a row there, not 3600. Which pixels a cell
    owns is worked out once per raster column and row.
    """
    ends = ["px0", "px1", "py0", "py1"]
    others = [c for c in pixels.columns if c not in ("row", "col")]
    if not is_separable(meta.crs, WEB_MERCATOR):
        single = tile(pixels, meta, z_min, z_max).withColumns({e: F.col(e[:2]) for e in ends})
        return single.select("z", "x", "y", *ends, *others)
    across, down = (_lines(pixels.sparkSession, meta, z_min, z_max, axis) for axis in (True, False))
    # A line meets few tiles of a zoom, so the number of lines bounds both tables.
    if max(meta.width, meta.height) * (z_max - z_min + 1) <= BROADCAST_ROWS // 4:
        across, down = F.broadcast(across), F.broadcast(down)
    return pixels.join(across, "col").join(down, ["z", "row"]).select("z", "x", "y", *ends, *others)


def block_pixels(blocks: DataFrame) -> DataFrame:
    """Tile pixels (z, x, y, px, py, ...) of rectangles."""
    others = [c for c in blocks.columns if c not in ("z", "x", "y", "px0", "px1", "py0", "py1")]
    across = blocks.withColumn("px", F.explode(F.sequence("px0", "px1")))
    return across.withColumn("py", F.explode(F.sequence("py0", "py1"))).select("z", "x", "y", "px", "py", *others)


def overviews(pixels: DataFrame, how: str, levels: int, keys: Sequence[str] = ("layer",), value: str = "value") -> DataFrame:
    """(keys, level, row, col, value): level 0 is the raster, each further level halves it.

    ``average`` takes the mean of the present cells of a 2x2 block, ``nearest``
    its top-left cell.
    """
    if how not in ("average", "nearest"):
        raise ValueError(f"unknown overview method {how!r}")
    current = pixels.select(*keys, "row", "col", value)
    result = current.withColumn("level", F.lit(0))
    parent = [F.shiftright("row", 1).alias("row"), F.shiftright("col", 1).alias("col")]
    for level in range(1, levels + 1):
        if how == "average":
            current = current.select(*keys, *parent, value).groupBy(*keys, "row", "col").agg(F.avg(value).alias(value))
            shown = current
        else:
            shift = 1 << level
            corner = (F.pmod("row", F.lit(shift)) == 0) & (F.pmod("col", F.lit(shift)) == 0)
            shown = pixels.where(corner).select(
                *keys, F.shiftright("row", level).alias("row"), F.shiftright("col", level).alias("col"), value
            )
        result = result.unionByName(shown.withColumn("level", F.lit(level)))
    return result.select(*keys, "level", "row", "col", value)


def block_density(pixels: DataFrame, block: int, cell_area: float, keys: Sequence[str] = ("layer",)) -> DataFrame:
    """Sum per block of cells over the block's area."""
    size = F.lit(int(block))
    blocks = pixels.select(*keys, F.floor(F.col("row") / size).alias("row"), F.floor(F.col("col") / size).alias("col"), "value")
    area = float(block * block * cell_area)
    return blocks.groupBy(*keys, "row", "col").agg(round_even(F.sum("value") / F.lit(area), 4).alias("density"))
