"""One parametrised raster product, and the seventeen published ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.color import MAX_24_BIT, encode_class, encode_packed, encode_terrain
from cellweave.functions.grid import GridMeta
from cellweave.functions.numeric import affine, cast_cell
from cellweave.functions.projection import GEOGRAPHIC, UTM_22S, WEB_MERCATOR
from cellweave.operators.aggregates import composite_mean, composite_mode, first_image, mosaic
from cellweave.operators.filters import filter_bounds, filter_date, filter_eq, select_band
from cellweave.operators.grid import export_window, overviews, reproject, tile, tile_blocks
from cellweave.operators.lut import palette_linear, palette_nearest
from cellweave.operators.nested import layer_metadata
from cellweave.plans import palettes as P
from cellweave.session import settle

# Areas of interest [west, south, east, north] and the zoom range.
AOI_A = (-51.30344, -30.26945, -51.018852, -29.932474)
AOI_B = (-51.40, -30.42, -50.82, -29.88)
Z_MIN, Z_MAX = 8, 15


@dataclass(frozen=True)
class ProductSpec:
    """What distinguishes one raster product from another."""

    layer: str
    band: str
    reducer: str  # mean | mode | mosaic | first | image | file
    palette: Sequence[tuple]
    aoi: Sequence[float] | None = AOI_A
    scale: float | None = None
    year: int | None = None
    image_id: str | None = None
    factor: float = 1.0
    dtype: str = "float32"
    overview: str = "nearest"
    nearest_color: bool = False
    encoding: str = "packed"  # packed | terrain | class
    enc_scale: float = 1.0
    enc_offset: float = 0.0
    cap: float = MAX_24_BIT
    codes: Sequence[tuple] = ()  # (value, code): a class takes the code of the nearest value
    source_crs: str = GEOGRAPHIC
    description: str = ""
    unit: str = ""
    time_period: str | None = None


# Parameters of the published products.
PRODUCTS = {
    "land_cover": ProductSpec(
        "land_cover", "label", "mode", P.LAND_COVER, AOI_A, 10, year=2025, dtype="byte", encoding="class"),
    "ndvi": ProductSpec(
        "ndvi", "NDVI", "mean", P.NDVI, AOI_B, 250, year=2024, factor=0.0001, overview="average", encoding="terrain",
        enc_scale=0.001, enc_offset=-1.0, description="Normalized Difference Vegetation Index (-1 to 1)",
        time_period="2024"),
    "night_lights": ProductSpec(
        "avg_rad", "avg_rad", "mean", P.NIGHT_LIGHTS, AOI_B, 500, year=2024, overview="average", encoding="terrain",
        enc_scale=0.1, description="Average DNB radiance (night lights)", unit="nW/cm²/sr", time_period="2024"),
    "elevation_30m": ProductSpec("elevation_30m", "DEM", "mosaic", P.ELEVATION_30M, AOI_A, 30, cap=12000),
    "population": ProductSpec(
        "population", "population_count", "first", P.POPULATION, AOI_B, 100, image_id="2025"),
    "built_up": ProductSpec("built_up", "built_surface", "image", P.BUILT_UP, AOI_B, 100, cap=10000),
    "urbanisation": ProductSpec(
        "urbanisation", "smod_code", "image", P.URBANISATION, AOI_B, 1000, dtype="int16", nearest_color=True,
        encoding="class", codes=P.URBANISATION_CODES),
    "elevation_90m": ProductSpec("elevation_90m", "elv", "image", P.ELEVATION_90M, AOI_A, 90, enc_offset=10000.0),
    "height_above_drainage": ProductSpec(
        "height_above_drainage", "hnd", "image", P.HEIGHT_ABOVE_DRAINAGE, AOI_A, 90),
    "upstream_area": ProductSpec("upstream_area", "upa", "image", P.UPSTREAM_AREA, AOI_A, 90),
    "forest_loss": ProductSpec(
        "forest_loss", "loss", "image", P.FOREST_LOSS, AOI_A, 30, dtype="byte", nearest_color=True, encoding="class",
        codes=P.FOREST_LOSS_CODES),
    "tree_cover": ProductSpec(
        "tree_cover", "treecover2000", "image", P.TREE_COVER, AOI_A, 30, dtype="byte", encoding="class"),
    "water_transition": ProductSpec(
        "water_transition", "transition", "image", P.WATER_TRANSITION, AOI_A, 30, dtype="byte", nearest_color=True,
        encoding="class", codes=P.WATER_TRANSITION_CODES),
    "water_occurrence": ProductSpec(
        "water_occurrence", "occurrence", "image", P.WATER_OCCURRENCE, AOI_A, 30, dtype="byte", encoding="class"),
    "water_seasonality": ProductSpec(
        "water_seasonality", "seasonality", "image", P.WATER_SEASONALITY, AOI_A, 30, dtype="byte", encoding="class"),
    "flood_depth": ProductSpec(
        "maxwaterdepth", "depth", "file", P.FLOOD_DEPTH, None, None, overview="average", encoding="terrain",
        enc_scale=0.01, source_crs=UTM_22S,
        description="Max water depth (m) — EMSN194 flood delineation, Porto Alegre May 2024", unit="m"),
    "pv_output": ProductSpec(
        "PVOUT", "PVOUT", "file", P.PV_OUTPUT, None, None, overview="average", encoding="terrain", enc_scale=0.001,
        description="PV Output (kWh/kWp/day)", unit="kWh/kWp/day", time_period="1999 to 2018"),
}


def composite(obs: DataFrame, spec: ProductSpec, image_meta: DataFrame | None = None, keys: Sequence[str] = ("layer", "row", "col")) -> DataFrame:
    """Observations to one value per cell, by the product's filters and reducer."""
    rows = select_band(obs, spec.band)
    if image_meta is not None and spec.aoi is not None:
        rows = filter_bounds(rows, image_meta, spec.aoi)
    if spec.year is not None:
        rows = filter_date(rows, f"{spec.year}-01-01", f"{spec.year + 1}-01-01")
    if spec.image_id is not None:
        rows = filter_eq(rows, "image_id", spec.image_id)
    if spec.reducer == "mean":
        return composite_mean(rows, keys)
    if spec.reducer == "mode":
        return composite_mode(rows, keys)
    if spec.reducer == "mosaic":
        return mosaic(rows, keys)
    if spec.reducer == "first":
        return first_image(rows).select(*keys, "value")
    if spec.reducer in ("image", "file"):
        return rows.select(*keys, "value")
    raise ValueError(f"unknown reducer {spec.reducer!r}")


def native_scale(meta: GridMeta) -> float:
    """Target cell size in metres that keeps the source resolution."""
    return meta.sx if meta.crs != GEOGRAPHIC else meta.sx * 111320.0


def product_grid(cells: DataFrame, meta: GridMeta, spec: ProductSpec) -> tuple[DataFrame, GridMeta]:
    """Rescale, clip, reproject to Web Mercator and cast."""
    if spec.factor != 1.0:
        cells = cells.withColumn("value", affine(F.col("value"), spec.factor))
    scale = spec.scale or native_scale(meta)
    if spec.aoi is None:
        grid, target = reproject(cells, meta, WEB_MERCATOR, scale)
    else:
        grid, target = export_window(cells, meta, spec.aoi, WEB_MERCATOR, scale)
    return grid.withColumn("value", cast_cell(F.col("value"), spec.dtype).cast("double")), target


def visual_color(value: Column, spec: ProductSpec) -> Column:
    """Display colour STRUCT<r, g, b>; NULL for a missing cell."""
    paint = palette_nearest if spec.nearest_color else palette_linear
    return paint(value, spec.palette)


def value_color(value: Column, spec: ProductSpec) -> Column:
    """Exact value encoding STRUCT<r, g, b>."""
    if spec.encoding == "terrain":
        return encode_terrain(value, spec.enc_scale, spec.enc_offset)
    if spec.encoding == "packed":
        return encode_packed(value, spec.cap, spec.enc_offset)
    if spec.codes:
        return encode_class(palette_nearest(value, [(v, c, 0, 0) for v, c in spec.codes])["r"])
    return encode_class(value)


def colored(grid: DataFrame, spec: ProductSpec) -> DataFrame:
    """Both encodings beside the value, before any resampling."""
    value = F.col("value")
    return grid.withColumns({"visual": visual_color(value, spec), "encoded": value_color(value, spec)})


def painted(grid: DataFrame, spec: ProductSpec, encode: str) -> DataFrame:
    """(layer, row, col, r, g, b) in the ``visual`` or ``value`` encoding."""
    if encode not in ("visual", "value"):
        raise ValueError(f"unknown encoding {encode!r}")
    paint = visual_color if encode == "visual" else value_color
    return grid.select("layer", "row", "col", paint(F.col("value"), spec).alias("_c")).select("layer", "row", "col", "_c.*")


def product_tiles(grid: DataFrame, target: GridMeta, spec: ProductSpec, encode: str, z_min: int = Z_MIN, z_max: int = Z_MAX) -> DataFrame:
    """Tile pixels of the ``visual`` or ``value`` set: encoded first, cut afterwards."""
    return tile(painted(grid, spec, encode), target, z_min, z_max)


def product_blocks(grid: DataFrame, target: GridMeta, spec: ProductSpec, encode: str, z_min: int = Z_MIN, z_max: int = Z_MAX) -> DataFrame:
    """The same pixels as rectangles."""
    return tile_blocks(painted(grid, spec, encode), target, z_min, z_max)


def raster_product(
    obs: DataFrame, meta: GridMeta, spec: ProductSpec, image_meta: DataFrame | None = None, levels: int = 5,
    z_min: int = Z_MIN, z_max: int = Z_MAX, reuse: bool = True,
) -> dict[str, DataFrame]:
    """Grid, overviews, both tile sets and the metadata document of a product.

    Tile sets come as pixels and, as ``_blocks``, as rectangles of equal pixels. With
    ``reuse`` the reprojected grid is written once to the shared folder for its consumers.
    """
    grid, target = product_grid(composite(obs, spec, image_meta), meta, spec)
    if reuse:
        grid = settle(grid)
    return {
        "grid": grid,
        "overviews": overviews(grid, spec.overview, levels),
        **{f"{kind}_tiles": product_tiles(grid, target, spec, kind, z_min, z_max) for kind in ("visual", "value")},
        **{f"{kind}_blocks": product_blocks(grid, target, spec, kind, z_min, z_max) for kind in ("visual", "value")},
        "metadata": layer_metadata(spec_row(obs.sparkSession, spec)),
    }


def spec_row(spark, spec: ProductSpec) -> DataFrame:
    """The registry row behind a product's metadata document."""
    kind = {"terrain": "terrain_rgb", "packed": "rgb_packed", "class": "class_lookup"}[spec.encoding]
    return spark.range(1).select(
        F.lit(spec.layer).alias("layer"),
        F.lit(spec.description).alias("description"),
        F.lit(spec.time_period).cast("string").alias("time_period"),
        F.lit(kind).alias("type"),
        F.lit(float(spec.enc_scale)).alias("scale"),
        F.lit(0.0 - spec.enc_offset if spec.encoding == "packed" else float(spec.enc_offset)).alias("offset"),
        F.lit(spec.unit).alias("unit"),
    )
