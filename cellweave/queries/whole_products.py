"""All outputs of the seventeen raster products: pyramid, both tile sets of zooms 8 to 15 and metadata, with footprints."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from cellweave.functions.numeric import round_even
from cellweave.plans import products as PR
from cellweave.queries.catalog import even, query
from cellweave.queries.product_queries import grid_sql, cast_sql, image_meta, product_obs, product_sql, scene_meta, utm_target
from cellweave.queries.spatial_queries import mercator_grid
from cellweave.queries.tile_twins import moments_sql, packed, tile_moments

LEVELS = 5


def target(name: str):
    """The product's grid, worked out without Spark."""
    spec, meta = PR.PRODUCTS[name], scene_meta(name)
    if name == "flood_depth":
        return utm_target(meta, 20.0)
    if spec.aoi is None:
        return mercator_grid(meta, PR.native_scale(meta))
    west, south, east, north = spec.aoi
    return mercator_grid(meta.clipped(west, east, south, north), spec.scale)


def made(spark, d: str, name: str) -> dict:
    return PR.raster_product(product_obs(spark, d, name), scene_meta(name), PR.PRODUCTS[name], image_meta(spark, d, name), levels=LEVELS)


def overviews_sql(name: str) -> str:
    spec = PR.PRODUCTS[name]
    cells = f"""{grid_sql(name)}, l0 AS (SELECT layer, "row", "col", {cast_sql(spec.dtype)} AS value FROM moved)"""
    if spec.overview == "average":
        steps = "".join(f""", l{k} AS (SELECT layer, "row" // 2 AS "row", "col" // 2 AS "col", avg(value) AS value FROM l{k - 1} GROUP BY ALL)""" for k in range(1, LEVELS + 1))
    else:
        steps = "".join(f""", l{k} AS (SELECT layer, "row" >> {k} AS "row", "col" >> {k} AS "col", value FROM l0 WHERE "row" % {2**k} = 0 AND "col" % {2**k} = 0)""" for k in range(1, LEVELS + 1))
    return cells + steps + " " + " UNION ALL ".join(f"""SELECT layer, {k} AS level, "row", "col", {even('value', 6)} AS value FROM l{k}""" for k in range(LEVELS + 1))


# How each encoding is read back.
DECODING = {
    "terrain": ("terrain_rgb", "value = (R * 256 * 256 + G * 256 + B) * scale + offset"),
    "packed": ("rgb_packed", "value = R + 256*G + 65536*B"),
    "class": ("class_lookup", "value = R"),
}


def metadata_sql(name: str) -> str:
    spec = PR.PRODUCTS[name]
    kind, formula = DECODING[spec.encoding]
    if kind == "rgb_packed" and spec.enc_offset:
        formula += " + offset"
    document = {"layer": spec.layer, "description": spec.description, "time_period": spec.time_period}
    offset = 0.0 - spec.enc_offset if kind == "rgb_packed" else spec.enc_offset
    document["encoding"] = {"type": kind, "scale": float(spec.enc_scale), "offset": float(offset), "unit": spec.unit, "decode_formula": formula}
    if document["time_period"] is None:
        del document["time_period"]
    text = json.dumps(document, separators=(",", ":"), ensure_ascii=False).replace("'", "''")
    return f"""{grid_sql(name)} SELECT layer AS scene, count(*) AS n_cells, min("row") AS first_row, max("row") AS last_row, min("col") AS first_col, max("col") AS last_col, '{text}' AS document FROM moved GROUP BY layer"""


def register(number: int, name: str) -> None:
    head, spec = f"p{number:02d}_{name}", PR.PRODUCTS[name]

    @query(f"{head}_overviews", overviews_sql(name))
    def _(spark, d):
        return made(spark, d, name)["overviews"].select("layer", "level", "row", "col", round_even(F.col("value"), 6).alias("value"))

    for kind, mark in (("visual", "v"), ("value", "e")):
        code = " + ".join(f"{mark}{c}::BIGINT * {k}" for c, k in (("r", 1), ("g", 256), ("b", 65536)))

        @query(f"{head}_{kind}_tiles", moments_sql(product_sql(name), code, target(name)))
        def _(spark, d, kind=kind):
            return tile_moments(made(spark, d, name)[f"{kind}_blocks"], packed())

    @query(f"{head}_metadata", metadata_sql(name))
    def _(spark, d):
        done = made(spark, d, name)
        extent = done["grid"].groupBy(F.col("layer").alias("scene")).agg(
            F.count(F.lit(1)).alias("n_cells"), F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.min("col").alias("first_col"), F.max("col").alias("last_col")
        )
        # The metadata of a product is one row.
        return extent.crossJoin(F.broadcast(done["metadata"].select("document")))


for _number, _name in enumerate(PR.PRODUCTS, start=1):
    register(_number, _name)
