"""The published raster and solar products on derived scenes."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cellweave.functions.grid import GridMeta
from cellweave.functions.numeric import round_even
from cellweave.functions.projection import BETA, DELTA, RECTIFYING_RADIUS, UTM_22S, UTM_SCALE
from cellweave.operators import grid as OG
from cellweave.plans import products as PR
from cellweave.plans import solar as SO
from cellweave.queries import tables as T
from cellweave.queries.catalog import VIEWS, even, query
from cellweave.queries.cells import utm_sql
from cellweave.queries.registry_queries import palette_sql
from cellweave.queries.spatial_queries import inverse_grid, mercator_grid
from cellweave.queries.tile_twins import moments_sql, packed, tile_moments

WIDTH, HEIGHT = 50, 40
# Raw values of each product's derived scenes: start and step per unit of quantity.
RAW = {
    "ndvi": (-3000, 280), "night_lights": (0, 6.5), "elevation_30m": (-20, 260), "population": (-1, 2.25),
    "built_up": (-50, 210.5), "urbanisation": (-12, 1), "elevation_90m": (-60, 27.5), "height_above_drainage": (-3, 2.25),
    "upstream_area": (-5, 21.5), "forest_loss": (-24, 1), "tree_cover": (-2, 2.25), "water_transition": (-30, 1),
    "water_occurrence": (0, 2), "water_seasonality": (-10, 0.5), "flood_depth": (-0.25, 0.25), "pv_output": (2.75, 0.0625),
}
VIEWS["prod_obs"] = """
  SELECT layer, "row", "col", ts, image_id, img_ord, CASE WHEN band = 'R' THEN 'other' ELSE 'own' END AS band, value AS q, class FROM obs"""


def scene_meta(name: str) -> GridMeta:
    spec = PR.PRODUCTS[name]
    if name == "flood_depth":
        return GridMeta(WIDTH, HEIGHT, 20.0, 20.0, 475000.0, 6680000.0, UTM_22S)
    step = round((spec.scale or 250) * 1.5 / 111320, 7)
    west, _, _, north = spec.aoi or (-51.3, 0, 0, -30.0)
    return GridMeta(WIDTH, HEIGHT, step, step, round(west - 10 * step, 7), round(north + 10 * step, 7))


def product_obs(spark, d, name: str):
    """Observations as the product expects them, with values in its range."""
    spec = PR.PRODUCTS[name]
    rows = T.obs(spark, d).withColumn("band", F.when(F.col("band") == "R", "other").otherwise(spec.band))
    keys = ["layer", "row", "col"]
    if spec.reducer == "mode":
        return rows.withColumn("value", F.col("class"))
    lo, step = RAW[name]
    raw = F.lit(float(lo)) + F.lit(float(step)) * F.col("value")
    if spec.reducer == "mean":
        return rows.withColumn("value", raw)
    if spec.reducer == "mosaic":
        return rows.groupBy(*keys, "band", "image_id", "img_ord").agg(F.avg(raw).alias("value"))
    if spec.reducer == "first":
        epochs = rows.withColumn("image_id", F.year("ts").cast("string")).withColumn("img_ord", F.year("ts"))
        return epochs.groupBy(*keys, "band", "image_id", "img_ord").agg(F.avg(raw).alias("value"))
    return rows.groupBy(*keys, "band").agg(F.max(raw).alias("value"))


# The products whose images are first chosen by footprint: monthly images, or yearly epochs that span their months.
BOUNDED = {"land_cover": "month_footprints", "ndvi": "month_footprints", "night_lights": "month_footprints", "elevation_30m": "month_footprints", "population": "epoch_footprints"}
VIEWS["month_footprints"] = """
  SELECT image_id, img_ord, -51.9::DOUBLE + 0.1::DOUBLE * (img_ord % 12) AS west, CASE WHEN img_ord % 5 = 0 THEN -31.0::DOUBLE ELSE -30.6::DOUBLE END AS south,
    -51.7::DOUBLE + 0.1::DOUBLE * (img_ord % 12) AS east, CASE WHEN img_ord % 5 = 0 THEN -30.6::DOUBLE ELSE -29.7::DOUBLE END AS north
  FROM (SELECT DISTINCT image_id, img_ord FROM obs)"""
VIEWS["epoch_footprints"] = """
  SELECT substr(image_id, 1, 4) AS image_id, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north FROM month_footprints GROUP BY 1"""


def image_meta(spark, d, name: str):
    """Footprints of a collection's images; None where the product takes one image."""
    if name not in BOUNDED:
        return None
    images = T.obs(spark, d).select("image_id", "img_ord").distinct()
    shift, low = F.lit(0.1) * (F.col("img_ord") % 12), F.col("img_ord") % 5 == 0
    images = images.select(
        "image_id", (F.lit(-51.9) + shift).alias("west"), F.when(low, -31.0).otherwise(-30.6).alias("south"),
        (F.lit(-51.7) + shift).alias("east"), F.when(low, -30.6).otherwise(-29.7).alias("north"),
    )
    if BOUNDED[name] == "month_footprints":
        return images
    ends = [F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north")]
    return images.groupBy(F.substring("image_id", 1, 4).alias("image_id")).agg(*ends)


def composite_sql(name: str, bounded: bool = True) -> str:
    """SQL of the composite (layer, row, col, value) before rescaling."""
    spec = PR.PRODUCTS[name]
    where = "band = 'own'"
    if bounded and name in BOUNDED:
        west, south, east, north = spec.aoi
        image = 'year(ts)::VARCHAR' if spec.reducer == "first" else "image_id"
        where += f" AND {image} IN (SELECT image_id FROM {BOUNDED[name]} WHERE west <= {east} AND east >= {west} AND south <= {north} AND north >= {south})"
    if spec.year:
        where += f" AND ts >= TIMESTAMP '{spec.year}-01-01' AND ts < TIMESTAMP '{spec.year + 1}-01-01'"
    if spec.reducer == "mode":
        return f"""SELECT layer, "row", "col", class::DOUBLE AS value FROM prod_obs WHERE {where} GROUP BY layer, "row", "col", class
          QUALIFY row_number() OVER (PARTITION BY layer, "row", "col" ORDER BY count(*) DESC, class) = 1"""
    lo, step = RAW[name]
    raw = f"({float(lo)!r}::DOUBLE + {float(step)!r}::DOUBLE * q)"
    if spec.reducer == "mean":
        return f"""SELECT layer, "row", "col", avg({raw}) AS value FROM prod_obs WHERE {where} GROUP BY ALL"""
    if spec.reducer == "mosaic":
        return f"""SELECT layer, "row", "col", value FROM (SELECT layer, "row", "col", img_ord, avg({raw}) AS value FROM prod_obs WHERE {where} GROUP BY ALL) WHERE value IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY layer, "row", "col" ORDER BY img_ord DESC) = 1"""
    if spec.reducer == "first":
        return f"""SELECT layer, "row", "col", avg({raw}) AS value FROM prod_obs WHERE {where} AND year(ts) = {spec.image_id} GROUP BY ALL"""
    return f"""SELECT layer, "row", "col", max({raw}) AS value FROM prod_obs WHERE {where} GROUP BY ALL"""


def utm_to_mercator(e: float, n: float) -> tuple[float, float]:
    """One position, worked out without Spark."""
    k = UTM_SCALE * RECTIFYING_RADIUS
    xi, eta = (n - 1e7) / k, (e - 5e5) / k
    xi0 = xi - sum(b * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, b in enumerate(BETA, 1))
    eta0 = eta - sum(b * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, b in enumerate(BETA, 1))
    chi = math.asin(math.sin(xi0) / math.cosh(eta0))
    lat = chi + sum(c * math.sin(2 * j * chi) for j, c in enumerate(DELTA, 1))
    lon = math.radians(-51) + math.atan2(math.sinh(eta0), math.cos(xi0))
    return 6378137.0 * lon, 6378137.0 * math.log(math.tan(math.pi / 4 + lat / 2))


def utm_target(meta: GridMeta, scale: float) -> GridMeta:
    west, south, east, north = meta.extent
    steps = [i / 16 for i in range(17)]
    edge = [(west + (east - west) * t, y) for t in steps for y in (south, north)] + [(x, south + (north - south) * t) for t in steps for x in (west, east)]
    xs, ys = zip(*[utm_to_mercator(x, y) for x, y in edge])
    ox, oy = math.floor(min(xs) / scale) * scale, math.ceil(max(ys) / scale) * scale
    return GridMeta(math.ceil((max(xs) - ox) / scale), math.ceil((oy - min(ys)) / scale), scale, scale, ox, oy, "EPSG:3857")


def grid_sql(name: str, bounded: bool = True) -> str:
    """SQL views ending in ``moved``: the product's cells on the Web Mercator grid."""
    spec, meta = PR.PRODUCTS[name], scene_meta(name)
    comp = f"""comp AS (SELECT layer, "row", "col", value * {spec.factor!r}::DOUBLE AS value FROM ({composite_sql(name, bounded)}))""" if spec.factor != 1 else f"comp AS ({composite_sql(name, bounded)})"
    if name == "flood_depth":
        t = utm_target(meta, 20.0)
        r = "6378137.0::DOUBLE"
        return f"""WITH {comp}, t0 AS (SELECT j, i, degrees(({t.ox!r}::DOUBLE + (j + 0.5::DOUBLE) * 20.0::DOUBLE) / {r}) AS lon,
          degrees(2 * atan(exp(({t.oy!r}::DOUBLE - (i + 0.5::DOUBLE) * 20.0::DOUBLE) / {r})) - pi() / 2) AS lat
          FROM (SELECT unnest(range({t.width})) AS j), (SELECT unnest(range({t.height})) AS i)), t AS ({utm_sql('t0', 'lon', 'lat')}),
        moved AS (SELECT layer, i AS "row", j AS "col", value FROM t JOIN comp s ON s."col" = floor((t.e - 475000.0::DOUBLE) / 20.0::DOUBLE)::BIGINT
          AND s."row" = floor((6680000.0::DOUBLE - t.n) / 20.0::DOUBLE)::BIGINT)"""
    if spec.aoi is None:
        return f"WITH {comp}, {inverse_grid('comp', meta, mercator_grid(meta, PR.native_scale(meta)))}"
    w, s, e, n = spec.aoi
    r0, _, c0, _ = meta.window(w, e, s, n)
    window = meta.clipped(w, e, s, n)
    x = f"""({window.ox!r}::DOUBLE + ("col" - {c0} + 0.5::DOUBLE) * {meta.sx!r}::DOUBLE)"""
    y = f"""({window.oy!r}::DOUBLE - ("row" - {r0} + 0.5::DOUBLE) * {meta.sy!r}::DOUBLE)"""
    cut = f"""cut AS (SELECT layer, "row" - {r0} AS "row", "col" - {c0} AS "col", value FROM comp WHERE "row" >= {r0} AND "col" >= {c0} AND {x} BETWEEN {w} AND {e} AND {y} BETWEEN {s} AND {n})"""
    return f"WITH {comp}, {cut}, {inverse_grid('cut', window, mercator_grid(window, spec.scale))}"


def cast_sql(dtype: str) -> str:
    if dtype == "float32":
        return "value::FLOAT::DOUBLE"
    lo, hi = (0, 255) if dtype == "byte" else (-32768, 32767)
    return f"CASE WHEN value IS NOT NULL THEN least(greatest(round(value), {lo}), {hi})::DOUBLE END"


def nearest_sql(palette, channel: int) -> str:
    steps = " ".join(f"WHEN value <= {(lo[0] + hi[0]) / 2!r} THEN {lo[channel]}" for lo, hi in zip(palette, palette[1:]))
    return f"(CASE {steps} WHEN value IS NOT NULL THEN {palette[-1][channel]} END)::INTEGER"


# The codes listed in the value tables of three class products.
VALUE_CODES = {
    "urbanisation": ((-200, 0), (10, 10), (11, 11), (12, 12), (13, 13), (21, 21), (22, 22), (23, 23), (30, 30)),
    "forest_loss": ((0, 0), (1, 1)),
    "water_transition": ((0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (8, 8), (9, 9), (10, 10)),
}


def product_sql(name: str, bounded: bool = True) -> str:
    spec = PR.PRODUCTS[name]
    paint = nearest_sql if spec.nearest_color else lambda p, i: palette_sql("value", p, i)
    visual = ", ".join(f"{paint(spec.palette, i)} AS v{n}" for i, n in ((1, "r"), (2, "g"), (3, "b")))
    if spec.encoding == "terrain":
        code = f"least(greatest(round_even((value - ({spec.enc_offset!r}::DOUBLE)) / {spec.enc_scale!r}::DOUBLE, 0), 0), 16777215)"
        shifts = (16, 8, 0)
    elif spec.encoding == "packed":
        code = f"round_even(least(greatest(value + {spec.enc_offset!r}::DOUBLE, 0), {spec.cap}), 0)"
        shifts = (0, 8, 16)
    else:
        code, shifts = "round_even(least(greatest(value, 0), 255), 0)", (0, 8, 16)
        if name in VALUE_CODES:
            code = nearest_sql(VALUE_CODES[name], 1)
    encoded = ", ".join(f"((n >> {s}) & 255)::INTEGER AS e{c}" for s, c in zip(shifts, "rgb"))
    return f"""{grid_sql(name, bounded)}, cells AS (SELECT layer, "row", "col", {cast_sql(spec.dtype)} AS value FROM moved),
    coded AS (SELECT *, CASE WHEN value IS NULL THEN 0 ELSE {code}::BIGINT END AS n FROM cells)
    SELECT layer, "row", "col", {even('value', 6)} AS value, {visual}, {encoded} FROM coded"""


# Derived footprints do not follow the cells, so they would leave out images that lie in the area.
ALL_IMAGES = {"land_cover"}


def register(number: int, name: str) -> None:
    @query(f"p{number:02d}_{name}", product_sql(name, name not in ALL_IMAGES))
    def _(spark, d):
        spec = PR.PRODUCTS[name]
        footprints = None if name in ALL_IMAGES else image_meta(spark, d, name)
        grid, _ = PR.product_grid(PR.composite(product_obs(spark, d, name), spec, footprints), scene_meta(name), spec)
        shown = PR.colored(grid, spec)
        return shown.select(
            "layer", "row", "col", round_even(F.col("value"), 6).alias("value"),
            *[F.col(f"visual.{c}").alias(f"v{c}") for c in "rgb"], *[F.col(f"encoded.{c}").alias(f"e{c}") for c in "rgb"],
        )


for _number, _name in enumerate(PR.PRODUCTS, start=1):
    register(_number, _name)


# --- solar -----------------------------------------------------------------------------
FINE = GridMeta(50, 40, 0.0125, 0.0125, -51.45, -29.80)
ROUGH = GridMeta(17, 14, 0.0375, 0.0375, -51.45, -29.80)
# Whole numbers, so that sums and means agree between engines to the last bit.
SOLAR_COLUMNS = {"GHI": "max(l_quantity)", "DNI": "floor(max(l_extendedprice))", "GTI": "min(l_quantity)", "DIF": "max(round(l_discount * 100))"}
VIEWS["solar_cells"] = f"""
  SELECT 'L' || (l_partkey // 2000) AS layer, (l_partkey % 2000) // 50 AS "row", l_partkey % 50 AS "col",
    {', '.join(f'({e})::DOUBLE AS {n}' for n, e in SOLAR_COLUMNS.items())} FROM lineitem GROUP BY l_partkey"""
VIEWS["solar_rough"] = """
  SELECT 'L' || (l_partkey // 2000) AS layer, ((l_partkey % 2000) % 238) // 17 AS "row", (l_partkey % 2000) % 17 AS "col", max(round(l_tax * 100)) AS PVOUT FROM lineitem GROUP BY ALL"""
_FW, _RW = FINE.window(*SO.BOX), ROUGH.window(*SO.BOX)
_FM, _RM = FINE.clipped(*SO.BOX), ROUGH.clipped(*SO.BOX)
VIEWS["solar_table"] = f"""
  SELECT a.layer, a.x, a.y, {', '.join(f"{even(c, 3)} AS {c}" for c in ('GHI', 'DNI', 'GTI', 'DIF', 'PVOUT'))} FROM (
    SELECT layer, {_FM.ox!r}::DOUBLE + ("col" - {_FW[2]} + 0.5::DOUBLE) * 0.0125::DOUBLE AS x, {_FM.oy!r}::DOUBLE - ("row" - {_FW[0]} + 0.5::DOUBLE) * 0.0125::DOUBLE AS y, GHI,
      CASE WHEN ("row" + "col") % 9 <> 0 THEN DNI END AS DNI, GTI, DIF
    FROM solar_cells WHERE "row" >= {_FW[0]} AND "row" < {_FW[1]} AND "col" >= {_FW[2]} AND "col" < {_FW[3]}) a
  LEFT JOIN solar_rough b ON b.layer = a.layer AND b."col" - {_RW[2]} = least(greatest(trunc((a.x - ({_RM.ox!r}::DOUBLE)) / 0.0375)::BIGINT, 0), {_RM.width - 1})
   AND b."row" - {_RW[0]} = least(greatest(trunc(({_RM.oy!r}::DOUBLE - a.y) / 0.0375)::BIGINT, 0), {_RM.height - 1})
   AND b."row" >= {_RW[0]} AND b."row" < {_RW[1]} AND b."col" >= {_RW[2]} AND b."col" < {_RW[3]}"""


def solar_inputs(spark, d):
    li = T.read(spark, d, "lineitem")
    scene = F.concat(F.lit("L"), F.expr("l_partkey div 2000"))
    place = [scene.alias("layer"), F.expr("(l_partkey % 2000) div 50").alias("row"), (F.col("l_partkey") % 50).alias("col")]
    cells = li.groupBy(*place).agg(*[F.expr(f"cast({e} as double)").alias(n) for n, e in SOLAR_COLUMNS.items()])
    cells = cells.withColumn("DNI", F.when((F.col("row") + F.col("col")) % 9 != 0, F.col("DNI")))
    rough_place = [scene.alias("layer"), F.expr("((l_partkey % 2000) % 238) div 17").alias("row"), ((F.col("l_partkey") % 2000) % 17).alias("col")]
    rough = li.groupBy(*rough_place).agg(F.max(F.round(F.col("l_tax") * 100)).alias("value"))
    rasters = {n: cells.select(F.col("layer").alias("scene"), "row", "col", F.col(n).alias("value")) for n in SOLAR_COLUMNS}
    rasters["PVOUT"] = rough.select(F.col("layer").alias("scene"), "row", "col", "value")
    return rasters, {**{n: FINE for n in SOLAR_COLUMNS}, "PVOUT": ROUGH}


@query("p18_solar_pixels", "SELECT layer AS scene, x, y, GHI, DNI, GTI, DIF, PVOUT FROM solar_table")
def _(spark, d):
    return SO.solar_pixels(*solar_inputs(spark, d), keys=["scene"])


VIEWS["zone_vertices"] = """
  SELECT k, i, -51.40::DOUBLE + 0.05::DOUBLE * (k % 10) + dx / 100 AS x, -29.85::DOUBLE - 0.06::DOUBLE * ((k // 10) % 10) + dy / 100 AS y
  FROM (SELECT s_suppkey AS k FROM supplier), (VALUES (0, -7.0::DOUBLE, 0.0::DOUBLE), (1, 0.0, -7.0), (2, 7.0, 0.0), (3, 0.0, 7.0), (4, -7.0, 0.0)) o(i, dx, dy)"""


def zones(spark, d):
    k = F.col("s_suppkey")
    cx, cy = F.lit(-51.40) + F.lit(0.05) * (k % 10), F.lit(-29.85) - F.lit(0.06) * F.expr("(s_suppkey div 10) % 10")
    ring = F.array(*[F.struct((cx + x / 100).alias("x"), (cy + y / 100).alias("y")) for x, y in T.DIAMOND])
    return T.read(spark, d, "supplier").select(
        k.cast("string").alias("id"), F.col("s_name").alias("name"), k.cast("int").alias("ord"), F.array(F.array(ring)).alias("parts"),
        F.create_map(F.lit("kind"), F.lit("zone")).alias("props"),
    )


ZONE_HITS = """hits AS (SELECT p.*, e.k FROM solar_table p JOIN (SELECT a.k, a.x AS xi, a.y AS yi, b.x AS xj, b.y AS yj FROM zone_vertices a JOIN zone_vertices b ON a.k = b.k AND a.i = b.i + 1) e
    ON (e.yi > p.y) <> (e.yj > p.y) AND p.x < (e.xj - e.xi) * (p.y - e.yi) / (e.yj - e.yi + 1e-15) + e.xi GROUP BY ALL HAVING count(*) % 2 = 1)"""
ZONE_STATS = ", ".join(f"{even(f'avg({c})', 3)} AS {c}_mean, {even(f'max({c})', 3)} AS {c}_max" for c in SO.LAYERS)


@query("p19_solar_zones", f"WITH {ZONE_HITS} SELECT k::VARCHAR AS id, s_name AS name, k::INTEGER AS ord, count(*) AS n_solar_pixels, {ZONE_STATS} FROM hits JOIN supplier ON s_suppkey = k GROUP BY k, s_name")
def _(spark, d):
    return SO.solar_zones(SO.solar_pixels(*solar_inputs(spark, d), keys=["scene"]), zones(spark, d))


@query("p19_solar_features", f"WITH {ZONE_HITS} SELECT s_suppkey::VARCHAR AS id, 'zone' AS kind, n::VARCHAR AS n_solar_pixels FROM supplier LEFT JOIN (SELECT k, count(*) AS n FROM hits GROUP BY k) ON s_suppkey = k")
def _(spark, d):
    polygons = zones(spark, d)
    features = SO.solar_features(polygons, SO.solar_zones(SO.solar_pixels(*solar_inputs(spark, d), keys=["scene"]), polygons))
    return features.select("id", F.try_element_at("props", F.lit("kind")).alias("kind"), F.try_element_at("props", F.lit("n_solar_pixels")).alias("n_solar_pixels"))


VIEWS["painted"] = f"""SELECT layer, "row", "col", {', '.join(f"{palette_sql('(value / 500)', PR.PRODUCTS['elevation_30m'].palette, i)} AS {n}" for i, n in ((1, 'r'), (2, 'g'), (3, 'b')))} FROM scenes"""


VISUAL_SQL = moments_sql("SELECT * FROM painted", "r::BIGINT + g::BIGINT * 256 + b::BIGINT * 65536", T.SCENE)


@query("g06_visual_tiles", VISUAL_SQL)
@query("g06_visual_tiles_whole", VISUAL_SQL)
def _(spark, d):
    scaled = T.scenes(spark, d).withColumn("value", F.col("value") / 500)
    return tile_moments(PR.product_blocks(scaled, T.SCENE, PR.PRODUCTS["elevation_30m"], "visual"), packed())
