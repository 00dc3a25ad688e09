"""Scalar functions, filters and casts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import color as C
from cellweave.functions import grid as GR
from cellweave.functions import numeric as N
from cellweave.functions import projection as P
from cellweave.functions import text as TX
from cellweave.operators import filters as FL
from cellweave.operators import grid as OG
from cellweave.queries import tables as T
from cellweave.queries.catalog import even, query

LON = "(-51.40::DOUBLE + 0.58::DOUBLE * ((o_orderkey * 37 % 1000) / 10.0::DOUBLE) / 100)"
LAT = "(-30.42::DOUBLE + 0.54::DOUBLE * ((o_orderkey * 91 % 2000) / 10.0::DOUBLE) / 200)"
R = "6378137.0::DOUBLE"


def orders(spark, d):
    return T.read(spark, d, "orders")


def lineitem(spark, d):
    return T.read(spark, d, "lineitem")


@query("s01_round_even", f"SELECT o_orderkey, {even('o_totalprice / 7', 3)} AS v3, {even('(o_orderkey % 9) + 0.5::DOUBLE', 0)} AS v0 FROM orders")
def _(spark, d):
    half = (F.col("o_orderkey") % 9) + F.lit(0.5)
    return orders(spark, d).select("o_orderkey", N.round_even(F.col("o_totalprice") / 7, 3).alias("v3"), N.round_even(half, 0).alias("v0"))


@query("s02_ratio", "SELECT o_orderkey, o_totalprice / nullif(o_custkey % 5, 0) AS q FROM orders")
def _(spark, d):
    return orders(spark, d).select("o_orderkey", N.ratio(F.col("o_totalprice"), F.col("o_custkey") % 5).alias("q"))


@query("s03_complement", f"SELECT o_orderkey, {even('1.0::DOUBLE - (o_orderkey % 1000) / 999.0::DOUBLE', 4)} AS rest FROM orders")
def _(spark, d):
    share = (F.col("o_orderkey") % 1000) / F.lit(999.0)
    return orders(spark, d).select("o_orderkey", N.complement(share, 4).alias("rest"))


@query(
    "s04_bbox_window",
    f"""WITH b AS (SELECT o_orderkey, {LON} AS w, {LAT} AS s FROM orders)
    SELECT o_orderkey, greatest(0, floor((w - (-51.40::DOUBLE)) / 0.0025))::BIGINT AS c0,
      least(64, ceil((w + 0.05 - (-51.40::DOUBLE)) / 0.0025))::BIGINT AS c1,
      greatest(0, floor((-29.88::DOUBLE - (s + 0.04)) / 0.0025))::BIGINT AS r0,
      least(64, ceil((-29.88::DOUBLE - s) / 0.0025))::BIGINT AS r1 FROM b""",
)
def _(spark, d):
    lon, lat = T.lon_lat("o_orderkey")
    boxes = orders(spark, d).select("o_orderkey", lon.alias("w"), lat.alias("s"))
    w = GR.bbox_window(T.SCENE.columns(), F.col("w"), F.col("w") + 0.05, F.col("s"), F.col("s") + 0.04)
    return boxes.select("o_orderkey", w.alias("b")).select("o_orderkey", "b.c0", "b.c1", "b.r0", "b.r1")


@query(
    "s05_pixel_center",
    """SELECT layer, "row", "col", -51.40::DOUBLE + ("col" + 0.5::DOUBLE) * 0.0025::DOUBLE AS x,
       -29.88::DOUBLE - ("row" + 0.5::DOUBLE) * 0.0025::DOUBLE AS y FROM scenes""",
)
def _(spark, d):
    return OG.with_centers(T.scenes(spark, d), T.SCENE).select("layer", "row", "col", "x", "y")


@query("s06_affine", """SELECT layer, "row", "col", value * 0.0001::DOUBLE AS scaled FROM scenes""")
def _(spark, d):
    return T.scenes(spark, d).select("layer", "row", "col", N.affine(F.col("value"), 0.0001).alias("scaled"))


@query("s07_clamp", """SELECT layer, "row", "col", CASE WHEN value IS NULL THEN NULL ELSE least(greatest(value, 50000::DOUBLE), 300000::DOUBLE) END AS v FROM scenes""")
def _(spark, d):
    return T.scenes(spark, d).select("layer", "row", "col", N.clamp(F.col("value"), 50000.0, 300000.0).alias("v"))


@query("s08_rint", "SELECT o_orderkey, round_even(o_totalprice * 0.5, 0)::DOUBLE AS v FROM orders")
def _(spark, d):
    return orders(spark, d).select("o_orderkey", N.rint(F.col("o_totalprice") * 0.5).alias("v"))


PACK = "coalesce(round_even(least(greatest(value + {o}, 0), {cap}), 0)::BIGINT, 0)"


@query(
    "s09_encode_packed",
    f"""WITH n AS (SELECT layer, "row", "col", CASE WHEN value IS NULL THEN 0 ELSE {PACK.format(o=0, cap=12000)} END AS a,
          CASE WHEN value IS NULL THEN 0 ELSE {PACK.format(o=10000, cap=16777215)} END AS b FROM scenes)
    SELECT layer, "row", "col", (a & 255)::INTEGER AS r, ((a >> 8) & 255)::INTEGER AS g, ((a >> 16) & 255)::INTEGER AS b,
      (b & 255)::INTEGER AS r2, ((b >> 8) & 255)::INTEGER AS g2, ((b >> 16) & 255)::INTEGER AS b2 FROM n""",
)
def _(spark, d):
    v = F.col("value")
    e = T.scenes(spark, d).select("layer", "row", "col", C.encode_packed(v, 12000).alias("p"), C.encode_packed(v, offset=10000.0).alias("q"))
    return e.select("layer", "row", "col", "p.*", F.col("q.r").alias("r2"), F.col("q.g").alias("g2"), F.col("q.b").alias("b2"))


TERRAIN = "round_even((value / 1000 - (-1.0::DOUBLE)) / 0.001::DOUBLE, 0)::BIGINT"


@query(
    "s10_encode_terrain",
    f"""WITH n AS (SELECT layer, "row", "col", coalesce({TERRAIN}, 0) AS a FROM scenes)
    SELECT layer, "row", "col", (a >> 16)::INTEGER AS r, ((a >> 8) & 255)::INTEGER AS g, (a & 255)::INTEGER AS b FROM n""",
)
def _(spark, d):
    code = C.encode_terrain(F.col("value") / 1000, 0.001, -1.0)
    return T.scenes(spark, d).select("layer", "row", "col", code.alias("c")).select("layer", "row", "col", "c.*")


@query(
    "s11_decode_rgb",
    """WITH t AS (SELECT lut_id, coalesce(v, -1) AS v, r, g, b, ['terrain_rgb', 'rgb_packed', 'class_lookup'][1 + (r % 3)] AS kind FROM lut)
    SELECT lut_id, v, r, g, b, CASE kind WHEN 'terrain_rgb' THEN (r::DOUBLE * 65536 + g * 256 + b) * 0.5 + 3.0::DOUBLE
      WHEN 'rgb_packed' THEN (r::DOUBLE + g * 256 + b::DOUBLE * 65536) * 0.5 + 3.0::DOUBLE ELSE r::DOUBLE END AS decoded FROM t""",
)
def _(spark, d):
    kind = F.element_at(F.array(F.lit("terrain_rgb"), F.lit("rgb_packed"), F.lit("class_lookup")), F.col("r") % 3 + 1)
    decoded = C.decode_rgb(F.col("r"), F.col("g"), F.col("b"), kind, F.lit(0.5), F.lit(3.0))
    return T.lut(spark, d).select("lut_id", F.coalesce("v", F.lit(-1.0)).alias("v"), "r", "g", "b", decoded.alias("decoded"))


@query(
    "s14_to_mercator",
    f"""WITH p AS (SELECT o_orderkey, {LON} AS lon, {LAT} AS lat FROM orders),
    m AS (SELECT *, {R} * radians(lon) AS x, {R} * ln(tan(pi() / 4 + radians(lat) / 2)) AS y FROM p)
    SELECT o_orderkey, {even('x', 3)} AS x, {even('y', 3)} AS y, {even('lon', 9)} AS lon, {even('lat', 9)} AS lat FROM m""",
)
def _(spark, d):
    x, y = P.to_mercator(*T.lon_lat("o_orderkey"))
    m = orders(spark, d).select("o_orderkey", x.alias("x"), y.alias("y"))
    lon, lat = P.from_mercator(F.col("x"), F.col("y"))
    return m.select("o_orderkey", N.round_even(F.col("x"), 3).alias("x"), N.round_even(F.col("y"), 3).alias("y"), N.round_even(lon, 9).alias("lon"), N.round_even(lat, 9).alias("lat"))


def utm_sql(source: str, lon: str, lat: str) -> str:
    """Easting and northing columns e, n added to a relation with lon/lat expressions."""
    c, k = P.CONFORMAL_FACTOR, P.UTM_SCALE * P.RECTIFYING_RADIUS
    xi = " + ".join(["xi0", *[f"{a!r}::DOUBLE * sin({2 * j} * xi0) * cosh({2 * j} * eta0)" for j, a in enumerate(P.ALPHA, 1)]])
    eta = " + ".join(["eta0", *[f"{a!r}::DOUBLE * cos({2 * j} * xi0) * sinh({2 * j} * eta0)" for j, a in enumerate(P.ALPHA, 1)]])
    return f"""SELECT *, 500000::DOUBLE + {k!r}::DOUBLE * ({eta}) AS e, 10000000::DOUBLE + {k!r}::DOUBLE * ({xi}) AS n FROM (
      SELECT *, atan2(t, cos(a)) AS xi0, atanh(sin(a) / sqrt(1 + t * t)) AS eta0 FROM (
        SELECT *, sinh(atanh(sin(radians({lat}))) - {c!r}::DOUBLE * atanh({c!r}::DOUBLE * sin(radians({lat})))) AS t,
          radians({lon} + 51.0::DOUBLE) AS a FROM {source}))"""


@query(
    "s16_to_utm22s",
    f"""WITH p AS (SELECT o_orderkey, {LON} AS lon, {LAT} AS lat FROM orders), u AS ({utm_sql('p', 'lon', 'lat')})
    SELECT o_orderkey, {even('e', 3)} AS e, {even('n', 3)} AS n FROM u""",
)
def _(spark, d):
    e, n = P.to_utm22s(*T.lon_lat("o_orderkey"))
    return orders(spark, d).select("o_orderkey", N.round_even(e, 3).alias("e"), N.round_even(n, 3).alias("n"))


@query(
    "s17_utm22s_to_mercator",
    f"""WITH p AS (SELECT o_orderkey, {LON} AS lon, {LAT} AS lat FROM orders)
    SELECT o_orderkey, {even(f'{R} * radians(lon)', 1)} AS x, {even(f'{R} * ln(tan(pi() / 4 + radians(lat) / 2))', 1)} AS y FROM p""",
)
def _(spark, d):
    e, n = P.to_utm22s(*T.lon_lat("o_orderkey"))
    u = orders(spark, d).select("o_orderkey", e.alias("e"), n.alias("n"))
    x, y = P.utm22s_to_mercator(F.col("e"), F.col("n"))
    return u.select("o_orderkey", N.round_even(x, 1).alias("x"), N.round_even(y, 1).alias("y"))


@query(
    "s19_tile_xy",
    f"""WITH p AS (SELECT o_orderkey, {LON} AS lon, {LAT} AS lat, 8 + o_orderkey % 8 AS z FROM orders),
    f AS (SELECT *, (lon + 180) / 360.0::DOUBLE * pow(2::DOUBLE, z) AS fx, (1 - asinh(tan(radians(lat))) / pi()) / 2 * pow(2::DOUBLE, z) AS fy FROM p)
    SELECT o_orderkey, z, floor(fx)::BIGINT AS x, floor(fy)::BIGINT AS y, floor((fx - floor(fx)) * 256)::INTEGER AS px,
      floor((fy - floor(fy)) * 256)::INTEGER AS py FROM f""",
)
def _(spark, d):
    z = (F.col("o_orderkey") % 8 + 8).alias("z")
    lon, lat = T.lon_lat("o_orderkey")
    return orders(spark, d).select("o_orderkey", z, GR.tile_xy(lon, lat, z).alias("t")).select("o_orderkey", "z", "t.*")


@query(
    "s20_tile_bounds",
    f"""WITH t AS (SELECT o_orderkey, 8 + o_orderkey % 8 AS z, o_custkey % 200 AS x, o_orderkey % 211 AS y FROM orders)
    SELECT o_orderkey, {even('x / pow(2::DOUBLE, z) * 360 - 180', 9)} AS west, {even('(x + 1) / pow(2::DOUBLE, z) * 360 - 180', 9)} AS east,
      {even('degrees(atan(sinh(pi() * (1 - 2 * y / pow(2::DOUBLE, z)))))', 9)} AS north,
      {even('degrees(atan(sinh(pi() * (1 - 2 * (y + 1) / pow(2::DOUBLE, z)))))', 9)} AS south FROM t""",
)
def _(spark, d):
    z, x, y = F.col("o_orderkey") % 8 + 8, F.col("o_custkey") % 200, F.col("o_orderkey") % 211
    b = orders(spark, d).select("o_orderkey", GR.tile_bounds(z, x, y).alias("b"))
    return b.select("o_orderkey", *[N.round_even(F.col(f"b.{n}"), 9).alias(n) for n in ("west", "east", "north", "south")])


@query(
    "s21_fill_template",
    """SELECT dataset_id, 'tiles/' || dataset_id || '/release/v' || (k % 7) || '/' || size || '/{y}.png' AS url FROM ds""",
)
def _(spark, d):
    part = T.read(spark, d, "part")
    keys = {
        "dataset_id": F.concat(F.lit("ds"), F.col("p_partkey")), "version": F.concat(F.lit("v"), F.col("p_partkey") % 7), "period": F.col("p_size"),
    }
    return part.select(keys["dataset_id"].alias("dataset_id"), TX.fill_template("tiles/{dataset_id}/release/{version}/{period}/{y}.png", **keys).alias("url"))


@query("s22_deg_to_m", f"SELECT o_orderkey, {even('(o_orderkey % 100) * 0.0025::DOUBLE * 111320', 2)} AS m FROM orders")
def _(spark, d):
    return orders(spark, d).select("o_orderkey", N.round_even(N.deg_to_m((F.col("o_orderkey") % 100) * F.lit(0.0025)), 2).alias("m"))


@query("s23_hex_colors", "SELECT lut_id, coalesce(v, -1) AS v, printf('#%02X%02X%02X', r, g, b) AS hex, r, g, b FROM lut")
def _(spark, d):
    t = T.lut(spark, d).select("lut_id", F.coalesce("v", F.lit(-1.0)).alias("v"), C.rgb_to_hex(F.col("r"), F.col("g"), F.col("b")).alias("hex"))
    return t.select("lut_id", "v", "hex", C.hex_to_rgb(F.lower("hex")).alias("c")).select("lut_id", "v", "hex", "c.*")


@query("s24_year_range", "SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) AS start, make_date(year(o_orderdate) + 1, 1, 1) AS \"end\" FROM orders")
def _(spark, d):
    return orders(spark, d).select("o_orderkey", N.year_range(F.year("o_orderdate")).alias("y")).select("o_orderkey", "y.start", "y.end")


@query("s25_density", f"SELECT o_orderkey, {even('o_totalprice / nullif((o_custkey % 50)::DOUBLE, 0)', 1)} AS dens FROM orders")
def _(spark, d):
    return orders(spark, d).select("o_orderkey", N.density(F.col("o_totalprice"), F.col("o_custkey") % 50).alias("dens"))


@query("s26_resolution_m", "SELECT dataset_id, CASE WHEN resolution <> 'vector' THEN size::DOUBLE END AS m FROM ds")
def _(spark, d):
    return T.datasets(spark, d).select("dataset_id", N.resolution_m(F.col("resolution")).alias("m"))


# --- projections and filters -----------------------------------------------------------
@query("pf01_select_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, d):
    return FL.select_columns(orders(spark, d), "o_orderkey", "o_totalprice")


@query("pf02_select_band", """SELECT layer, "row", "col", image_id, value FROM obs WHERE band = 'R'""")
def _(spark, d):
    return FL.select_band(T.obs(spark, d), "R").select("layer", "row", "col", "image_id", "value")


@query("pf03_rename_columns", "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region, c.c_custkey AS customer FROM nation JOIN customer c ON c_nationkey = n_nationkey")
def _(spark, d):
    nation = FL.rename_columns(T.read(spark, d, "nation"), ["id", "name", "region"])
    customer = FL.rename_columns(T.read(spark, d, "customer").select("c_custkey", "c_nationkey"), {"c_custkey": "customer", "c_nationkey": "id"})
    return customer.join(nation, "id").select("id", "name", "region", "customer")


@query(
    "pf04_filter_bounds",
    """SELECT o.image_id, count(*) AS n, sum(value) AS total FROM obs o JOIN footprints f ON o.image_id = f.image_id
    WHERE west <= -50.82 AND east >= -51.40 AND south <= -29.88 AND north >= -30.42 GROUP BY o.image_id""",
)
def _(spark, d):
    kept = FL.filter_bounds(T.obs(spark, d), T.footprints(spark, d), (-51.40, -30.42, -50.82, -29.88))
    return kept.groupBy("image_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("pf05_filter_date", """SELECT layer, "row", "col", ts, value FROM obs WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01'""")
def _(spark, d):
    return FL.filter_date(T.obs(spark, d), "2024-01-01", "2025-01-01").select("layer", "row", "col", "ts", "value")


@query("pf06_filter_eq", """SELECT layer, "row", "col", value FROM obs WHERE image_id = '2025-03'""")
def _(spark, d):
    return FL.filter_eq(T.obs(spark, d), "image_id", "2025-03").select("layer", "row", "col", "value")


@query("pf07_drop_null_any", "SELECT stop_id, stop_lon, stop_lat FROM stops WHERE stop_lon IS NOT NULL AND stop_lat IS NOT NULL")
def _(spark, d):
    return FL.drop_null(T.stops(spark, d), ["stop_lat", "stop_lon"]).select("stop_id", "stop_lon", "stop_lat")


@query("pf08_drop_null_all", "SELECT stop_id, stop_name, stop_code FROM stops WHERE stop_name IS NOT NULL OR stop_code IS NOT NULL")
def _(spark, d):
    return FL.drop_null(T.stops(spark, d), ["stop_name", "stop_code"], how="all").select("stop_id", "stop_name", "stop_code")


@query("pf09_where_in", "SELECT neighbourhood_number, class_id, text FROM census_long WHERE class_id IN ('9681', '9682', '9692')")
def _(spark, d):
    return FL.where_in(T.census_long(spark, d), "class_id", ["9681", "9682", "9692"]).select("neighbourhood_number", "class_id", "text")


@query("pf10_class_equality", "SELECT neighbourhood_number, text FROM census_long WHERE class_id = '9680'")
def _(spark, d):
    return FL.filter_eq(T.census_long(spark, d), "class_id", "9680").select("neighbourhood_number", "text")


CLIP = (-51.3812, -51.3001, -29.9777, -29.9111)


@query(
    "pf11_clip_bbox",
    """WITH w AS (SELECT greatest(0, floor((-51.3812::DOUBLE + 51.40::DOUBLE) / 0.0025))::BIGINT AS c0, least(64, ceil((-51.3001::DOUBLE + 51.40::DOUBLE) / 0.0025))::BIGINT AS c1,
      greatest(0, floor((-29.88::DOUBLE + 29.9111::DOUBLE) / 0.0025))::BIGINT AS r0, least(64, ceil((-29.88::DOUBLE + 29.9777::DOUBLE) / 0.0025))::BIGINT AS r1)
    SELECT layer, "row" - r0 AS "row", "col" - c0 AS "col", value, -51.40::DOUBLE + c0 * 0.0025::DOUBLE AS ox, -29.88::DOUBLE - r0 * 0.0025::DOUBLE AS oy
    FROM scenes, w WHERE "row" >= r0 AND "row" < r1 AND "col" >= c0 AND "col" < c1""",
)
def _(spark, d):
    cut, meta = OG.clip_bbox(T.scenes(spark, d), T.SCENE, *CLIP)
    return cut.select("layer", "row", "col", "value", F.lit(meta.ox).alias("ox"), F.lit(meta.oy).alias("oy"))


@query(
    "pf11_clip_layers",
    """WITH m AS (SELECT DISTINCT layer, -51.40::DOUBLE + 0.0025::DOUBLE * (o_orderkey // 4096) AS ox FROM (SELECT 'S' || (o_orderkey // 4096) AS layer, o_orderkey FROM orders)),
    w AS (SELECT layer, ox, greatest(0, floor((-51.3812::DOUBLE - ox) / 0.0025))::BIGINT AS c0, least(64, ceil((-51.3001::DOUBLE - ox) / 0.0025))::BIGINT AS c1,
      greatest(0, floor((-29.88::DOUBLE + 29.9111::DOUBLE) / 0.0025))::BIGINT AS r0, least(64, ceil((-29.88::DOUBLE + 29.9777::DOUBLE) / 0.0025))::BIGINT AS r1 FROM m)
    SELECT s.layer, "row" - r0 AS "row", "col" - c0 AS "col", value FROM scenes s JOIN w USING (layer) WHERE "row" >= r0 AND "row" < r1 AND "col" >= c0 AND "col" < c1""",
)
def _(spark, d):
    k = F.expr("o_orderkey div 4096")
    meta = orders(spark, d).select(
        F.concat(F.lit("S"), k).alias("layer"), F.lit(64).alias("width"), F.lit(64).alias("height"), F.lit(0.0025).alias("sx"),
        F.lit(0.0025).alias("sy"), (F.lit(-51.40) + F.lit(0.0025) * k).alias("ox"), F.lit(-29.88).alias("oy"),
    ).distinct()
    return OG.clip_layers(T.scenes(spark, d), meta, *CLIP)[0].select("layer", "row", "col", "value")


@query(
    "pf13_cast_cells",
    """SELECT layer, "row", "col", least(greatest(round(value / 10), -32768), 32767)::SMALLINT AS as_int16,
      least(greatest(round(value / 1000 - 20), 0), 255)::SMALLINT AS as_byte, (value / 3)::FLOAT::DOUBLE AS as_float FROM scenes WHERE value IS NOT NULL""",
)
def _(spark, d):
    v = F.col("value")
    return T.scenes(spark, d).where(v.isNotNull()).select(
        "layer", "row", "col", N.cast_cell(v / 10, "int16").alias("as_int16"), N.cast_cell(v / 1000 - 20, "byte").alias("as_byte"),
        N.cast_cell(v / 3, "float32").cast("double").alias("as_float"),
    )


@query("pf14_to_number", "SELECT neighbourhood_number, class_id, value FROM census_long")
def _(spark, d):
    return T.census_long(spark, d).select("neighbourhood_number", "class_id", N.to_number(F.col("text")).alias("value"))


@query("pf15_fill_null", """SELECT layer, "row", "col", coalesce(value, 0) AS value FROM scenes""")
def _(spark, d):
    return FL.fill_null(T.scenes(spark, d), {"value": 0.0})


@query("pf16_text_or", "SELECT stop_id, coalesce(stop_name, '') AS stop_name, stop_code FROM stops")
def _(spark, d):
    return T.stops(spark, d).select("stop_id", TX.text_or(F.col("stop_name")).alias("stop_name"), TX.text_or(F.col("stop_code"), None).alias("stop_code"))


@query(
    "pf17_hex_color",
    "SELECT trip_id, CASE WHEN route_color IS NOT NULL THEN '#' || route_color END AS color FROM trips LEFT JOIN routes USING (route_id)",
)
def _(spark, d):
    joined = T.trips(spark, d).join(T.routes(spark, d), "route_id", "left")
    return joined.select("trip_id", C.hex_color(F.col("route_color")).alias("color"))


@query(
    "pf19_map_codes",
    """SELECT neighbourhood_number, class_id, CASE class_id WHEN '9681' THEN 'hh_inc_q1' WHEN '9682' THEN 'hh_inc_q2' WHEN '9683' THEN 'hh_inc_q3'
      WHEN '9684' THEN 'hh_inc_q4' WHEN '9692' THEN 'hh_inc_none' END AS label FROM census_long""",
)
def _(spark, d):
    from cellweave.plans.census import INCOME_BRACKETS

    return T.census_long(spark, d).select("neighbourhood_number", "class_id", TX.map_codes(F.col("class_id"), INCOME_BRACKETS).alias("label"))


@query("pf20_mask_nodata", """SELECT layer, "row", "col", value, coalesce(value, -9999) AS filled FROM scenes""")
def _(spark, d):
    cleaned = OG.clean_cells(T.scene_raw(spark, d), -9999.0)
    return cleaned.withColumn("filled", N.set_nodata(F.col("value"), -9999.0))


@query("pf21_is_valid", "SELECT layer, count(*) AS n, sum(CASE WHEN NOT isnan(value) THEN 1 ELSE 0 END)::BIGINT AS n_valid FROM scene_raw GROUP BY layer")
def _(spark, d):
    return T.scene_raw(spark, d).groupBy("layer").agg(F.count("*").alias("n"), F.count_if(N.is_valid(F.col("value"))).alias("n_valid"))


@query(
    "pf22_good_batches",
    """SELECT event_id, user_id, 1 AS part FROM events WHERE event_id % 7 <> 0
    UNION ALL SELECT sum(CASE WHEN event_id % 7 <> 0 THEN 1 ELSE 0 END)::BIGINT, sum(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END)::BIGINT, 2 FROM events""",
)
def _(spark, d):
    landed = T.read(spark, d, "events").withColumn("status", F.when(F.col("event_id") % 7 == 0, 503).otherwise(200))
    good = FL.good_batches(landed).select("event_id", "user_id", F.lit(1).alias("part"))
    report = FL.batch_report(landed).select(F.col("n_good").alias("event_id"), F.col("n_failed").alias("user_id"), F.lit(2).alias("part"))
    return good.unionByName(report)
