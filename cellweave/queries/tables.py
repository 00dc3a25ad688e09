"""Geospatial inputs derived from the given tables, as DataFrames and as SQL views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.geometry import PARTS
from cellweave.functions.grid import GridMeta
from cellweave.queries.catalog import VIEWS


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- one tall raster, a cell per order -------------------------------------------------
FIELD_WIDTH = 128
VIEWS["field_cells"] = """
  SELECT o_orderkey // 128 AS "row", o_orderkey % 128 AS "col",
         CASE WHEN o_orderkey % 97 <> 0 THEN floor(o_totalprice) END AS value FROM orders"""
VIEWS["field_points"] = """
  SELECT "row", "col", value, "col" + 0.5::DOUBLE AS x, -("row" + 0.5::DOUBLE) AS y FROM field_cells"""


def field_cells(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    return o.select(
        F.expr("o_orderkey div 128").alias("row"),
        (F.col("o_orderkey") % 128).alias("col"),
        F.when(F.col("o_orderkey") % 97 != 0, F.floor("o_totalprice").cast("double")).alias("value"),
    )


def field_points(spark: SparkSession, d: str) -> DataFrame:
    return field_cells(spark, d).withColumns({"x": F.col("col") + F.lit(0.5), "y": -(F.col("row") + F.lit(0.5))})


# --- many scenes of 64 x 64 cells ------------------------------------------------------
SCENE = GridMeta(64, 64, 0.0025, 0.0025, -51.40, -29.88)
VIEWS["scene_raw"] = """
  SELECT 'S' || (o_orderkey // 4096) AS layer, (o_orderkey % 4096) // 64 AS "row", o_orderkey % 64 AS "col",
         CASE WHEN o_orderkey % 97 = 0 THEN -9999.0::DOUBLE
              WHEN o_orderkey % 89 = 0 THEN 'NaN'::DOUBLE ELSE o_totalprice END AS value FROM orders"""
VIEWS["scenes"] = """
  SELECT layer, "row", "col", CASE WHEN isnan(value) OR value = -9999 THEN NULL ELSE value END AS value
  FROM scene_raw"""


def scene_raw(spark: SparkSession, d: str) -> DataFrame:
    o, k = read(spark, d, "orders"), F.col("o_orderkey")
    value = F.when(k % 97 == 0, F.lit(-9999.0)).when(k % 89 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return o.select(
        F.concat(F.lit("S"), F.expr("o_orderkey div 4096")).alias("layer"),
        F.expr("(o_orderkey % 4096) div 64").alias("row"),
        (k % 64).alias("col"),
        value.alias("value"),
    )


def scenes(spark: SparkSession, d: str) -> DataFrame:
    from cellweave.operators.grid import clean_cells

    return clean_cells(scene_raw(spark, d), -9999.0)


# --- image series ----------------------------------------------------------------------
OBS_META = GridMeta(50, 40, 0.01, 0.01, -51.45, -29.80)
VIEWS["obs"] = """
  SELECT 'L' || (l_partkey // 2000) AS layer, (l_partkey % 2000) // 50 AS "row", l_partkey % 50 AS "col",
         l_shipdate + INTERVAL 24 YEAR AS ts, strftime(l_shipdate + INTERVAL 24 YEAR, '%Y-%m') AS image_id,
         (year(l_shipdate) + 24) * 12 + month(l_shipdate) AS img_ord, l_returnflag AS band,
         CASE WHEN (l_partkey + l_suppkey) % 19 <> 0 THEN l_quantity END AS value, l_linenumber AS class
  FROM lineitem"""
VIEWS["series"] = """
  SELECT layer, "row", "col", image_id, img_ord, avg(value) AS value FROM obs
  GROUP BY layer, "row", "col", image_id, img_ord"""


def obs(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem")
    ts = F.col("l_shipdate") + F.expr("INTERVAL 24 YEAR")
    return li.select(
        F.concat(F.lit("L"), F.expr("l_partkey div 2000")).alias("layer"),
        F.expr("(l_partkey % 2000) div 50").alias("row"),
        (F.col("l_partkey") % 50).alias("col"),
        ts.alias("ts"),
        F.date_format(ts, "yyyy-MM").alias("image_id"),
        ((F.year("l_shipdate") + 24) * 12 + F.month("l_shipdate")).alias("img_ord"),
        F.col("l_returnflag").alias("band"),
        F.when((F.col("l_partkey") + F.col("l_suppkey")) % 19 != 0, F.col("l_quantity")).alias("value"),
        F.col("l_linenumber").alias("class"),
    )


def series(spark: SparkSession, d: str) -> DataFrame:
    return obs(spark, d).groupBy("layer", "row", "col", "image_id", "img_ord").agg(F.avg("value").alias("value"))


# --- image footprints ------------------------------------------------------------------
VIEWS["footprints"] = """
  SELECT image_id, -51.9::DOUBLE + 0.01::DOUBLE * (img_ord % 100) AS west, -30.6::DOUBLE + 0.01::DOUBLE * (img_ord % 70) AS south,
         -51.7::DOUBLE + 0.01::DOUBLE * (img_ord % 100) AS east, -30.4::DOUBLE + 0.01::DOUBLE * (img_ord % 70) AS north
  FROM (SELECT DISTINCT image_id, img_ord FROM obs)"""


def footprints(spark: SparkSession, d: str) -> DataFrame:
    images = obs(spark, d).select("image_id", "img_ord").distinct()
    a, b = F.lit(0.01) * (F.col("img_ord") % 100), F.lit(0.01) * (F.col("img_ord") % 70)
    return images.select(
        "image_id", (F.lit(-51.9) + a).alias("west"), (F.lit(-30.6) + b).alias("south"),
        (F.lit(-51.7) + a).alias("east"), (F.lit(-30.4) + b).alias("north"),
    )


# --- polygons, one per supplier --------------------------------------------------------
DIAMOND = ((-7.0, 0.0), (0.0, -7.0), (7.0, 0.0), (0.0, 7.0), (-7.0, 0.0))
SQUARE = ((3.0, 3.0), (7.0, 3.0), (7.0, 7.0), (3.0, 7.0), (3.0, 3.0))
HOLE = ((-2.0, 0.0), (0.0, -3.0), (2.0, 0.0), (0.0, 3.0), (-2.0, 0.0))


def _offsets() -> str:
    rows = []
    for part, ring, points in ((0, 0, DIAMOND), (0, 1, HOLE), (1, 0, SQUARE)):
        rows += [f"({part}, {ring}, {i}, {x}::DOUBLE, {y}::DOUBLE)" for i, (x, y) in enumerate(points)]
    return ", ".join(rows)


VIEWS["centers"] = """
  SELECT s_suppkey AS k, 'P' || s_suppkey AS id, s_name AS name, s_suppkey::INTEGER AS ord,
         6.4::DOUBLE + 12.8::DOUBLE * (s_suppkey % 10) AS cx, -(6.0::DOUBLE + 12.0::DOUBLE * (s_suppkey // 10)) AS cy
  FROM supplier"""
VIEWS["vertices"] = f"""
  SELECT id, name, c.ord, part, ring, i, cx + dx AS x, cy + dy AS y
  FROM centers c, (VALUES {_offsets()}) o(part, ring, i, dx, dy)
  WHERE k % 11 <> 10 AND (part = 0 OR k % 2 = 0) AND (ring = 0 OR k % 5 = 0)"""
VIEWS["edges"] = """
  SELECT a.id, a.name, a.ord, a.part, a.ring, a.x AS xi, a.y AS yi, b.x AS xj, b.y AS yj
  FROM vertices a JOIN vertices b ON a.id = b.id AND a.part = b.part AND a.ring = b.ring AND a.i = b.i + 1"""
VIEWS["boxes"] = """
  SELECT id, name, ord, min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y
  FROM vertices WHERE ring = 0 GROUP BY id, name, ord"""
VIEWS["inside"] = """
  SELECT DISTINCT "row", "col", value, x, y, id, name, ord FROM (
    SELECT p."row", p."col", p.value, p.x, p.y, e.id, e.name, e.ord, e.part
    FROM field_points p
    JOIN boxes b ON p.x >= b.min_x AND p.x <= b.max_x AND p.y >= b.min_y AND p.y <= b.max_y
    JOIN edges e ON e.id = b.id AND e.ring = 0
     AND (e.yi > p.y) <> (e.yj > p.y) AND p.x < (e.xj - e.xi) * (p.y - e.yi) / (e.yj - e.yi + 1e-15) + e.xi
    GROUP BY ALL HAVING count(*) % 2 = 1)"""


def polygons(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    cx = F.lit(6.4) + F.lit(12.8) * (k % 10)
    cy = -(F.lit(6.0) + F.lit(12.0) * F.expr("s_suppkey div 10"))

    def ring(offsets) -> Column:
        return F.array(*[F.struct((cx + x).alias("x"), (cy + y).alias("y")) for x, y in offsets])

    diamond = F.when(k % 5 == 0, F.array(ring(DIAMOND), ring(HOLE))).otherwise(F.array(ring(DIAMOND)))
    parts = F.when(k % 11 == 10, F.array().cast(PARTS)).when(k % 2 == 0, F.array(diamond, F.array(ring(SQUARE)))).otherwise(F.array(diamond))
    return read(spark, d, "supplier").select(
        F.concat(F.lit("P"), k).alias("id"), F.col("s_name").alias("name"), k.cast("int").alias("ord"), parts.alias("parts"),
        F.create_map(F.lit("id"), F.concat(F.lit("P"), k), F.lit("name"), F.col("s_name")).alias("props"),
    )


# --- positions -------------------------------------------------------------------------
def _lon(k: str) -> str:
    return f"(-51.40::DOUBLE + 0.58::DOUBLE * (({k} * 37 % 1000) / 10.0::DOUBLE) / 100)"


def _lat(k: str) -> str:
    return f"(-30.42::DOUBLE + 0.54::DOUBLE * (({k} * 91 % 2000) / 10.0::DOUBLE) / 200)"


def lon_lat(key: str) -> tuple[Column, Column]:
    k = F.col(key)
    return (
        F.lit(-51.40) + F.lit(0.58) * ((k * 37 % 1000) / F.lit(10.0)) / 100,
        F.lit(-30.42) + F.lit(0.54) * ((k * 91 % 2000) / F.lit(10.0)) / 200,
    )


VIEWS["stops"] = f"""
  SELECT c_custkey::VARCHAR AS stop_id, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS stop_name,
         CASE WHEN c_custkey % 3 <> 0 THEN '0' || c_nationkey END AS stop_code,
         CASE WHEN c_custkey % 97 <> 0 THEN {_lon('c_custkey')} END AS stop_lon,
         CASE WHEN c_custkey % 97 <> 0 THEN {_lat('c_custkey')} END AS stop_lat, c_custkey AS k FROM customer"""
VIEWS["shapes"] = f"""
  SELECT (o_custkey // 5)::VARCHAR AS shape_id, o_orderkey AS seq,
         {_lon('o_orderkey')} AS lon, {_lat('o_orderkey')} AS lat FROM orders"""
VIEWS["trips"] = """
  SELECT o_orderkey AS trip_id, CASE WHEN (o_custkey // 5) % 13 <> 5 THEN (o_custkey // 5)::VARCHAR END AS shape_id,
         (o_orderkey % 30)::VARCHAR AS route_id FROM orders"""
VIEWS["routes"] = """
  SELECT n_nationkey::VARCHAR AS route_id, CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS route_short_name,
         n_name AS route_long_name, n_regionkey AS route_type,
         CASE WHEN n_nationkey % 6 <> 0 THEN '00FF' || lpad(n_nationkey::VARCHAR, 2, '0') END AS route_color FROM nation"""


def stops(spark: SparkSession, d: str) -> DataFrame:
    k, placed = F.col("c_custkey"), F.col("c_custkey") % 97 != 0
    lon, lat = lon_lat("c_custkey")
    return read(spark, d, "customer").select(
        k.cast("string").alias("stop_id"),
        F.when(k % 5 != 0, F.col("c_name")).alias("stop_name"),
        F.when(k % 3 != 0, F.concat(F.lit("0"), F.col("c_nationkey"))).alias("stop_code"),
        F.when(placed, lat).alias("stop_lat"), F.when(placed, lon).alias("stop_lon"), k.alias("k"),
    )


def shapes(spark: SparkSession, d: str) -> DataFrame:
    lon, lat = lon_lat("o_orderkey")
    return read(spark, d, "orders").select(
        F.expr("cast(o_custkey div 5 as string)").alias("shape_id"), F.col("o_orderkey").alias("shape_pt_sequence"),
        lon.alias("shape_pt_lon"), lat.alias("shape_pt_lat"),
    )


def trips(spark: SparkSession, d: str) -> DataFrame:
    # Some shapes are used by no trip.
    shape = F.expr("CASE WHEN (o_custkey div 5) % 13 <> 5 THEN cast(o_custkey div 5 as string) END")
    return read(spark, d, "orders").select(
        F.col("o_orderkey").alias("trip_id"), shape.alias("shape_id"),
        (F.col("o_orderkey") % 30).cast("string").alias("route_id"),
    )


def routes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    return read(spark, d, "nation").select(
        k.cast("string").alias("route_id"),
        F.when(k % 4 != 0, F.col("n_name")).alias("route_short_name"),
        F.col("n_name").alias("route_long_name"),
        F.col("n_regionkey").alias("route_type"),
        F.when(k % 6 != 0, F.concat(F.lit("00FF"), F.lpad(k.cast("string"), 2, "0"))).alias("route_color"),
    )


# --- census ----------------------------------------------------------------------------
VIEWS["census_counts"] = """
  SELECT o_custkey // 10 AS loc, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
         WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 ELSE 5 END AS p, count(*) AS n
  FROM orders GROUP BY ALL"""
VIEWS["census_cells"] = """
  SELECT loc, CASE WHEN (loc + p) % 11 = 0 THEN '0' ELSE ['9681', '9682', '9683', '9684', '9692'][p] END AS class_id, n FROM census_counts
  UNION ALL SELECT loc, '9680', sum(n)::BIGINT FROM census_counts GROUP BY loc"""
VIEWS["census_long"] = """
  SELECT loc::VARCHAR AS neighbourhood_number, 'N' || loc AS neighbourhood_name, class_id,
         CASE WHEN loc % 7 = 0 AND class_id = '9683' THEN '-' WHEN loc % 17 = 0 THEN '...' ELSE n::VARCHAR END AS text,
         CASE WHEN (loc % 7 = 0 AND class_id = '9683') OR loc % 17 = 0 THEN NULL ELSE n::DOUBLE END AS value
  FROM census_cells"""


def census_counts(spark: SparkSession, d: str) -> DataFrame:
    p = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2).when(
        F.col("o_orderpriority") == "3-MEDIUM", 3
    ).when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 4).otherwise(5)
    return read(spark, d, "orders").groupBy(F.expr("o_custkey div 10").alias("loc"), p.alias("p")).agg(F.count("*").alias("n"))


def census_long(spark: SparkSession, d: str) -> DataFrame:
    counts = census_counts(spark, d)
    codes = F.array(*[F.lit(c) for c in ("9681", "9682", "9683", "9684", "9692")])
    # Some answers carry an unlisted code, so that a bracket is absent here and there.
    code = F.when((F.col("loc") + F.col("p")) % 11 == 0, "0").otherwise(F.element_at(codes, F.col("p")))
    cells = counts.select("loc", code.alias("class_id"), "n")
    cells = cells.unionByName(counts.groupBy("loc").agg(F.sum("n").alias("n")).withColumn("class_id", F.lit("9680")))
    text = F.when((F.col("loc") % 7 == 0) & (F.col("class_id") == "9683"), "-").when(F.col("loc") % 17 == 0, "...").otherwise(
        F.col("n").cast("string")
    )
    return cells.select(
        F.col("loc").cast("string").alias("neighbourhood_number"), F.concat(F.lit("N"), "loc").alias("neighbourhood_name"),
        "class_id", text.alias("text"),
    )


def census_responses(spark: SparkSession, d: str, class_id: str = "386") -> DataFrame:
    """Responses as they land: one per locality, a result per category."""
    category = F.create_map(F.col("class_id"), F.concat(F.lit("label "), F.col("class_id")))
    other = F.struct(F.lit("1").alias("id"), F.lit("situation").alias("nome"), F.create_map(F.lit("0"), F.lit("Total")).alias("categoria"))
    own = F.struct(F.lit(class_id).alias("id"), F.lit("income").alias("nome"), category.alias("categoria"))
    place = F.struct(F.col("neighbourhood_number").alias("id"), F.col("neighbourhood_name").alias("nome"))
    # The older period is a decoy: the newest one must be picked.
    values = F.map_filter(F.create_map(F.lit("2000"), F.lit("1"), F.lit("2010"), F.col("text")), lambda k, v: v.isNotNull())
    one = F.struct(F.array(other, own).alias("classificacoes"), F.array(F.struct(place.alias("localidade"), values.alias("serie"))).alias("series"))
    return (
        census_long(spark, d)
        .groupBy("neighbourhood_number")
        .agg(F.collect_list(one).alias("resultados"))
        .select(F.lit("96").alias("id"), F.lit("households").alias("variavel"), F.lit("n").alias("unidade"), "resultados")
    )


# --- registries ------------------------------------------------------------------------
VIEWS["ds"] = """
  SELECT 'ds' || p_partkey AS dataset_id, p_name AS dataset_name, CASE WHEN p_partkey % 17 <> 0 THEN p_brand ELSE '' END AS publisher,
         CASE WHEN p_partkey % 13 <> 0 THEN 'CC BY 4.0' END AS license,
         CASE WHEN p_partkey % 9 = 0 THEN 'vector' ELSE p_size || 'm' END AS resolution,
         ['gee', 'manual_download', 'public_api', 'internal_storage', 'ftp'][1 + p_partkey % 5] AS access_type,
         'https://example.org/' || p_partkey AS source_url, lower(p_type) AS dataset_type,
         ['categorical_raster', 'numeric_raster', 'vector'][1 + p_partkey % 3] AS type, 'about ' || p_name AS description,
         p_partkey AS k, p_size AS size FROM part"""
VIEWS["ly"] = """
  SELECT 'ly' || s_suppkey AS layer_id, s_name AS layer_name, 'hazard' AS layer_type, 1 + s_suppkey::INTEGER % 3 AS analytical_level,
         CASE WHEN s_suppkey % 10 <> 0 THEN 'flood' END AS category, s_suppkey AS k,
         ['cog', 'geojson', 'pmtiles', 'zip'][1 + s_suppkey % 4] AS output_format FROM supplier"""
VIEWS["ly_sources"] = """
  SELECT 'ly' || s_suppkey AS layer_id, 'ds' || (s_suppkey * 23) AS ref FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey % 7 = 0"""
VIEWS["ly_deps"] = """
  SELECT 'ly' || s_suppkey AS layer_id, 'ly' || (s_suppkey // 2) AS ref FROM supplier WHERE s_suppkey > 0 AND s_suppkey % 3 <> 0
  UNION ALL SELECT 'ly' || s_suppkey, 'ly' || (s_suppkey // 3) FROM supplier WHERE s_suppkey > 3 AND s_suppkey % 5 = 0
  UNION ALL SELECT 'ly' || s_suppkey, 'lx' || s_suppkey FROM supplier WHERE s_suppkey % 29 = 1"""
VIEWS["ly_edges"] = "SELECT DISTINCT layer_id, ref AS upstream FROM (SELECT * FROM ly_sources UNION ALL SELECT * FROM ly_deps)"


def datasets(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")

    def pick(*values: str) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))

    def url(kind: str) -> Column:
        return F.array(F.concat(F.lit(f"https://example.org/{kind}/"), k))

    pairs = [
        (k % 2 == 0, "visual_tiles", "url_template", url("visual")),
        (k % 3 == 0, "value_tiles", "url_template", url("value")),
        (k % 5 == 0, "download", "cog_url", F.concat(url("cog"), url("cog2"))),
        (k % 7 == 0, "metadata", "url", F.array().cast("array<string>")),
        (k % 11 == 0, "bus_stops", "url_template", url("stops")),
    ]
    entries = F.array_compact(F.array(*[
        F.when(test, F.struct(F.lit(a).alias("key"), F.create_map(F.lit(kind), u).alias("value"))) for test, a, kind, u in pairs
    ]))
    legend = F.map_from_entries(F.transform(
        F.sequence(F.lit(0), F.col("p_size") % 5),
        lambda c: F.struct(c.alias("key"), F.struct(F.concat(F.lit("class "), c).alias("name"), F.format_string("#%02x%02X%02X", c * 20, c * 7, F.lit(255)).alias("color")).alias("value")),
    ))
    return read(spark, d, "part").select(
        F.concat(F.lit("ds"), k).alias("dataset_id"), F.col("p_name").alias("dataset_name"),
        F.when(k % 17 != 0, F.col("p_brand")).otherwise("").alias("publisher"), F.when(k % 13 != 0, "CC BY 4.0").alias("license"),
        F.when(k % 9 == 0, "vector").otherwise(F.concat(F.col("p_size").cast("string"), F.lit("m"))).alias("resolution"),
        pick("gee", "manual_download", "public_api", "internal_storage", "ftp").alias("access_type"),
        F.concat(F.lit("https://example.org/"), k).alias("source_url"), F.lower("p_type").alias("dataset_type"),
        pick("categorical_raster", "numeric_raster", "vector").alias("type"), F.concat(F.lit("about "), "p_name").alias("description"),
        F.map_from_entries(entries).alias("assets"), F.when(k % 3 == 0, legend).alias("classes"), k.alias("k"),
    )


def layers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    sources = F.when((k % 3 == 0) | (k % 7 == 0), F.array(F.concat(F.lit("ds"), k * 23))).otherwise(F.array().cast("array<string>"))
    deps = F.array_compact(F.array(
        F.when((k > 0) & (k % 3 != 0), F.concat(F.lit("ly"), F.expr("s_suppkey div 2"))),
        F.when((k > 3) & (k % 5 == 0), F.concat(F.lit("ly"), F.expr("s_suppkey div 3"))),
        F.when(k % 29 == 1, F.concat(F.lit("lx"), k)),
    ))
    return read(spark, d, "supplier").select(
        F.concat(F.lit("ly"), k).alias("layer_id"), F.col("s_name").alias("layer_name"), F.lit("hazard").alias("layer_type"),
        (k % 3 + 1).cast("int").alias("analytical_level"), F.when(k % 10 != 0, "flood").alias("category"),
        sources.alias("source_datasets"), deps.alias("dependencies"),
        F.element_at(F.array(*[F.lit(v) for v in ("cog", "geojson", "pmtiles", "zip")]), (k % 4 + 1).cast("int")).alias("output_format"),
        F.concat(F.lit("about "), "s_name").alias("description"), k.alias("k"),
    )


VIEWS["collection_members"] = """
  SELECT 'c' || (p_partkey // 20) AS collection_id, 'g' || ((p_partkey // 20) % 7) AS "group", 'ds' || (p_partkey - p_partkey % 3) AS dataset_id
  FROM part"""


def collections(spark: SparkSession, d: str) -> DataFrame:
    members = read(spark, d, "part").select(
        F.concat(F.lit("c"), F.expr("p_partkey div 20")).alias("id"),
        F.concat(F.lit("g"), F.expr("(p_partkey div 20) % 7")).alias("group"),
        F.concat(F.lit("ds"), F.expr("p_partkey - p_partkey % 3")).alias("dataset_id"),
    )
    return members.groupBy("id", "group").agg(F.collect_list("dataset_id").alias("datasets"))


# --- colour tables, 20 entries each ----------------------------------------------------
VIEWS["lut"] = """
  SELECT 'T' || (p_partkey // 20) AS lut_id, CASE WHEN p_partkey % 20 = 19 THEN NULL ELSE (p_partkey % 20) * 25000.0::DOUBLE END AS v,
         (p_partkey * 7 % 256)::INTEGER AS r, (p_partkey * 13 % 256)::INTEGER AS g, (p_partkey * 29 % 256)::INTEGER AS b,
         p_partkey % 20 = 19 AS is_nv FROM part"""
VIEWS["lut_pixels"] = """
  SELECT o_orderkey AS k, 'T' || (o_custkey // 15) AS lut_id, CASE WHEN o_orderkey % 97 <> 0 THEN
         CASE WHEN o_orderkey % 31 = 0 THEN 25000.0::DOUBLE * (o_orderkey % 19) ELSE o_totalprice - 5000 END END AS value FROM orders"""


def lut(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return read(spark, d, "part").select(
        F.concat(F.lit("T"), F.expr("p_partkey div 20")).alias("lut_id"), F.when(k % 20 != 19, (k % 20) * F.lit(25000.0)).alias("v"),
        *[(k * f % 256).cast("int").alias(n) for f, n in ((7, "r"), (13, "g"), (29, "b"))], F.lit(255).alias("a"), (k % 20 == 19).alias("is_nv"),
    )


def lut_pixels(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return read(spark, d, "orders").select(
        k.alias("k"), F.concat(F.lit("T"), F.expr("o_custkey div 15")).alias("lut_id"),
        F.when(k % 97 != 0, F.when(k % 31 == 0, F.lit(25000.0) * (k % 19)).otherwise(F.col("o_totalprice") - 5000)).alias("value"),
    )
