"""Feed tables, line features and feature documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions.numeric import round_even
from cellweave.operators import joins as J
from cellweave.operators import nested as NE
from cellweave.operators.aggregates import linestring_parts
from cellweave.plans import transit as TR
from cellweave.queries import tables as T
from cellweave.queries.catalog import even, query


@query("j04_shape_routes", "SELECT f.shape_id, f.route_id, r.route_long_name FROM (SELECT shape_id, arg_min(route_id, trip_id) AS route_id FROM trips GROUP BY 1) f LEFT JOIN routes r USING (route_id)")
def _(spark, d):
    return J.shape_routes(T.trips(spark, d), T.routes(spark, d).select("route_id", "route_long_name")).select("shape_id", "route_id", "route_long_name")


@query(
    "j05_shapes_with_routes",
    """SELECT s.shape_id, s.n, f.route_id, r.route_type FROM (SELECT shape_id, count(*) AS n FROM shapes GROUP BY 1) s
    LEFT JOIN (SELECT shape_id, arg_min(route_id, trip_id) AS route_id FROM trips GROUP BY 1) f USING (shape_id) LEFT JOIN routes r USING (route_id)""",
)
def _(spark, d):
    shapes = T.shapes(spark, d).groupBy("shape_id").agg(F.count("*").alias("n"))
    return J.shapes_with_routes(shapes, T.trips(spark, d), T.routes(spark, d).select("route_id", "route_type")).select("shape_id", "n", "route_id", "route_type")


@query("a15_to_linestrings", "SELECT shape_id, list([lon, lat] ORDER BY seq) AS coordinates FROM shapes GROUP BY shape_id")
def _(spark, d):
    return TR.shape_lines(T.shapes(spark, d))


@query(
    "a15_linestring_parts",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY shape_id ORDER BY seq) - 1 AS rn FROM shapes)
    SELECT shape_id, rn // 48 AS part, list([lon, lat] ORDER BY seq) AS coordinates FROM r GROUP BY 1, 2""",
)
def _(spark, d):
    lines = linestring_parts(T.shapes(spark, d), 48, "shape_id", "shape_pt_sequence", "shape_pt_lon", "shape_pt_lat")
    return lines.select("shape_id", "part", "coordinates")


STOP = """stop_id, stop_lon, stop_lat, coalesce(stop_name, '') AS stop_name, stop_code FROM stops WHERE stop_lon IS NOT NULL"""


@query("nj08_stop_features", f"SELECT 'Feature' AS type, 'Point' AS geometry_type, {STOP}")
def _(spark, d):
    f = TR.stop_features(T.stops(spark, d)).select("feature.*")
    return f.select(
        "type", F.col("geometry.type").alias("geometry_type"), F.col("geometry.coordinates")[0].alias("stop_lon"),
        F.col("geometry.coordinates")[1].alias("stop_lat"), "properties.*",
    )


@query(
    "nj09_feature_collection",
    """WITH f AS (SELECT c_custkey AS k, '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || (c_custkey % 180) || '.0,' || (c_custkey % 90) || '.0]},"properties":{"stop_id":"' || c_custkey
        || '","segment":' || CASE WHEN c_custkey % 4 = 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}}' AS j FROM customer),
    n AS (SELECT row_number() OVER (ORDER BY k) AS line_no, j FROM f)
    SELECT 0 AS line_no, '{"type":"FeatureCollection","features":[' AS line UNION ALL SELECT line_no, CASE WHEN line_no > 1 THEN ',' ELSE '' END || j FROM n
    UNION ALL SELECT count(*) + 1, ']}' FROM n""",
)
def _(spark, d):
    c = T.read(spark, d, "customer")
    props = {"stop_id": F.col("c_custkey").cast("string"), "segment": F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))}
    features = NE.to_feature(c, NE.point_geometry(F.col("c_custkey") % 180, F.col("c_custkey") % 90), props, keep=["c_custkey"])
    return NE.to_feature_collection(features, "c_custkey")


@query(
    "nj07_merge_props",
    f"""SELECT c.id, CASE WHEN s.n IS NULL THEN c.name ELSE 'N' || s.n END AS name, s.n::VARCHAR AS n_pixels FROM centers c LEFT JOIN (SELECT id, count(*) AS n FROM inside GROUP BY id) s USING (id)""",
)
def _(spark, d):
    from cellweave.operators.spatial import pip_join

    polys = T.polygons(spark, d)
    stats = pip_join(T.field_points(spark, d), polys, keep=("id",)).groupBy("id").agg(F.count("*").alias("n_pixels"))
    merged = NE.merge_props(polys, stats.withColumn("name", F.concat(F.lit("N"), "n_pixels")), "id")
    return merged.select("id", F.try_element_at("props", F.lit("name")).alias("name"), F.try_element_at("props", F.lit("n_pixels")).alias("n_pixels"))


@query(
    "nj10_layer_metadata",
    """SELECT layer, '{"layer":"' || layer || '","description":"d' || k || '"' || CASE WHEN k % 3 = 0 THEN '' ELSE ',"time_period":"' || (2000 + k % 25) || '"' END ||
      ',"encoding":{"type":"' || CASE k % 5 WHEN 0 THEN 'class_lookup' WHEN 1 THEN 'rgb_packed' ELSE 'terrain_rgb' END || '","scale":0.5,"offset":' || (k % 10) || '.0,"unit":"' || CASE WHEN k % 4 = 0 THEN '' ELSE 'm' END || '","decode_formula":"value = ' ||
      CASE k % 5 WHEN 0 THEN 'R' WHEN 1 THEN 'R + 256*G + 65536*B' || CASE WHEN k % 10 <> 0 THEN ' + offset' ELSE '' END ELSE '(R * 256 * 256 + G * 256 + B) * scale + offset' END || '"}}' AS document
    FROM (SELECT 'S' || p_partkey AS layer, p_partkey AS k FROM part)""",
)
def _(spark, d):
    k = F.col("p_partkey")
    rows = T.read(spark, d, "part").select(
        F.concat(F.lit("S"), k).alias("layer"), F.concat(F.lit("d"), k).alias("description"),
        F.when(k % 3 != 0, (k % 25 + 2000).cast("string")).alias("time_period"), F.lit(0.5).alias("scale"), (k % 10).alias("offset"),
        F.when(k % 4 != 0, "m").alias("unit"), F.when(k % 5 == 0, "class_lookup").when(k % 5 == 1, "rgb_packed").otherwise("terrain_rgb").alias("type"),
    )
    return NE.layer_metadata(rows)


@query("p21_stops", f"SELECT {STOP}")
def _(spark, d):
    f = TR.stop_features(T.stops(spark, d)).select(NE.feature_json().alias("j"))
    parsed = f.select(F.from_json("j", "geometry STRUCT<coordinates: ARRAY<DOUBLE>>, properties STRUCT<stop_id: STRING, stop_name: STRING, stop_code: STRING>").alias("f"))
    return parsed.select(F.col("f.geometry.coordinates")[0].alias("stop_lon"), F.col("f.geometry.coordinates")[1].alias("stop_lat"), "f.properties.*")


@query("p21_shapes", "SELECT shape_id, list([lon, lat] ORDER BY seq) AS coordinates, count(*) AS n FROM shapes GROUP BY shape_id")
def _(spark, d):
    f = TR.shape_features(T.shapes(spark, d)).select("feature.*")
    coordinates = F.col("geometry.coordinates")
    return f.select("properties.shape_id", F.transform(coordinates, lambda c: F.array(c[0], c[1])).alias("coordinates"), F.size(coordinates).cast("bigint").alias("n"))


@query(
    "p21_routes",
    """SELECT s.shape_id, s.n, f.route_id, CASE WHEN f.shape_id IS NOT NULL THEN coalesce(route_short_name, '') END AS route_short_name,
      CASE WHEN f.shape_id IS NOT NULL THEN coalesce(route_long_name, '') END AS route_long_name, r.route_type,
      '#' || route_color AS route_color, CASE WHEN f.shape_id IS NOT NULL THEN 6 ELSE 1 END AS n_props
    FROM (SELECT shape_id, count(*) AS n FROM shapes GROUP BY 1) s
    LEFT JOIN (SELECT shape_id, arg_min(route_id, trip_id) AS route_id FROM trips GROUP BY 1) f USING (shape_id) LEFT JOIN routes r USING (route_id)""",
)
def _(spark, d):
    f = TR.route_features(T.shapes(spark, d), T.trips(spark, d), T.routes(spark, d))
    schema = (
        "geometry STRUCT<coordinates: ARRAY<ARRAY<DOUBLE>>>, properties STRUCT<shape_id: STRING, route_id: STRING, "
        "route_short_name: STRING, route_long_name: STRING, route_type: INT, route_color: STRING>"
    )
    keys = F.json_object_keys(F.get_json_object("feature", "$.properties"))
    return f.select(F.from_json("feature", schema).alias("f"), F.size(keys).alias("n_props")).select(
        "f.properties.*", F.size("f.geometry.coordinates").cast("bigint").alias("n"), "n_props"
    )


@query("s14_stop_positions", f"SELECT stop_id, {even('6378137.0::DOUBLE * radians(stop_lon)', 3)} AS x, {even('6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(stop_lat) / 2))', 3)} AS y FROM stops WHERE stop_lon IS NOT NULL")
def _(spark, d):
    from cellweave.functions.projection import to_mercator

    placed = T.stops(spark, d).where("stop_lon is not null")
    x, y = to_mercator(F.col("stop_lon"), F.col("stop_lat"))
    return placed.select("stop_id", round_even(x, 3).alias("x"), round_even(y, 3).alias("y"))
