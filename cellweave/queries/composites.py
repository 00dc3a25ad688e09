"""Image composites, ranks, percentiles and table summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions.numeric import round_even, row_sum
from cellweave.operators import aggregates as A
from cellweave.operators import joins as J
from cellweave.operators import ranking as RK
from cellweave.queries import tables as T
from cellweave.queries.catalog import even, query

CLASSES = {"9681": "q1", "9682": "q2", "9683": "q3", "9684": "q4", "9685": "q5a", "9692": "none"}


def census_values(spark, d):
    from cellweave.functions.numeric import to_number

    return T.census_long(spark, d).withColumn("value", to_number(F.col("text")))


@query("a01_sum_where", "SELECT neighbourhood_number, coalesce(sum(value), 0) AS total FROM census_long WHERE class_id IN ('9681', '9682', '9692') GROUP BY 1")
def _(spark, d):
    return A.sum_where(census_values(spark, d), "neighbourhood_number", F.col("class_id").isin("9681", "9682", "9692"), "value")


def pivot_sql(agg: str) -> str:
    columns = ", ".join(f"max(CASE WHEN class_id = '{c}' THEN v END) AS {n}" for c, n in CLASSES.items())
    return f"""WITH g AS (SELECT neighbourhood_number, class_id, {agg} AS v FROM census_long WHERE class_id IN ({', '.join(repr(c) for c in CLASSES)}) GROUP BY ALL)
    SELECT neighbourhood_number, {columns} FROM g GROUP BY 1"""


@query("a02_pivot_sum", pivot_sql("coalesce(sum(value), 0)"))
def _(spark, d):
    return A.pivot_sum(census_values(spark, d), "neighbourhood_number", "class_id", CLASSES, "value")


@query("a03_pivot_max", pivot_sql("max(value)"))
def _(spark, d):
    return A.pivot_max(census_values(spark, d), "neighbourhood_number", "class_id", CLASSES, "value")


@query(
    "a04_row_sum",
    """WITH g AS (SELECT neighbourhood_number, sum(CASE WHEN class_id = '9681' THEN value END) AS a, sum(CASE WHEN class_id = '9692' THEN value END) AS b FROM census_long GROUP BY 1)
    SELECT neighbourhood_number, coalesce(a, 0) + coalesce(b, 0) AS low FROM g""",
)
def _(spark, d):
    g = census_values(spark, d).groupBy("neighbourhood_number").agg(
        F.sum(F.when(F.col("class_id") == "9681", F.col("value"))).alias("a"), F.sum(F.when(F.col("class_id") == "9692", F.col("value"))).alias("b")
    )
    return g.select("neighbourhood_number", row_sum([F.col("a"), F.col("b")]).alias("low"))


@query("a06_composite_mean", """SELECT layer, "row", "col", avg(value) AS value FROM obs GROUP BY ALL""")
def _(spark, d):
    return A.composite_mean(T.obs(spark, d))


@query(
    "a07_composite_mode",
    """SELECT layer, "row", "col", class AS value FROM (SELECT layer, "row", "col", class, row_number() OVER (PARTITION BY layer, "row", "col" ORDER BY count(*) DESC, class) AS rn
      FROM obs GROUP BY layer, "row", "col", class) WHERE rn = 1""",
)
def _(spark, d):
    return A.composite_mode(T.obs(spark, d).select("layer", "row", "col", F.col("class").alias("value")))


@query(
    "a08_mosaic",
    """SELECT layer, "row", "col", value FROM (SELECT *, row_number() OVER (PARTITION BY layer, "row", "col" ORDER BY img_ord DESC) AS rn FROM series WHERE value IS NOT NULL) WHERE rn = 1""",
)
def _(spark, d):
    return A.mosaic(T.series(spark, d))


@query("a09_first_image", """SELECT layer, "row", "col", value FROM obs WHERE img_ord = (SELECT min(img_ord) FROM obs)""")
def _(spark, d):
    return A.first_image(T.obs(spark, d)).select("layer", "row", "col", "value")


@query(
    "a11_null_profile",
    """SELECT 'stop_name' AS column_name, count(*) - count(stop_name) AS n_null FROM stops UNION ALL SELECT 'stop_code', count(*) - count(stop_code) FROM stops
    UNION ALL SELECT 'stop_lat', count(*) - count(stop_lat) FROM stops""",
)
def _(spark, d):
    return A.null_profile(T.stops(spark, d).select("stop_name", "stop_code", "stop_lat"))


@query(
    "a12_percentile_stretch",
    f"""SELECT layer, {even('quantile_cont(value, 0.02)', 4)} AS p_lo, {even('quantile_cont(value, 0.98)', 4)} AS p_hi FROM scenes GROUP BY layer""",
)
def _(spark, d):
    p = A.percentile_stretch(T.scenes(spark, d))
    return p.select("layer", *[round_even(F.col(c), 4).alias(c) for c in ("p_lo", "p_hi")])


@query(
    "a13_normalize_minmax",
    """SELECT layer, "row", "col", (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) AS all_norm,
      (value - min(value) OVER (PARTITION BY layer)) / (max(value) OVER (PARTITION BY layer) - min(value) OVER (PARTITION BY layer)) AS own_norm FROM scenes""",
)
def _(spark, d):
    n = A.normalize_minmax(T.scenes(spark, d), "value", out="all_norm")
    return A.normalize_minmax(n, "value", ["layer"], "own_norm").select("layer", "row", "col", "all_norm", "own_norm")


@query("a14_distinct_keys", "SELECT DISTINCT shape_id FROM shapes")
def _(spark, d):
    return A.distinct_keys(T.shapes(spark, d), "shape_id")


@query(
    "a19_stage_counts",
    "SELECT 'all' AS stage, count(*) AS n FROM stops UNION ALL SELECT 'placed', count(*) FROM stops WHERE stop_lon IS NOT NULL UNION ALL SELECT 'named', count(*) FROM stops WHERE stop_lon IS NOT NULL AND stop_name IS NOT NULL",
)
def _(spark, d):
    every = T.stops(spark, d)
    placed = every.where("stop_lon is not null")
    return A.stage_counts({"all": every, "placed": placed, "named": placed.where("stop_name is not null")})


@query("a20_group_datasets", """SELECT "group", count(DISTINCT dataset_id) AS n_datasets FROM collection_members GROUP BY 1""")
def _(spark, d):
    return A.group_datasets(T.collections(spark, d))


# --- first per key, batches, releases --------------------------------------------------
@query("w01_dedupe_first", "SELECT shape_id, arg_min(route_id, trip_id) AS route_id, min(trip_id) AS trip_id FROM trips GROUP BY shape_id")
def _(spark, d):
    return RK.dedupe_first(T.trips(spark, d).select("shape_id", "route_id", "trip_id"), "shape_id", "trip_id")


@query("w02_first_match", "SELECT s.shape_id, arg_min(t.route_id, t.trip_id) AS route_id FROM (SELECT DISTINCT shape_id FROM shapes) s LEFT JOIN trips t USING (shape_id) GROUP BY s.shape_id")
def _(spark, d):
    first = RK.dedupe_first(T.trips(spark, d).select("shape_id", "route_id", "trip_id"), "shape_id", "trip_id")
    return T.shapes(spark, d).select("shape_id").distinct().join(first.drop("trip_id"), "shape_id", "left")


@query(
    "w03_batch_ids",
    """WITH r AS (SELECT o_custkey AS id, (row_number() OVER (ORDER BY o_custkey) - 1) // 50 AS batch_no FROM (SELECT DISTINCT o_custkey FROM orders))
    SELECT batch_no, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids FROM r GROUP BY batch_no""",
)
def _(spark, d):
    return RK.batch_ids(T.read(spark, d, "orders"), "o_custkey", 50)


@query(
    "w04_latest_release",
    """SELECT dataset_id, version, period FROM (SELECT DISTINCT o_custkey AS dataset_id, 'v' || (o_orderkey % 12) AS version, year(o_orderdate)::VARCHAR AS period FROM orders)
    QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY substr(version, 2)::INTEGER DESC, period DESC) = 1""",
)
def _(spark, d):
    releases = T.read(spark, d, "orders").select(
        F.col("o_custkey").alias("dataset_id"), F.concat(F.lit("v"), F.col("o_orderkey") % 12).alias("version"), F.year("o_orderdate").cast("string").alias("period")
    )
    return RK.latest_release(releases)


@query(
    "w05_lut_segments",
    """WITH e AS (SELECT * FROM lut WHERE NOT is_nv)
    SELECT lut_id, v AS lo_v, r AS lo_r, lead(v) OVER w AS hi_v, lead(b) OVER w AS hi_b FROM e WINDOW w AS (PARTITION BY lut_id ORDER BY v)
    UNION ALL SELECT lut_id, NULL, NULL, v, b FROM e QUALIFY row_number() OVER (PARTITION BY lut_id ORDER BY v) = 1""",
)
def _(spark, d):
    return A.lut_segments(T.lut(spark, d)).select(
        "lut_id", F.col("lo.v").alias("lo_v"), F.col("lo.r").alias("lo_r"), F.col("hi.v").alias("hi_v"), F.col("hi.b").alias("hi_b")
    )


@query("t01_order_in_group", "SELECT shape_id, seq AS shape_pt_sequence, row_number() OVER (PARTITION BY shape_id ORDER BY seq) AS position FROM shapes")
def _(spark, d):
    return RK.order_in_group(T.shapes(spark, d), "shape_id", "shape_pt_sequence", [])


@query("t02_latest", "SELECT max(ts) AS ts FROM obs")
def _(spark, d):
    return RK.latest(T.obs(spark, d), "ts")


@query("t03_preview", "SELECT stop_id, stop_name, k FROM stops ORDER BY k LIMIT 5")
def _(spark, d):
    return RK.preview(T.stops(spark, d), "k", 5).select("stop_id", "stop_name", "k")


@query("t04_first_image", "SELECT DISTINCT image_id FROM obs WHERE img_ord = (SELECT min(img_ord) FROM obs)")
def _(spark, d):
    return A.first_image(T.obs(spark, d)).select("image_id").distinct()


@query(
    "u01_union_batches",
    "SELECT o_orderkey, o_custkey, NULL AS o_totalprice FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderstatus <> 'F'",
)
def _(spark, d):
    o = T.read(spark, d, "orders")
    filled = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    others = o.where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice")
    return J.union_batches(filled, others)


@query("u05_distinct_ids", "SELECT DISTINCT neighbourhood_number, neighbourhood_name FROM census_long")
def _(spark, d):
    return A.distinct_keys(T.census_long(spark, d), "neighbourhood_number", "neighbourhood_name")
