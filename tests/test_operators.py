"""Operators: skewed inputs, the ways beyond a broadcast, plans and edge cases."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cellweave.functions import geometry as G
from cellweave.functions.grid import GridMeta
from cellweave.operators import aggregates as A
from cellweave.operators import filters as FL
from cellweave.operators import grid as OG
from cellweave.operators import nested as NE
from cellweave.operators import ranking as RK
from cellweave.operators import registry as R
from cellweave.operators import sizing, spatial
from cellweave.operators import surface as SF
from cellweave.session import scratch_path
from cellweave.sources import sinks as SK


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def square(x, y, side):
    return [[[(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]]]


@pytest.fixture(scope="module")
def world(spark):
    """A third of the points crowd into one bin; polygon sizes span several grid levels."""
    spots = [(0.5 + (i % 10) * 0.01, 0.5 + (i // 10 % 10) * 0.01) for i in range(400)]
    spots += [((i * 37 % 1000) / 10, (i * 91 % 1000) / 10) for i in range(800)]
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(spots)], "k INT, x DOUBLE, y DOUBLE")
    shapes = [("big", square(-1.0, -1.0, 90.0)), ("mid", square(10.0, 10.0, 12.0)), ("tiny", square(0.45, 0.45, 0.1)), ("dot", square(50.0, 50.0, 0.0)), ("none", [])]
    polygons = spark.createDataFrame([(n, n, i, p) for i, (n, p) in enumerate(shapes)], f"id STRING, name STRING, ord INT, parts {G.PARTS}")
    inside = G.in_polygon(F.col("x"), F.col("y"), F.col("parts"))
    brute = points.crossJoin(polygons).where(inside).select("k", "id")
    return points, polygons, sorted(map(tuple, brute.collect()))


@pytest.mark.parametrize("limit", [spatial.BROADCAST_BYTES, 0])
def test_point_polygon_join_both_ways(world, monkeypatch, limit):
    points, polygons, expected = world
    monkeypatch.setattr(spatial, "BROADCAST_BYTES", limit)
    joined = spatial.pip_join(points, polygons, keep=("id",))
    assert ("BroadcastExchange" in plan(joined)) == (limit > 0) or limit == 0
    assert sorted((r.k, r.id) for r in joined.collect()) == expected
    matched = {k for k, _ in expected}
    semi = [r.k for r in spatial.pip_join(points, polygons, keep=(), how="semi").collect()]
    anti = [r.k for r in spatial.pip_join(points, polygons, keep=(), how="anti").collect()]
    assert sorted(semi) == sorted(matched)
    assert sorted(semi + anti) == list(range(1200))


def test_no_polygons(world):
    points, polygons, _ = world
    assert spatial.pip_join(points, polygons.limit(0)).count() == 0
    assert spatial.pip_join(points, polygons.limit(0), keep=(), how="anti").count() == 1200


def test_disjoint_polygons_partition_points(spark):
    cells = [(f"c{i}{j}", f"c{i}{j}", i * 4 + j, square(i * 25.0, j * 25.0, 25.0)) for i in range(4) for j in range(4)]
    polygons = spark.createDataFrame(cells, f"id STRING, name STRING, ord INT, parts {G.PARTS}")
    points = spark.range(0, 2000).select("id", (F.col("id") * 37 % 1000 / 10.0).alias("x"), (F.col("id") * 91 % 1000 / 10.0).alias("y"))
    joined = spatial.pip_join(points.withColumnRenamed("id", "k"), polygons, keep=("id",))
    assert joined.groupBy("k").count().where("count <> 1").count() == 0 and joined.count() == 2000


def test_small_side_measures(spark, monkeypatch):
    df = spark.range(1000)
    assert sizing.fits_broadcast(df)
    assert not sizing.fits_broadcast(df, max_rows=999)
    assert not sizing.fits_broadcast(df, max_bytes=100)
    monkeypatch.setattr(sizing, "MEASURE_BYTES", 10)
    assert not sizing.fits_broadcast(df) and sizing.fits_broadcast(df, settled=True)


def test_running_total_with_hot_key(spark):
    df = spark.range(0, 3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"))
    got = RK.running_total(df, ["id"], keys=["k"], out="n", slices=7)
    assert got.count() == 3000
    bad = got.groupBy("k").agg(F.max("n").alias("m"), F.count("*").alias("c"), F.countDistinct("n").alias("u")).where("m <> c or u <> c")
    assert bad.count() == 0
    ordered = got.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("a"))
    assert ordered.where(F.exists("a", lambda s: s["n"] < 1) | ~F.forall(F.sequence(F.lit(1), F.size("a")), lambda i: F.element_at("a", i)["n"] == i)).count() == 0


def test_percentile_with_hot_value(spark):
    df = spark.range(0, 999).select(F.lit("a").alias("layer"), F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id") * 1.5).alias("value"))
    exact = df.agg(F.percentile("value", F.array(F.lit(0.02), F.lit(0.5), F.lit(0.98)))).first()[0]
    rows = A.percentile_exact(df, "value", [0.02, 0.5, 0.98]).orderBy("prob").collect()
    assert [r.value for r in rows] == pytest.approx(exact)
    loose = A.percentile_stretch(df, accuracy=10000).first()
    assert loose.p_lo <= loose.p_hi


def test_percentile_without_values(spark):
    df = spark.createDataFrame([("a", None)], "layer STRING, value DOUBLE")
    assert A.percentile_exact(df, "value", [0.5]).count() == 0


def test_mode_ties_and_wide_values(spark):
    df = spark.createDataFrame([(1, 7), (1, 7), (1, -3), (1, -3), (1, 9), (2, None), (2, 4)], "cell INT, value INT")
    for frame in (df, df.withColumn("value", F.col("value").cast("double"))):
        got = {r.cell: r.value for r in A.composite_mode(frame, ["cell"]).collect()}
        assert got == {1: -3, 2: 4}


def test_mosaic_skips_masked(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (2, 1, None)], "cell INT, img_ord INT, value DOUBLE")
    assert [tuple(r) for r in A.mosaic(df, ["cell"]).collect()] == [(1, 5.0)]


def test_pivot_names_absent_codes(spark):
    df = spark.createDataFrame([("n1", "a", 2.0), ("n1", "a", None), ("n2", "b", None)], "k STRING, code STRING, v DOUBLE")
    rows = {r.k: r for r in A.pivot_sum(df, "k", "code", {"a": "qa", "b": "qb", "z": "qz"}, "v").collect()}
    assert (rows["n1"].qa, rows["n1"].qb, rows["n1"].qz) == (2.0, None, None)
    assert rows["n2"].qb == 0.0


def test_hot_linestring_is_whole(spark):
    df = spark.range(0, 900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("shape_id"), F.col("id").alias("seq"), (F.col("id") * 1.0).alias("lon"), F.lit(0.0).alias("lat"))
    whole = {r.shape_id: len(r.coordinates) for r in A.to_linestrings(df).collect()}
    assert whole["hot"] == 300 and sum(whole.values()) == 900
    lines = A.linestring_parts(df, 64)
    assert lines.agg(F.sum(F.size("coordinates"))).first()[0] == 900
    assert lines.agg(F.max(F.size("coordinates"))).first()[0] == 64
    hot = [c[0] for r in lines.where("shape_id = 'hot'").orderBy("part").collect() for c in r.coordinates]
    assert hot == [float(i) for i in range(0, 900, 3)]


def test_batches(spark):
    rows = RK.batch_ids(spark.range(0, 120).union(spark.range(0, 5)), "id", 50).orderBy("batch_no").collect()
    assert [r.batch_no for r in rows] == [0, 1, 2]
    assert rows[0].ids == ",".join(map(str, range(50))) and rows[2].ids.count(",") == 19


def test_latest_period_of_nothing_stops(spark):
    df = spark.createDataFrame([(1, {})], "k INT, serie MAP<STRING, STRING>")
    with pytest.raises(Exception, match="no period"):
        NE.latest_period(df).collect()


def test_feature_collection_is_a_document(spark):
    df = spark.range(0, 40).select("id", F.when(F.col("id") % 2 == 0, "x").alias("code"))
    features = NE.to_feature(df, NE.point_geometry(F.col("id"), F.lit(1)), {"code": F.col("code")}, keep=["id"])
    path = scratch_path(spark, "doc")
    SK.write_feature_collection(NE.to_feature_collection(features, "id"), path)
    import glob

    folder = path.removeprefix("file:")
    text = "".join(open(f).read() for f in sorted(glob.glob(f"{folder}/part-*")))
    doc = json.loads(text)
    assert len(doc["features"]) == 40 and doc["features"][1]["properties"] == {"code": None}
    assert [f["geometry"]["coordinates"][0] for f in doc["features"]] == list(range(40))


def test_observed_stage(spark):
    seen = Observation("kept")
    kept = A.observe_stage(spark.range(10).where("id > 3"), seen)
    kept.write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 6


META = GridMeta(20, 10, 0.01, 0.01, -51.3, -30.0)


@pytest.fixture(scope="module")
def raster(spark):
    return spark.range(200).select(F.lit("a").alias("layer"), F.expr("id div 20").alias("row"), (F.col("id") % 20).alias("col"), (F.col("id") * 1.0).alias("value"))


def test_clip_is_idempotent_and_end_exclusive(raster):
    box = (-51.247, -51.203, -30.047, -30.023)
    once, meta = OG.clip_bbox(raster, META, *box)
    twice, again = OG.clip_bbox(once, meta, *box)
    assert (meta.width, meta.height) == (again.width, again.height)
    assert once.exceptAll(twice).count() == 0 and once.count() == meta.cells


def test_clip_reaches_the_scan(spark, raster):
    path = scratch_path(spark, "pixels")
    SK.write_pixels(raster, path)
    cut, _ = OG.clip_bbox(spark.read.parquet(path), META, -51.25, -51.2, -30.05, -30.02)
    text = plan(cut)
    assert "PushedFilters" in text and "LessThan(row," in text


def test_reprojection_fills_without_holes(raster):
    moved, target = OG.reproject(raster, META, "EPSG:3857", 400)
    assert moved.select("row", "col").distinct().count() == moved.count()
    edge = moved.agg(F.min("row"), F.max("row"), F.min("col"), F.max("col")).first()
    assert (edge[1] - edge[0] + 1) * (edge[3] - edge[2] + 1) == moved.count() and edge[1] < target.height


def test_utm_reprojection_keeps_every_target_cell(spark):
    meta = GridMeta(30, 30, 20.0, 20.0, 475000.0, 6680000.0, "EPSG:32722")
    cells = spark.range(900).select(F.lit("a").alias("layer"), F.expr("id div 30").alias("row"), (F.col("id") % 30).alias("col"), F.lit(1.0).alias("value"))
    moved, _ = OG.reproject(cells, meta, "EPSG:3857", 7)
    rows = moved.groupBy("row").agg((F.max("col") - F.min("col") + 1).alias("span"), F.count("*").alias("n"))
    assert rows.where("span <> n").count() == 0


def test_export_guard(raster):
    with pytest.raises(ValueError, match="exceeds"):
        OG.export_window(raster, META, META.extent, "EPSG:3857", 10, max_pixels=1000)


def test_average_pyramid_preserves_mean(spark):
    full = spark.range(256).select(F.lit("a").alias("layer"), F.expr("id div 16").alias("row"), (F.col("id") % 16).alias("col"), (F.col("id") % 7 * 1.0).alias("value"))
    means = OG.overviews(full, "average", 4).groupBy("level").agg(F.avg("value").alias("m"), F.count("*").alias("n")).orderBy("level").collect()
    assert [r.n for r in means] == [256, 64, 16, 4, 1]
    assert [r.m for r in means] == pytest.approx([means[0].m] * 5)


def test_products_need_no_shuffle_to_tile(raster):
    assert "Exchange" not in plan(OG.tile(raster, META, 8, 10))
    assert "Exchange" not in plan(OG.reproject(raster, META, "EPSG:3857", 500)[0])


def test_slope_across_block_borders(spark):
    plane = spark.range(2500).select(F.lit("a").alias("layer"), F.expr("id div 50").alias("row"), (F.col("id") % 50).alias("col"), (F.col("id") % 50 * 1.0).alias("value"))
    small = SF.neighbourhood(plane, block=8).count()
    slopes = SF.slope(plane, 1.0, 1.0)
    assert small == 2500
    assert slopes.where("slope is not null").agg(F.count("*"), F.min("slope"), F.max("slope")).first()[:] == (48 * 48, pytest.approx(45.0), pytest.approx(45.0))
    nine = [c for c in SF.neighbourhood(plane, block=8).columns]
    a = SF.neighbourhood(plane, block=8).select(nine)
    assert a.exceptAll(SF.neighbourhood(plane, block=256).select(nine)).count() == 0


def test_flow_drains_a_tilted_plane(spark):
    plane = spark.range(400).select(F.lit("a").alias("layer"), F.expr("id div 20").alias("row"), (F.col("id") % 20).alias("col"), (100.0 - F.col("id") % 20).alias("value"))
    rows = {(r.row, r.col): r.cells for r in SF.flow_accumulation(plane, 1.0, 1.0).collect()}
    assert len(rows) == 400 and all(rows[(r, c)] == c + 1 for r in range(20) for c in range(20))


def test_build_order_marks_cycles(spark):
    layers = spark.createDataFrame(
        [("a", ["d1"], []), ("b", [], ["a"]), ("c", [], ["b", "a"]), ("x", [], ["y"]), ("y", [], ["x"]), ("z", [], ["x"])],
        "layer_id STRING, source_datasets ARRAY<STRING>, dependencies ARRAY<STRING>",
    )
    assert {r.layer_id: r.depth for r in R.build_order(layers).collect()} == {"a": 0, "b": 1, "c": 2, "x": None, "y": None, "z": None}
    reached = {(r.layer_id, r.ancestor) for r in R.lineage(layers).collect()}
    assert ("c", "d1") in reached and ("x", "x") in reached and ("z", "y") in reached
    assert sorted(r.affected for r in R.impact(layers, "d1").collect()) == ["a", "b", "c"]


def test_level_and_field_rules(spark):
    layers = spark.createDataFrame(
        [("slope", 1, ["dem"], [], "cog"), ("heat", 2, ["era"], ["slope"], "cog"), ("late", 1, [], ["heat"], "tif")],
        "layer_id STRING, analytical_level INT, source_datasets ARRAY<STRING>, dependencies ARRAY<STRING>, output_format STRING",
    )
    assert sorted(r.id for r in R.level_rule(layers).collect()) == ["heat", "late"]
    assert [r.detail for r in R.permitted_values(layers, "layer_id").collect()] == ["output_format=tif"]
    assert [(r.id, r.detail) for r in R.level_monotonicity(layers).collect()] == [("late", "heat")]
    missing = {r.detail for r in R.required_layer_fields(layers).collect()}
    assert {"transformation_script", "s3_path"} <= missing


def test_filters_reach_the_scan(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(FL.where_in(o, "o_custkey", [1, 2]).select("o_orderkey"))
    assert "In(o_custkey" in text and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_shuffled_point_join_takes_maps_and_equal_points(spark, monkeypatch):
    from cellweave.operators import spatial as SP

    ring = "array(array(named_struct('x', 0D, 'y', 0D), named_struct('x', 4D, 'y', 0D), named_struct('x', 4D, 'y', 4D), named_struct('x', 0D, 'y', 4D), named_struct('x', 0D, 'y', 0D)))"
    polygons = spark.sql(f"SELECT 'p' AS id, 'n' AS name, array({ring}) AS parts")
    points = spark.range(1000).selectExpr("id AS k", "1D AS x", "2D AS y", "map('a', 'b') AS props")
    assert SP.pip_join(points, polygons, keep=("id",)).count() == 1000
    monkeypatch.setattr(SP, "BROADCAST_BYTES", -1)
    joined = SP.pip_join(points, polygons, keep=("id",))
    assert joined.count() == 1000
    assert SP.pip_join(points, polygons, keep=(), how="anti").count() == 0
