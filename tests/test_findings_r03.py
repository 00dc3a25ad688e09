"""What the third review found: whole jobs that grew faster than their input, ties and cuts."""

import duckdb
from pyspark.sql import functions as F

from cellweave.operators import grid as OG
from cellweave.operators import spatial as S
from cellweave.operators.grid import GridMeta
from cellweave.queries import ORACLES, QUERIES
from cellweave.sources import readers as RD
from cellweave.sources import sinks as SK

META = GridMeta(12, 12, 0.0025, 0.0025, -51.40, -29.88)


def test_tile_blocks_hold_every_pixel_once(spark, tmp_path):
    """F2 to F12, F19 to F21: some rows a cell and zoom, and exactly the pixels of the tiles."""
    rows = [("a", r, c, float(100 * r + c)) for r in range(12) for c in range(12) if (r + c) % 5]
    pixels = spark.createDataFrame(rows, "layer string, row long, col long, value double")
    for z_min, z_max in ((8, 11), (14, 15)):
        blocks = OG.tile_blocks(pixels, META, z_min, z_max)
        columns = ["layer", "z", "x", "y", "px", "py", "value"]
        got, want = OG.block_pixels(blocks).select(columns), OG.tile(pixels, META, z_min, z_max).select(columns)
        assert got.count() == want.count() == got.distinct().count()
        assert got.exceptAll(want).isEmpty()
        assert blocks.count() <= 4 * (z_max - z_min + 1) * len(rows)
        SK.write_tile_blocks(blocks, str(tmp_path / str(z_min)))
        assert OG.block_pixels(spark.read.parquet(str(tmp_path / str(z_min)))).select(columns).exceptAll(want).isEmpty()


def test_many_colour_tables_share_files(spark, tmp_path):
    """files follow the lines, not the number of tables."""
    text = F.when(F.col("id") % 3 == 0, "# a comment").when(F.col("id") % 3 == 1, F.concat("id", F.lit("  1 2\t3"))).otherwise("nv 4 5 6 7")
    lines = spark.range(0, 3000, 1, 4).select(F.concat(F.lit("T"), F.expr("id div 3")).alias("lut_id"), text.alias("value"))
    SK.write_lut_lines(lines, str(tmp_path / "luts"))
    got = {tuple(r) for r in RD.read_lut_lines(spark, str(tmp_path / "luts")).collect()}
    want = {(f"T{k}", float(3 * k + 1), 1, 2, 3, 255, False) for k in range(1000)} | {(f"T{k}", None, 4, 5, 6, 7, True) for k in range(1000)}
    assert got == want
    assert len(list((tmp_path / "luts").rglob("part-*"))) == 4


def diamond(name, cx, cy, r=2.0):
    ring = [(cx - r, cy), (cx, cy - r), (cx + r, cy), (cx, cy + r), (cx - r, cy)]
    return (name, [[[{"x": x, "y": y} for x, y in ring]]])


POLYGONS = "id string, parts array<array<array<struct<x: double, y: double>>>>"


def test_zonal_stats_meet_copies_once(spark, monkeypatch):
    """F16, F17: 30 scenes of 16 places and 40 polygons of two shapes are 16 places and two shapes to the join."""
    met, join = [], S.pip_join

    def seen(points, polygons, **options):
        met.append((points.count(), polygons.count()))
        return join(points, polygons, **options)

    monkeypatch.setattr(S, "pip_join", seen)
    points = spark.createDataFrame([(k % 4 + 0.25, k // 4 % 4 + 0.25, float(k) if k % 7 else None) for k in range(480)], "x double, y double, v double")
    polygons = spark.createDataFrame([diamond(f"P{k % 39}", 1.0 + k % 2, 1.0, 2.1) for k in range(40)], POLYGONS)
    got = {r.id: r[1:] for r in S.zonal_stats(points, polygons, ["v"], keys=("id",)).collect()}
    assert met == [(16, 2)]
    for name, shapes in {"P0": (1.0, 2.0), "P1": (2.0,), "P2": (1.0,)}.items():
        held = [r.v for r in points.collect() for cx in shapes if abs(r.x - cx) + abs(r.y - 1.0) < 2.1]
        valued = [v for v in held if v is not None]
        n, mean, most = got[name]
        assert (n, most) == (len(held), max(valued)) and abs(mean - sum(valued) / len(valued)) <= 0.0005
    assert len(got) == 39


def test_coverage_is_counted_on_the_lattice(spark, monkeypatch):
    """both sides meet by lattice cells, without a join of points with polygons."""
    monkeypatch.setattr(S, "_grid_join", None)
    zones = [diamond("a", 3.1, 3.2, 3.0), diamond("b", 20.0, 3.0, 2.5), ("none", [])]
    homes = [diamond("s", 2.3, 3.1, 1.0), diamond("s", 2.9, 3.45, 1.0), diamond("s", 19.0, 3.0, 0.1), diamond("s", 300.0, 3.0)]
    got = {r[0]: r[1] for r in S.coverage_share(spark.createDataFrame(zones, POLYGONS), spark.createDataFrame(homes, POLYGONS).select("parts"), 0.25).collect()}
    centres = [(i * 0.25 + 0.125, j * 0.25 + 0.125) for i in range(120) for j in range(40)]
    own = [(x, y) for x, y in centres if abs(x - 3.1) + abs(y - 3.2) < 3.0]
    hit = [p for p in own if any(abs(p[0] - x) + abs(p[1] - y) < 1.0 for x, y in ((2.3, 3.1), (2.9, 3.45)))]
    assert got["a"] == round(len(hit) / len(own), 4) and got["b"] >= 0.0 and got["none"] is None


def test_land_cover_takes_every_image_of_the_year(spark):
    """no image of the year is left out by a derived footprint, in the query or its SQL."""
    assert "footprints" not in ORACLES["p01_land_cover"]
    plan = QUERIES["p01_land_cover"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "image_id" not in plan


def test_rasters_are_read_whole(spark):
    """every cell of each scene comes out, also those that the pixel table lacks."""
    cells = QUERIES["src04_decode_rasters"](spark, "/root/testdata/sf0.001")
    assert {r["count"] for r in cells.groupBy("layer").count().collect()} == {64 * 64}


def test_centroids_on_an_edge_are_the_same_in_sql(spark, tmp_path):
    """the SQL adds a centroid up in the ring's order, so the last digit of one on an edge isn't left to chance."""
    folder, db = str(tmp_path), duckdb.connect()
    spark.range(45000, 50000).withColumnRenamed("id", "c_custkey").write.parquet(f"{folder}/customer.parquet")
    spark.range(3000, 3340).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("n"), "id").alias("s_name")).write.parquet(f"{folder}/supplier.parquet")
    for name in ("customer", "supplier"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    got = {tuple(r) for r in QUERIES["j14_count_centroids"](spark, folder).select("id", "n_agsub").collect()}
    scrambled = "FROM (SELECT * FROM settlement_edges ORDER BY hash(k, xi, yi))"
    assert got == set(db.execute(ORACLES["j14_count_centroids"].replace("FROM settlement_edges", scrambled)).fetchall())
