"""Readers and writers on files."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cellweave.functions.grid import GridMeta
from cellweave.plans import products as PR
from cellweave.session import scratch_path
from cellweave.sources import rasters, readers, registries, sinks


def test_missing_input_policies(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_gtfs(spark, str(tmp_path), "stops")
    empty = readers.read_gtfs(spark, str(tmp_path), "stops", on_missing="empty")
    assert empty.count() == 0 and "stop_lat" in empty.columns
    with pytest.raises(ValueError):
        readers.read_gtfs(spark, str(tmp_path), "stops", on_missing="perhaps")


def test_feed_ids_stay_text_and_columns_match_by_name(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("stop_lat,stop_id,extra,stop_lon\n-30.1,007,x,-51.2\nbad,8,y,\n")
    rows = readers.read_gtfs(spark, str(tmp_path), "stops").orderBy("stop_id").collect()
    assert [(r.stop_id, r.stop_lat, r.stop_code) for r in rows] == [("007", -30.1, None), ("8", None, None)]


def test_feed_files_split_unless_a_field_holds_a_line_break(spark, tmp_path):
    plain = "stop_id,stop_name\n" + "".join(f'{k},"name ""{k}"""\n' for k in range(3000))
    (tmp_path / "stops.txt").write_text(plain)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows = readers.read_gtfs(spark, str(tmp_path), "stops")
        assert rows.count() == 3000 and rows.rdd.getNumPartitions() > 1 and rows.where("stop_id = '7'").first().stop_name == 'name "7"'
        (tmp_path / "stops.txt").write_text(plain + '3000,"two\nlines"\n')
        spark.catalog.clearCache()
        rows = readers.read_gtfs(spark, str(tmp_path), "stops")
        assert rows.count() == 3001 and rows.where("stop_id = '3000'").first().stop_name == "two\nlines"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_raster_tables(spark, tmp_path):
    cells = [("GHI", r, c, float(4 * r + c)) for r in range(3) for c in range(4)]
    cells[0], cells[5] = ("GHI", 0, 0, float("nan")), ("GHI", 1, 1, -9999.0)
    place = spark.createDataFrame([("GHI", 4, 3, 0.0025, 0.0025, -51.40, -29.88)], "layer string, width int, height int, sx double, sy double, ox double, oy double")
    rasters.write_rasters(spark.createDataFrame(cells, "layer string, row int, col int, value double"), place, str(tmp_path))
    pixels, meta = rasters.split_meta(rasters.read_rasters(spark, str(tmp_path)))
    assert pixels.count() == 12 and pixels.where("value is null").count() == 2
    assert pixels.where("row = 2 and col = 3").first().value == 11.0
    assert meta.first()[:] == ("GHI", 4, 3, 0.0025, 0.0025, -51.40, -29.88)
    assert rasters.read_rasters(spark, str(tmp_path / "no"), on_missing="skip").count() == 0


def test_colour_table_files(spark, tmp_path):
    (tmp_path / "depth_colors.txt").write_text("# title 1 2 3\nnv 0 0 0 0\n\n-0.5 10 20 30\n  1  4 5 6 128\n")
    rows = readers.read_lut(spark, str(tmp_path)).orderBy(F.col("v").asc_nulls_first()).collect()
    assert [(r.lut_id, r.v, r.r, r.a, r.is_nv) for r in rows] == [
        ("depth_colors", None, 0, 0, True), ("depth_colors", -0.5, 10, 255, False), ("depth_colors", 1.0, 4, 128, False),
    ]


def test_registry_lines(spark, tmp_path):
    entries = [
        {"dataset_id": "a", "resolution": "30m", "value_encoding": {"type": "class_lookup", "classes": {"0": {"name": "Water", "color": "#62B0CC"}}},
         "assets": {"download": {"cog_url": "https://example.org/a.tif"}, "metadata": {"url": []}}},
        {"dataset_id": "b", "assets": {"download": {"cog_url": ["https://example.org/b.tif", "https://example.org/c.tif"]}}},
    ]
    (tmp_path / "datasets.jsonl").write_text("\n".join(map(json.dumps, entries)))
    (tmp_path / "layers.jsonl").write_text(json.dumps({"layer_id": "l", "analytical_level": 2, "source_datasets": [], "dependencies": ["a", "b"]}))
    rows = {r.dataset_id: r for r in registries.read_registry(spark, str(tmp_path / "datasets.jsonl"), "datasets").collect()}
    assert rows["a"].assets == {"download": {"cog_url": ["https://example.org/a.tif"]}, "metadata": {"url": []}}
    assert rows["a"].classes[0].color == "#62B0CC" and len(rows["b"].assets["download"]["cog_url"]) == 2
    layer = registries.read_registry(spark, str(tmp_path / "layers.jsonl"), "layers").first()
    assert layer.dependencies == ["a", "b"] and layer.analytical_level == 2
    assert registries.read_registry(spark, str(tmp_path / "none.jsonl"), "layers", on_missing="empty").count() == 0


def test_geojson_document(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    features = [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring, ring]}, "properties": {"neighbourhood_number": "1", "neighbourhood_name": "A", "n": 3}},
        {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}, "properties": {"neighbourhood_number": "2"}},
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"neighbourhood_number": "3"}},
    ]
    (tmp_path / "n.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    rows = readers.read_geojson(spark, str(tmp_path / "n.geojson")).orderBy("ord").collect()
    assert [(r.id, [len(p) for p in r.parts]) for r in rows] == [("1", [2]), ("2", [1, 1]), ("3", [])]
    assert rows[0].props["n"] == "3" and rows[1].name is None


def test_published_paths():
    keys = {"scope": "poa", "dataset_id": "dem", "version": "v1"}
    assert sinks.publish_path(**keys, period="2024") == "poa/dem/release/v1/2024"
    assert sinks.publish_path(**keys, period="") == "poa/dem/release/v1"


def test_whole_product(spark):
    meta = GridMeta(30, 30, 0.002, 0.002, -51.38, -29.9)
    base = spark.range(900).select(F.lit("s").alias("layer"), F.expr("id div 30").alias("row"), (F.col("id") % 30).alias("col"), F.col("id").alias("k"))
    obs = base.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("img_ord")).select(
        "layer", "row", "col", "img_ord", F.lit("NDVI").alias("band"), F.lit("i").alias("image_id"),
        F.to_timestamp(F.lit("2024-05-01")).alias("ts"), (F.col("k") * 10.0 * F.col("img_ord")).alias("value"),
    )
    made = PR.raster_product(obs, meta, PR.PRODUCTS["ndvi"], levels=2, z_min=9, z_max=11)
    assert made["grid"].count() > 0
    tiles = made["value_tiles"]
    assert {r.z for r in tiles.select("z").distinct().collect()} <= {9, 10, 11}
    decoded = tiles.select(((F.col("r") * 65536 + F.col("g") * 256 + F.col("b")) * 0.001 - 1).alias("v"))
    lo, hi = decoded.agg(F.min("v"), F.max("v")).first()
    assert -0.001 <= lo and hi <= 1.35
    doc = json.loads(made["metadata"].first().document)
    assert doc["time_period"] == "2024" and doc["encoding"]["offset"] == -1.0
    path = scratch_path(spark, "tiles")
    sinks.write_tiles(made["visual_tiles"], path)
    assert spark.read.parquet(path).count() == made["visual_tiles"].count()


def test_csv_quotes_commas_breaks_and_blanks(spark, tmp_path):
    from cellweave.sources import readers, sinks

    name = 'Rua "Nova", centro\n  '
    (tmp_path / "routes.txt").write_text('route_id,route_short_name,route_long_name,route_type,route_color\n1,A,"Rua ""Nova"", centro\n  ",3,00FF00\n')
    row = readers.read_gtfs(spark, str(tmp_path), "routes").first()
    assert (row.route_long_name, row.route_type, row.route_color) == (name, 3, "00FF00")
    out = str(tmp_path / "csv")
    sinks.write_csv(spark.createDataFrame([(1, name), (2, " lead ")], "k INT, t STRING"), out)
    text = "".join(p.read_text() for p in sorted((tmp_path / "csv").glob("*.csv")))
    assert '"Rua ""Nova"", centro\n  "' in text and "2, lead " in text


def test_metadata_decodes_what_products_encode(spark):
    import json

    from pyspark.sql import functions as F

    from cellweave.operators.nested import layer_metadata
    from cellweave.plans import products as PR

    for spec in PR.PRODUCTS.values():
        encoding = json.loads(layer_metadata(PR.spec_row(spark, spec)).first().document)["encoding"]
        value = {"class": float(spec.codes[1][0]) if spec.codes else 1.0, "terrain": spec.enc_offset + 7 * spec.enc_scale, "packed": 9.0}[spec.encoding]
        c = spark.range(1).select(PR.value_color(F.lit(value), spec).alias("c")).first().c
        found = eval(encoding["decode_formula"].removeprefix("value = "), {"R": c.r, "G": c.g, "B": c.b, "scale": encoding["scale"], "offset": encoding["offset"]})  # noqa: S307
        assert abs(found - value) < 1e-6, spec.layer


def test_layers_written_apart_stay(spark, tmp_path):
    from cellweave.sources import sinks

    cells = spark.createDataFrame([("a", 0, 0, 1.0), ("b", 0, 0, 2.0)], "layer STRING, row LONG, col LONG, value DOUBLE")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for layer in ("a", "b", "b"):
            sinks.write_pixels(cells.where(cells.layer == layer), str(tmp_path / "px"))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert sorted(r.layer for r in spark.read.parquet(str(tmp_path / "px")).collect()) == ["a", "b"]
