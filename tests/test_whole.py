"""Queries that return everything written: all rows, levels and zooms, the tiles against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import grid as OG
from cellweave.operators.filters import filter_bounds
from cellweave.operators.grid import GridMeta
from cellweave.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
META = GridMeta(4, 4, 0.0025, 0.0025, -51.40, -29.88)
R = 6378137.0


def test_tiles_of_all_zooms(spark):
    cells = {(r, c): float(10 * r + c) for r in range(4) for c in range(4)}
    pixels = spark.createDataFrame([("a", r, c, v) for (r, c), v in cells.items()], "layer string, row long, col long, value double")
    got = {(t.z, t.x, t.y, t.px, t.py): t.value for t in OG.tile(pixels, META, 8, 15).collect()}
    want, half = {}, np.pi * R
    for z in range(8, 16):
        size = 2 * half / 256 / 2**z
        gx = np.arange(int((np.radians(-51.405) * R + half) / size), int((np.radians(-51.385) * R + half) / size))
        top, low = (np.log(np.tan(np.pi / 4 + np.radians(v) / 2)) * R for v in (-29.875, -29.895))
        gy = np.arange(int((half - top) / size), int((half - low) / size))
        col = np.floor((np.degrees((-half + (gx + 0.5) * size) / R) + 51.40) / 0.0025).astype(int)
        row = np.floor((-29.88 - np.degrees(2 * np.arctan(np.exp((half - (gy + 0.5) * size) / R)) - np.pi / 2)) / 0.0025).astype(int)
        for x, c in zip(gx.tolist(), col.tolist(), strict=True):
            for y, r in zip(gy.tolist(), row.tolist(), strict=True):
                if (r, c) in cells:
                    want[z, x // 256, y // 256, x % 256, y % 256] = cells[r, c]
    assert got == want and {k[0] for k in want} >= set(range(12, 16))


def test_footprints_prune_partitions_at_run_time(spark, tmp_path):
    """Images stored by id: the footprints' side decides which of their folders are read."""
    rows = [(f"i{k}", r, float(k)) for k in range(20) for r in range(50)]
    spark.createDataFrame(rows, "image_id string, row int, value double").write.partitionBy("image_id").parquet(str(tmp_path / "obs"))
    meta = [(f"i{k}", float(k), 0.0, k + 0.5, 1.0) for k in range(20)]
    spark.createDataFrame(meta, "image_id string, west double, south double, east double, north double").write.parquet(str(tmp_path / "meta"))
    obs, images = spark.read.parquet(str(tmp_path / "obs")), spark.read.parquet(str(tmp_path / "meta"))
    kept = filter_bounds(obs, images, (3.2, 0.2, 5.1, 0.8))
    assert {r.image_id for r in kept.select("image_id").distinct().collect()} == {"i3", "i4", "i5"} and kept.count() == 150
    assert "dynamicpruning" in kept._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["g05_tile_whole", "snk05_write_tiles_whole"])
def test_queries_return_all_zooms(spark, name):
    assert {r.z for r in QUERIES[name](spark, FOLDER).select("z").distinct().collect()} == set(range(8, 16))


def test_all_rows_levels_and_bands(spark):
    rows = QUERIES["snk03_write_pixels_whole"](spark, FOLDER).agg(F.max("row")).first()[0]
    assert rows >= 20
    assert {r.level for r in QUERIES["snk04_write_overviews_whole"](spark, FOLDER).select("level").distinct().collect()} == {0, 1, 2}
    assert QUERIES["src05_image_collection_whole"](spark, FOLDER).select("band", "year").distinct().count() > 1
