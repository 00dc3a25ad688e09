"""Rasters as Parquet pixel tables with a table of their georeferencing beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.numeric import mask_nodata
from cellweave.operators.sizing import join_small
from cellweave.sources.readers import read_or
from cellweave.sources.sinks import write_pixels

META = ("width", "height", "sx", "sy", "ox", "oy")
RASTER = (
    "layer STRING, row INT, col INT, value DOUBLE, width INT, height INT, "
    "sx DOUBLE, sy DOUBLE, ox DOUBLE, oy DOUBLE"
)


def write_rasters(pixels: DataFrame, meta: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pixels (layer, row, col, value) in blocks, and one georeferencing row per layer."""
    write_pixels(pixels, f"{path}/pixels", mode)
    meta.select("layer", *META).write.mode(mode).parquet(f"{path}/meta")


def every_cell(pixels: DataFrame, meta: DataFrame) -> DataFrame:
    """Pixels of all cells of each raster's width and height, NULL where the table has none."""
    rows = meta.where("width > 0 AND height > 0").withColumn("row", F.explode(F.expr("sequence(0L, cast(height as bigint) - 1)")))
    grid = rows.repartition("layer", "row").withColumn("col", F.explode(F.expr("sequence(0L, cast(width as bigint) - 1)")))
    return grid.join(pixels, ["layer", "row", "col"], "left").select("layer", "row", "col", "value", *META)


def read_rasters(
    spark: SparkSession, path: str, nodata: float | None = -9999.0, on_missing: str = "fail", whole: bool = False
) -> DataFrame:
    """Pixels with their layer's georeferencing; NaN and nodata cells come out NULL.

    With ``whole`` cells that the table lacks come out too, as NULL.

    Spark splits the pixel table by rows, so a raster of any size is read by many tasks.
    """

    def read() -> DataFrame:
        pixels, meta = spark.read.parquet(f"{path}/pixels"), spark.read.parquet(f"{path}/meta")
        joined = every_cell(pixels, meta) if whole else join_small(pixels, meta, "layer").select("layer", "row", "col", "value", *META)
        return joined.withColumn("value", mask_nodata(F.col("value").cast("double"), nodata))

    return read_or(spark, read, RASTER, on_missing)


def split_meta(pixels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pixel table and one georeferencing row per layer."""
    return pixels.select("layer", "row", "col", "value"), pixels.select("layer", *META).distinct()
