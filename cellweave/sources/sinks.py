"""Writers. All take the save mode; published paths never overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.text import fill_template
from cellweave.operators.nested import feature_json

# Fixed value: the layout of published products.
PUBLISH_TEMPLATE = "{scope}/{dataset_id}/release/{version}/{period}"
ROW_BLOCK = 256


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_geojson(features: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One feature per line."""
    features.select(feature_json().alias("value")).write.mode(mode).text(path)


def write_feature_collection(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lines of one document as ordered part files: joined in name order they are the document."""
    lines.repartitionByRange("line_no").sortWithinPartitions("line_no").select(F.col("line").alias("value")).write.mode(mode).text(path)


def write_pixels(pixels: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pixel table by layer, sorted in square blocks so that window filters skip row groups."""
    block = [F.expr(f"row div {ROW_BLOCK}"), F.expr(f"col div {ROW_BLOCK}")]
    pixels.repartitionByRange("layer", *block).sortWithinPartitions("layer", *block, "row", "col").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("layer").parquet(path)


def write_overviews(levels: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pyramid by layer and level."""
    order = ["layer", "level", "row", "col"]
    levels.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("layer", "level").parquet(path)


def write_tiles(tiles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tile pixels by layer and zoom, sorted by tile. Range partitioning spreads hot zooms."""
    order = ["layer", "z", "x", "y"]
    tiles.repartitionByRange(*order, "py").sortWithinPartitions(*order, "py", "px").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("layer", "z").parquet(path)


def write_tile_blocks(blocks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tiles as rectangles of equal pixels, by zoom; ``block_pixels`` gives the pixels back.

    Sorted by layer and tile, so that filters on them skip row groups: a folder per
    layer would make many small files of many layers.
    """
    order = ["z", "layer", "x", "y", "py0"]
    blocks.repartitionByRange(*order).sortWithinPartitions(*order, "px0").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("z").parquet(path)


def write_lut_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lines (lut_id, value) of many colour tables, as tab-separated text: files follow the lines, not the tables."""
    lines.select(F.concat_ws("\t", "lut_id", "value").alias("value")).write.mode(mode).text(path)


def write_metadata(documents: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per line, by layer."""
    documents.select("layer", F.col("document").alias("value")).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("layer").text(path)


def publish_path(template: str = PUBLISH_TEMPLATE, **keys: str) -> str:
    """The path of a release; an absent period leaves no empty folder."""
    path = template
    for name, value in keys.items():
        path = path.replace("{" + name + "}", value or "")
    return path.rstrip("/").replace("//", "/") if "://" not in path else path.rstrip("/")


def publish(df: DataFrame, root: str, template: str = PUBLISH_TEMPLATE, **keys: str) -> str:
    """Write a release once; an existing one is an error."""
    path = f"{root.rstrip('/')}/{publish_path(template, **keys)}"
    df.write.mode("errorifexists").parquet(path)
    return path


def asset_urls(releases: DataFrame, template: str) -> DataFrame:
    """Templated url per release row."""
    keys = {c: F.col(c) for c in releases.columns}
    return releases.withColumn("url", fill_template(template, **keys))
