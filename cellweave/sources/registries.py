"""Dataset, collection and layer registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.nested import as_array
from cellweave.sources.readers import read_or

DATASETS = (
    "dataset_id STRING, dataset_name STRING, publisher STRING, license STRING, resolution STRING, crs STRING, "
    "access_type STRING, source_url STRING, dataset_type STRING, type STRING, description STRING, "
    "data_quality STRUCT<temporal_coverage: STRING, accuracy: STRING, limitations: STRING>, "
    "value_encoding STRUCT<type: STRING, scale: DOUBLE, offset: DOUBLE, unit: STRING, decode_formula: STRING, "
    "classes: MAP<STRING, STRUCT<name: STRING, color: STRING>>>, "
    "assets MAP<STRING, MAP<STRING, STRING>>"
)
COLLECTIONS = "id STRING, name STRING, `group` STRING, datasets ARRAY<STRING>"
LAYERS = (
    "layer_id STRING, layer_name STRING, layer_type STRING, analytical_level INT, category STRING, "
    "source_datasets ARRAY<STRING>, dependencies ARRAY<STRING>, transformation_script STRING, "
    "output_format STRING, s3_path STRING, description STRING"
)
KINDS = {"datasets": DATASETS, "collections": COLLECTIONS, "layers": LAYERS}


def registry_rows(entries: DataFrame, kind: str, text: str = "value") -> DataFrame:
    """Registry table of JSON entry texts."""
    rows = entries.select(F.from_json(text, KINDS[kind]).alias("e")).select("e.*")
    if kind != "datasets":
        return rows
    urls = F.transform_values("assets", lambda _, kinds: F.transform_values(kinds, lambda _k, u: as_array(u)))
    return rows.withColumn("assets", urls).withColumn(
        "classes", F.transform_keys(F.col("value_encoding.classes"), lambda k, _: k.cast("int"))
    )


def read_registry(spark: SparkSession, path: str, kind: str, on_missing: str = "fail") -> DataFrame:
    """A registry from JSON lines, one entry a line; Spark splits the files by lines."""
    return read_or(spark, lambda: registry_rows(spark.read.text(path), kind), KINDS[kind], on_missing)
