"""Readers of feeds, features, census responses, collections, colour tables and metadata."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.functions.geometry import PARTS
from cellweave.functions.geometry import vertex as make_vertex

# Column layouts of the feed tables. Ids, codes and colours stay text.
GTFS = {
    "stops": "stop_id STRING, stop_code STRING, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE",
    "shapes": "shape_id STRING, shape_pt_lat DOUBLE, shape_pt_lon DOUBLE, shape_pt_sequence INT",
    "routes": "route_id STRING, route_short_name STRING, route_long_name STRING, route_type INT, route_color STRING",
    "trips": "trip_id STRING, route_id STRING, service_id STRING, shape_id STRING",
    "calendar": (
        "service_id STRING, monday INT, tuesday INT, wednesday INT, thursday INT, friday INT, "
        "saturday INT, sunday INT, start_date STRING, end_date STRING"
    ),
    "agency": (
        "agency_id STRING, agency_name STRING, agency_url STRING, agency_timezone STRING, agency_lang STRING, "
        "agency_phone STRING, agency_fare_url STRING"
    ),
    "fare_attributes": (
        "fare_id STRING, price DOUBLE, currency_type STRING, payment_method INT, transfers INT, agency_id STRING"
    ),
    "feed_info": (
        "feed_publisher_name STRING, feed_publisher_url STRING, feed_lang STRING, feed_start_date STRING, "
        "feed_end_date STRING, feed_version STRING, feed_contact_email STRING"
    ),
}
DATE_COLUMNS = ("start_date", "end_date", "feed_start_date", "feed_end_date")
CENSUS = (
    "id STRING, variavel STRING, unidade STRING, resultados ARRAY<STRUCT<"
    "classificacoes: ARRAY<STRUCT<id: STRING, nome: STRING, categoria: MAP<STRING, STRING>>>, "
    "series: ARRAY<STRUCT<localidade: STRUCT<id: STRING, nome: STRING>, serie: MAP<STRING, STRING>>>>>"
)
CENSUS_CLASSES = (
    "id STRING, classificacoes ARRAY<STRUCT<id: STRING, nome: STRING, "
    "categorias: ARRAY<STRUCT<id: STRING, nome: STRING>>>>"
)
METADATA = (
    "layer STRING, description STRING, time_period STRING, "
    "encoding STRUCT<type: STRING, scale: DOUBLE, offset: DOUBLE, unit: STRING, decode_formula: STRING>"
)
LUT = "lut_id STRING, v DOUBLE, r INT, g INT, b INT, a INT, is_nv BOOLEAN"


def read_or(spark: SparkSession, read, schema: str | T.StructType, on_missing: str = "fail") -> DataFrame:
    """Run a reader; a missing path fails, or gives an empty table (``skip`` and ``empty``)."""
    if on_missing not in ("fail", "skip", "empty"):
        raise ValueError(f"unknown policy {on_missing!r}")
    try:
        return read()
    except AnalysisException as error:
        if on_missing == "fail" or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_gtfs(spark: SparkSession, folder: str, table: str, on_missing: str = "fail", line_breaks: bool | None = None) -> DataFrame:
    """A feed table; columns are matched by header name, so order and extras do not matter.

    Quotes inside a field are doubled. A file is split over tasks unless a quoted field
    holds a line break: then some line has an odd number of quotes, which a split scan of
    the lines finds. ``line_breaks`` tells it beforehand and spares the scan.
    """
    schema = T.StructType.fromDDL(GTFS[table])

    def read() -> DataFrame:
        path, broken = f"{folder}/{table}.txt", line_breaks
        if broken is None:
            quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
            broken = not spark.read.text(path).where(quotes % 2 == 1).isEmpty()
        raw = spark.read.options(header=True, quote='"', escape='"', multiLine=broken).csv(path)
        present = set(raw.columns)
        columns = []
        for field in schema:
            text = F.col(f"`{field.name}`") if field.name in present else F.lit(None).cast("string")
            if field.dataType != T.StringType():
                text = text.try_cast(field.dataType)
            columns.append(text.alias(field.name))
        return raw.select(*columns)

    return read_or(spark, read, schema, on_missing)


def service_dates(calendar: DataFrame) -> DataFrame:
    """Feed dates ``yyyyMMdd`` as DATE."""
    dates = {c: F.to_date(c, "yyyyMMdd") for c in DATE_COLUMNS if c in calendar.columns}
    return calendar.withColumns(dates)


def _parts(kind: Column, coordinates: Column) -> Column:
    """GeoJSON coordinates text of a Polygon or MultiPolygon as ``parts``; others give none."""
    ring_type = "array<array<array<double>>>"

    def rings(polygon: Column) -> Column:
        return F.transform(polygon, lambda r: F.transform(r, lambda v: make_vertex(v[0], v[1])))

    single = F.array(rings(F.from_json(coordinates, ring_type)))
    many = F.transform(F.from_json(coordinates, f"array<{ring_type}>"), rings)
    return F.when(kind == "Polygon", single).when(kind == "MultiPolygon", many).otherwise(F.array().cast(PARTS))


def read_geojson(
    spark: SparkSession, path: str, id_key: str = "neighbourhood_number", name_key: str = "neighbourhood_name", on_missing: str = "fail"
) -> DataFrame:
    """Polygon table (id, name, ord, parts, props) of FeatureCollection documents.

    ``ord`` is the feature's place in its document.
    """
    feature = "STRUCT<type: STRING, geometry: STRUCT<type: STRING, coordinates: STRING>, properties: MAP<STRING, STRING>>"
    schema = f"type STRING, features ARRAY<{feature}>"

    def read() -> DataFrame:
        docs = spark.read.schema(schema).option("multiLine", True).json(path)
        rows = docs.select(F.posexplode("features").alias("ord", "f"))
        return _polygon_columns(rows, id_key, name_key)

    empty = f"id STRING, name STRING, ord INT, parts {PARTS}, props MAP<STRING, STRING>"
    return read_or(spark, read, empty, on_missing)


def read_geojson_lines(
    spark: SparkSession, path: str, id_key: str = "neighbourhood_number", name_key: str = "neighbourhood_name", ord_key: str = "ord", on_missing: str = "fail"
) -> DataFrame:
    """The same from newline-delimited features, which split over tasks."""
    schema = "type STRING, geometry STRUCT<type: STRING, coordinates: STRING>, properties MAP<STRING, STRING>"

    def read() -> DataFrame:
        lines = spark.read.schema(schema).json(path)
        rows = lines.select(
            F.col("properties")[ord_key].try_cast("int").alias("ord"), F.struct("geometry", "properties").alias("f")
        )
        return _polygon_columns(rows, id_key, name_key)

    empty = f"id STRING, name STRING, ord INT, parts {PARTS}, props MAP<STRING, STRING>"
    return read_or(spark, read, empty, on_missing)


def _polygon_columns(rows: DataFrame, id_key: str, name_key: str) -> DataFrame:
    return rows.select(
        F.col("f.properties")[id_key].alias("id"),
        F.col("f.properties")[name_key].alias("name"),
        "ord",
        _parts(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("parts"),
        F.col("f.properties").alias("props"),
    )


def read_sidra(spark: SparkSession, landing: str, on_missing: str = "fail") -> DataFrame:
    """Landed census responses, all batches as one table."""

    def read() -> DataFrame:
        return spark.read.schema(CENSUS).option("multiLine", True).option("mode", "PERMISSIVE").json(landing)

    return read_or(spark, read, CENSUS, on_missing)


def read_sidra_classes(spark: SparkSession, path: str, on_missing: str = "fail") -> DataFrame:
    """Metadata responses listing classifications and categories."""

    def read() -> DataFrame:
        return spark.read.schema(CENSUS_CLASSES).option("multiLine", True).json(path)

    return read_or(spark, read, CENSUS_CLASSES, on_missing)


def image_collection(spark: SparkSession, path: str, collection: str | None = None) -> DataFrame:
    """Observations of a collection, written partitioned by band and date."""
    obs = spark.read.parquet(path)
    return obs if collection is None else obs.where(F.col("collection") == collection)


def image(spark: SparkSession, path: str, image_id: str, band: str) -> DataFrame:
    """One band of one image; both filters reach the scan."""
    return spark.read.parquet(path).where((F.col("image_id") == image_id) & (F.col("band") == band))


def parse_lut(lines: DataFrame, text: str = "value", lut_id: str = "lut_id") -> DataFrame:
    """Colour table rows of text lines: ``value R G B [A]``, ``#`` comments, ``nv`` for nodata."""
    words = F.split(F.trim(F.col(text)), r"[\s,:]+")
    kept = lines.where(~F.trim(F.col(text)).rlike("^#|^$")).select(F.col(lut_id).alias("lut_id"), words.alias("w"))
    is_nv = F.lower(F.col("w")[0]) == "nv"

    def channel(i: int) -> Column:
        return F.get("w", F.lit(i)).try_cast("int")

    return kept.select(
        "lut_id",
        F.when(~is_nv, F.col("w")[0].try_cast("double")).alias("v"),
        channel(1).alias("r"), channel(2).alias("g"), channel(3).alias("b"),
        F.coalesce(channel(4), F.lit(255)).alias("a"),
        is_nv.alias("is_nv"),
    )


def read_lut(spark: SparkSession, path: str, on_missing: str = "fail") -> DataFrame:
    """Colour tables of a file or glob; the table id is the file name without ``.txt``."""

    def read() -> DataFrame:
        lines = spark.read.text(path)
        name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.txt)?$", 1)
        return parse_lut(lines.withColumn("lut_id", name))

    return read_or(spark, read, LUT, on_missing)


def read_lut_lines(spark: SparkSession, path: str, on_missing: str = "fail") -> DataFrame:
    """Many colour tables in shared files, each line with its table's id and a tab before it."""

    def read() -> DataFrame:
        parts = F.split(F.col("value"), "\t", 2)
        return parse_lut(spark.read.text(path).select(parts[0].alias("lut_id"), parts[1].alias("value")))

    return read_or(spark, read, LUT, on_missing)


def read_metadata(spark: SparkSession, path: str, on_missing: str = "fail", lines: bool = False) -> DataFrame:
    """Layer metadata: one document per file, or one per line."""

    def read() -> DataFrame:
        return spark.read.schema(METADATA).option("multiLine", not lines).json(path)

    return read_or(spark, read, METADATA, on_missing)
