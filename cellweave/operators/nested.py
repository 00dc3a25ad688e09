"""Nested responses and feature documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.operators.ranking import running_total
from cellweave.operators.sizing import join_small

KEEP_NULLS = {"ignoreNullFields": "false"}


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct fields, at any depth, as top-level columns ``outer<sep>inner``."""

    def leaves(fields, path: tuple[str, ...]):
        for f in fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType.fields, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here))

    return df.select(*leaves(df.schema.fields, ()))


def expand_array(df: DataFrame, col: str) -> DataFrame:
    """One row per element, its fields beside the other columns; an empty array keeps its row."""
    others = [F.col(c) for c in df.columns if c != col]
    return df.select(*others, F.explode_outer(col).alias("_item")).select(
        *[c for c in df.columns if c != col], "_item.*"
    )


def expand_results(df: DataFrame) -> DataFrame:
    """``resultados[]`` then ``series[]``, flattened, of a census response."""
    return flatten_struct(expand_array(expand_array(df, "resultados"), "series"))


def extract_classification(items: Column, class_id: str | int) -> Column:
    """STRUCT<id, label>: first category of the first classification with that id and a category."""
    matching = F.filter(
        items, lambda i: (i["id"].cast("string") == F.lit(str(class_id))) & (F.size(i["categoria"]) > 0)
    )
    category = F.try_element_at(matching, F.lit(1))["categoria"]
    return F.struct(
        F.try_element_at(F.map_keys(category), F.lit(1)).alias("id"),
        F.try_element_at(F.map_values(category), F.lit(1)).alias("label"),
    )


def latest_period(df: DataFrame, map_col: str = "serie", out: str = "value") -> DataFrame:
    """Value at the greatest period key found anywhere in the table; NULL where a row lacks it.

    A table without any period stops the job.
    """
    newest = df.agg(F.max(F.array_max(F.map_keys(map_col))).alias("p")).select(
        F.coalesce("p", F.raise_error(F.lit("no period column found")).cast("string"))
    )
    return df.withColumn(out, F.try_element_at(F.col(map_col), newest.scalar()))


def explode_categories(meta: DataFrame) -> DataFrame:
    """(class_id, class_name, category_id, category_name) rows of a metadata response."""
    classes = meta.select(F.explode("classificacoes").alias("c"))
    return classes.select(
        F.col("c.id").alias("class_id"), F.col("c.nome").alias("class_name"), F.explode("c.categorias").alias("g")
    ).select("class_id", "class_name", F.col("g.id").alias("category_id"), F.col("g.nome").alias("category_name"))


def explode_classes(datasets: DataFrame) -> DataFrame:
    """Legend rows (dataset_id, class, name, color)."""
    return datasets.select("dataset_id", F.explode(F.map_entries("classes")).alias("e")).select(
        "dataset_id",
        F.col("e.key").alias("class"),
        F.col("e.value.name").alias("name"),
        F.col("e.value.color").alias("color"),
    )


def explode_assets(datasets: DataFrame) -> DataFrame:
    """(dataset_id, asset, kind, url) rows; an empty url list gives none."""
    kinds = datasets.select("dataset_id", F.explode("assets").alias("asset", "urls"))
    return kinds.select("dataset_id", "asset", F.explode("urls").alias("kind", "list")).select(
        "dataset_id", "asset", "kind", F.explode("list").alias("url")
    )


def as_array(c: Column) -> Column:
    """Text that is one string or a JSON list of strings, as an array; NULL stays NULL."""
    return F.when(F.ltrim(c).startswith("["), F.from_json(c, "array<string>")).when(c.isNotNull(), F.array(c))


def merge_props(features: DataFrame, stats: DataFrame, key: str, props: str = "props") -> DataFrame:
    """Overlay computed columns on the property map; unmatched features keep theirs."""
    names = [c for c in stats.columns if c != key]
    new = F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("string") for n in names])
    )
    fresh = stats.select(key, new.alias("_new"))
    kept = F.map_filter(F.col(props), lambda k, _: ~k.isin(names))
    merged = F.when(F.col("_new").isNotNull(), F.map_concat(kept, F.col("_new"))).otherwise(F.col(props))
    return join_small(features, fresh, key, "left").withColumn(props, merged).drop("_new")


def point_geometry(lon: Column, lat: Column) -> Column:
    return F.struct(
        F.lit("Point").alias("type"), F.array(lon.cast("double"), lat.cast("double")).alias("coordinates")
    )


def line_geometry(coordinates: Column) -> Column:
    return F.struct(F.lit("LineString").alias("type"), coordinates.alias("coordinates"))


def polygon_geometry(parts: Column) -> Column:
    """MultiPolygon from ``parts``."""
    rings = F.transform(parts, lambda p: F.transform(p, lambda r: F.transform(r, lambda v: F.array(v["x"], v["y"]))))
    return F.struct(F.lit("MultiPolygon").alias("type"), rings.alias("coordinates"))


def to_feature(df: DataFrame, geometry: Column, props: Mapping[str, Column] | Column, keep: Sequence[str] = ()) -> DataFrame:
    """Feature structs; ``keep`` columns ride along (an ordinal, a key)."""
    properties = props if isinstance(props, Column) else F.struct(*[c.alias(n) for n, c in props.items()])
    return df.select(
        *keep,
        F.struct(
            F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")
        ).alias("feature"),
    )


def feature_json(feature: Column | str = "feature") -> Column:
    """JSON text of a feature; missing properties stay as explicit nulls."""
    return F.to_json(F.col(feature) if isinstance(feature, str) else feature, KEEP_NULLS)


def to_feature_collection(features: DataFrame, order_by: str) -> DataFrame:
    """The lines (line_no, line) of one FeatureCollection document.

    Written in order, the lines are a valid document; no task ever holds more than
    its own features. ``order_by`` must be unique.
    """
    lines = running_total(features.select(F.col(order_by).alias("_ord"), "feature"), ["_ord"], out="line_no").select(
        "line_no",
        F.concat(F.when(F.col("line_no") > 1, F.lit(",")).otherwise(F.lit("")), feature_json()).alias("line"),
    )
    spark = features.sparkSession
    head = spark.range(1).select(
        F.lit(0).cast("bigint").alias("line_no"), F.lit('{"type":"FeatureCollection","features":[').alias("line")
    )
    tail = features.agg((F.count(F.lit(1)) + 1).alias("line_no")).select("line_no", F.lit("]}").alias("line"))
    return head.unionByName(lines).unionByName(tail)


# How each encoding is read back. A packed value that was shifted also needs its offset.
DECODE_FORMULAS = {
    "terrain_rgb": "value = (R * 256 * 256 + G * 256 + B) * scale + offset",
    "rgb_packed": "value = R + 256*G + 65536*B",
    "rgb_packed_offset": "value = R + 256*G + 65536*B + offset",
    "class_lookup": "value = R",
}


def layer_metadata(rows: DataFrame) -> DataFrame:
    """Metadata documents (layer, document) from registry rows.

    The formula follows the encoding's type; ``offset`` is what decoding adds. An absent time period is left out of the document.
    """
    kind = F.col("type") if "type" in rows.columns else F.lit("terrain_rgb")
    formula = F.lit(None).cast("string")
    for name, text in DECODE_FORMULAS.items():
        formula = F.when(kind == name, text).otherwise(formula)
    shifted = (kind == "rgb_packed") & (F.col("offset") != 0)
    formula = F.when(shifted, DECODE_FORMULAS["rgb_packed_offset"]).otherwise(formula)
    encoding = F.struct(
        kind.alias("type"),
        F.col("scale").cast("double").alias("scale"),
        F.col("offset").cast("double").alias("offset"),
        F.coalesce("unit", F.lit("")).alias("unit"),
        formula.alias("decode_formula"),
    )
    return rows.select(
        "layer", F.to_json(F.struct("layer", "description", "time_period", encoding.alias("encoding"))).alias("document")
    )
