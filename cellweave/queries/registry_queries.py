"""Registry rules, lineage, coverage and colour table lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions.color import encode_terrain
from cellweave.operators import joins as J
from cellweave.operators import lut as L
from cellweave.operators import nested as NE
from cellweave.operators import registry as R
from cellweave.operators.filters import meets_box
from cellweave.plans.palettes import ELEVATION_30M
from cellweave.queries import tables as T
from cellweave.queries.catalog import VIEWS, query


@query(
    "j12_dangling_refs",
    """SELECT layer_id, 'source_datasets' AS field, ref FROM ly_sources WHERE ref NOT IN (SELECT dataset_id FROM ds)
    UNION ALL SELECT layer_id, 'dependencies', ref FROM ly_deps WHERE ref NOT IN (SELECT layer_id FROM ly)""",
)
def _(spark, d):
    return R.dangling_layer_refs(T.layers(spark, d), T.datasets(spark, d))


ASSETS = """a AS (SELECT dataset_id, 'visual_tiles' AS asset, 'url_template' AS kind, 'https://example.org/visual/' || k AS url FROM ds WHERE k % 2 = 0
  UNION ALL SELECT dataset_id, 'value_tiles', 'url_template', 'https://example.org/value/' || k FROM ds WHERE k % 3 = 0
  UNION ALL SELECT dataset_id, 'download', 'cog_url', 'https://example.org/cog/' || k FROM ds WHERE k % 5 = 0
  UNION ALL SELECT dataset_id, 'download', 'cog_url', 'https://example.org/cog2/' || k FROM ds WHERE k % 5 = 0
  UNION ALL SELECT dataset_id, 'bus_stops', 'url_template', 'https://example.org/stops/' || k FROM ds WHERE k % 11 = 0)"""


@query("nj13_explode_assets", f"WITH {ASSETS} SELECT * FROM a")
def _(spark, d):
    return NE.explode_assets(T.datasets(spark, d))


@query("nj12_explode_classes", "SELECT dataset_id, c AS class, 'class ' || c AS name, printf('#%02x%02X%02X', c * 20, c * 7, 255) AS color FROM (SELECT dataset_id, unnest(range(0, size % 5 + 1)) AS c FROM ds WHERE k % 3 = 0)")
def _(spark, d):
    return NE.explode_classes(T.datasets(spark, d))


@query("nj11_as_array", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN [p_name] WHEN 1 THEN [p_name, p_brand] END AS urls FROM part")
def _(spark, d):
    k = F.col("p_partkey")
    text = F.when(k % 3 == 0, F.col("p_name")).when(k % 3 == 1, F.to_json(F.array("p_name", "p_brand")))
    return T.read(spark, d, "part").select("p_partkey", NE.as_array(text).alias("urls"))


@query("j16_discover", f"""WITH {ASSETS} SELECT collection_id, "group", dataset_id, asset, kind, url FROM collection_members JOIN a USING (dataset_id)""")
def _(spark, d):
    return J.discover(T.collections(spark, d), NE.explode_assets(T.datasets(spark, d))).select("collection_id", "group", "dataset_id", "asset", "kind", "url")


@query(
    "r01_required_dataset_fields",
    """SELECT 'R-01' AS rule, dataset_id AS id, 'publisher' AS detail FROM ds WHERE trim(publisher) = '' UNION ALL SELECT 'R-01', dataset_id, 'license' FROM ds WHERE license IS NULL""",
)
def _(spark, d):
    return R.required_dataset_fields(T.datasets(spark, d))


@query(
    "r02_required_layer_fields",
    """SELECT 'R-02' AS rule, layer_id AS id, unnest(['transformation_script', 's3_path']) AS detail FROM ly UNION ALL SELECT 'R-02', layer_id, 'category' FROM ly WHERE category IS NULL""",
)
def _(spark, d):
    return R.required_layer_fields(T.layers(spark, d))


@query(
    "r03_permitted_values",
    """SELECT 'R-03' AS rule, dataset_id AS id, 'access_type=ftp' AS detail FROM ds WHERE access_type = 'ftp' UNION ALL SELECT 'R-03', layer_id, 'output_format=zip' FROM ly WHERE output_format = 'zip'""",
)
def _(spark, d):
    return R.permitted_values(T.datasets(spark, d), "dataset_id").unionByName(R.permitted_values(T.layers(spark, d), "layer_id"))


@query(
    "r04_level_rule",
    """SELECT 'R-04' AS rule, layer_id AS id, CASE WHEN analytical_level = 1 THEN 'level 1 with dependencies' ELSE 'level above 1 with source_datasets' END AS detail FROM ly
    WHERE (analytical_level = 1 AND layer_id IN (SELECT layer_id FROM ly_deps)) OR (analytical_level > 1 AND layer_id IN (SELECT layer_id FROM ly_sources))""",
)
def _(spark, d):
    return R.level_rule(T.layers(spark, d))


@query(
    "r05_lineage",
    """WITH RECURSIVE c AS (SELECT layer_id, upstream FROM ly_edges UNION SELECT c.layer_id, e.upstream FROM c JOIN ly_edges e ON e.layer_id = c.upstream)
    SELECT layer_id, upstream AS ancestor FROM c""",
)
def _(spark, d):
    return R.lineage(T.layers(spark, d))


@query(
    "r06_build_order",
    """WITH RECURSIVE e AS (SELECT layer_id, upstream FROM ly_edges WHERE upstream IN (SELECT layer_id FROM ly)),
    c AS (SELECT layer_id, 0 AS depth FROM ly UNION SELECT e.layer_id, c.depth + 1 FROM c JOIN e ON e.upstream = c.layer_id)
    SELECT layer_id, max(depth) AS depth FROM c GROUP BY layer_id""",
)
def _(spark, d):
    return R.build_order(T.layers(spark, d))


@query("r07_level_monotonicity", "SELECT 'R-07' AS rule, d.layer_id AS id, d.ref AS detail FROM ly_deps d JOIN ly a ON a.layer_id = d.layer_id JOIN ly b ON b.layer_id = d.ref WHERE b.analytical_level > a.analytical_level")
def _(spark, d):
    return R.level_monotonicity(T.layers(spark, d))


@query(
    "r08_impact",
    """WITH RECURSIVE c AS (SELECT upstream AS source, layer_id AS affected FROM ly_edges WHERE upstream LIKE 'ds%' UNION
      SELECT c.source, e.layer_id FROM c JOIN ly_edges e ON e.upstream = c.affected) SELECT source, affected FROM c""",
)
def _(spark, d):
    layers = T.layers(spark, d)
    starts = layers.select(F.explode("source_datasets").alias("node"))
    return R.lineage(layers, starts, "down")


@query(
    "r09_asset_coverage",
    """SELECT dataset_id, (k % 2 = 0)::INTEGER AS has_visual, (k % 3 = 0)::INTEGER AS has_value, (k % 5 = 0)::INTEGER AS has_download, 0 AS has_metadata, (k % 11 = 0)::INTEGER AS has_vector FROM ds""",
)
def _(spark, d):
    return R.asset_coverage(T.datasets(spark, d))


@query(
    "r10_encoding_mismatches",
    """WITH b AS (SELECT 'L' || p_partkey AS layer, p_partkey AS k FROM part)
    SELECT layer, 'scale' AS field, '0.5' AS registry_value, '0.25' AS metadata_value FROM b WHERE k % 7 = 0
    UNION ALL SELECT layer, 'offset', (k % 9)::VARCHAR || '.0', NULL FROM b WHERE k % 11 = 0 UNION ALL SELECT layer, 'unit', 'm', 'km' FROM b WHERE k % 13 = 0""",
)
def _(spark, d):
    k = F.col("p_partkey")
    part = T.read(spark, d, "part")
    name = F.concat(F.lit("L"), k).alias("layer")
    registry = part.select(name, F.lit(0.5).alias("scale"), (k % 9).cast("double").alias("offset"), F.lit("m").alias("unit"))
    metadata = part.select(
        name, F.when(k % 7 == 0, 0.25).otherwise(0.5).alias("scale"), F.when(k % 11 != 0, (k % 9).cast("double")).alias("offset"),
        F.when(k % 13 == 0, "km").otherwise("m").alias("unit"),
    )
    return R.encoding_mismatches(registry, metadata)


# Value tables written by rule; every eleventh entry is off by one step in G.
VIEWS["coded_lut"] = """
  SELECT 'T' || (p_partkey // 20) AS lut_id, v, (n >> 16)::INTEGER AS r, ((n >> 8) & 255)::INTEGER AS g, (n & 255)::INTEGER AS b
  FROM (SELECT p_partkey, (p_partkey % 20) * 25.0::DOUBLE AS v, round_even(((p_partkey % 20) * 25.0::DOUBLE) / 0.125, 0)::BIGINT + CASE WHEN p_partkey % 11 = 0 THEN 256 ELSE 0 END AS n FROM part)"""


@query("r11_lut_audit", "SELECT lut_id, v, r, g, b, (r * 65536.0::DOUBLE + g * 256 + b) * 0.125::DOUBLE AS decoded FROM coded_lut WHERE abs((r * 65536.0::DOUBLE + g * 256 + b) * 0.125::DOUBLE - v) > 0.0625 + 1e-9")
def _(spark, d):
    k = F.col("p_partkey")
    v = (k % 20) * F.lit(25.0)
    off = v + F.when(k % 11 == 0, F.lit(256 * 0.125)).otherwise(F.lit(0.0))
    table = T.read(spark, d, "part").select(
        F.concat(F.lit("T"), F.expr("p_partkey div 20")).alias("lut_id"), v.alias("v"), encode_terrain(off, 0.125).alias("c"), F.lit(False).alias("is_nv")
    ).select("lut_id", "v", "c.*", "is_nv")
    encodings = table.select("lut_id").distinct().withColumns({"type": F.lit("terrain_rgb"), "scale": F.lit(0.125), "offset": F.lit(0.0)})
    return L.lut_audit(table, encodings)


@query(
    "r12_legend_mismatches",
    """WITH legend AS (SELECT dataset_id, c AS class, printf('#%02X%02X%02X', c * 20, c * 7, 255) AS legend_color FROM (SELECT dataset_id, unnest(range(0, size % 5 + 1)) AS c FROM ds WHERE k % 3 = 0)),
    t AS (SELECT dataset_id, c AS class, printf('#%02X%02X%02X', c * 20, c * 7, CASE WHEN k % 12 = 0 THEN 254 ELSE 255 END) AS lut_color FROM (SELECT dataset_id, k, unnest(range(0, 4)) AS c FROM ds))
    SELECT dataset_id, class, legend_color, lut_color FROM legend FULL JOIN t USING (dataset_id, class) WHERE legend_color IS DISTINCT FROM lut_color""",
)
def _(spark, d):
    datasets = T.datasets(spark, d)
    table = datasets.select("dataset_id", "k", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("c")).select(
        F.col("dataset_id").alias("lut_id"), F.col("c").cast("double").alias("v"), (F.col("c") * 20).alias("r"), (F.col("c") * 7).alias("g"),
        F.when(F.col("k") % 12 == 0, 254).otherwise(255).alias("b"), F.lit(False).alias("is_nv"),
    )
    return L.legend_mismatches(NE.explode_classes(datasets), table)


@query("r13_registry_box", "SELECT image_id FROM footprints WHERE west <= -51.01 AND east >= -51.27 AND south <= -29.93 AND north >= -30.27")
def _(spark, d):
    return T.footprints(spark, d).where(meets_box((-51.27, -30.27, -51.01, -29.93))).select("image_id")


@query(
    "w06_registry_diff",
    """SELECT dataset_id, CASE WHEN k % 15 = 1 THEN 'added' ELSE 'changed' END AS change FROM ds WHERE k % 15 = 1 OR k % 21 = 2
    UNION ALL SELECT 'legacy' || dataset_id, 'removed' FROM ds WHERE k % 15 = 1""",
)
def _(spark, d):
    table = T.datasets(spark, d).select("dataset_id", "dataset_name", "license", "resolution", "k")
    # An entry renamed between the releases counts as removed and added.
    old_id = F.when(F.col("k") % 15 == 1, F.concat(F.lit("legacy"), "dataset_id")).otherwise(F.col("dataset_id"))
    old = table.withColumn("dataset_id", old_id).drop("k")
    changed = F.when(F.col("k") % 21 == 2, F.concat("resolution", F.lit("!"))).otherwise(F.col("resolution"))
    new = table.withColumn("resolution", changed).drop("k")
    return R.registry_diff(old, new, "dataset_id")


# --- colour tables ---------------------------------------------------------------------
NEAREST = """nearest AS (SELECT p.k, arg_min({pick}, (abs(l.v - p.value), l.v)) AS e FROM lut_pixels p JOIN lut l ON l.lut_id = p.lut_id AND NOT l.is_nv WHERE p.value IS NOT NULL GROUP BY p.k)"""


@query(
    "j10_lut_nearest",
    f"""WITH {NEAREST.replace('{pick}', 'struct_pack(v := l.v, r := l.r, g := l.g, b := l.b)')}
    SELECT p.k, e.v AS v, e.r AS r, e.g AS g, e.b AS b FROM lut_pixels p LEFT JOIN nearest USING (k)""",
)
def _(spark, d):
    return L.lut_nearest(T.lut_pixels(spark, d), T.lut(spark, d)).select("k", "entry.*")


@query(
    "j11_lut_bracket",
    """SELECT p.k, max(l.v) FILTER (l.v <= p.value) AS lo, min(l.v) FILTER (l.v >= p.value) AS hi FROM lut_pixels p LEFT JOIN lut l ON l.lut_id = p.lut_id AND NOT l.is_nv GROUP BY p.k""",
)
def _(spark, d):
    return L.lut_bracket(T.lut_pixels(spark, d), T.lut(spark, d)).select("k", F.col("lo.v").alias("lo"), F.col("hi.v").alias("hi"))


def mixed(c: str) -> str:
    return f"CASE WHEN p.value IS NULL THEN n.{c} WHEN lo IS NULL THEN h.{c} WHEN hi IS NULL OR lo = hi THEN a.{c} ELSE round_even(a.{c} + (h.{c} - a.{c}) * ((p.value - lo) / (hi - lo)), 0)::INTEGER END AS {c}"


@query(
    "s12_color_linear",
    f"""WITH br AS (SELECT p.k, max(l.v) FILTER (l.v <= p.value) AS lo, min(l.v) FILTER (l.v >= p.value) AS hi FROM lut_pixels p LEFT JOIN lut l ON l.lut_id = p.lut_id AND NOT l.is_nv GROUP BY p.k)
    SELECT p.k, {mixed('r')}, {mixed('g')}, {mixed('b')} FROM lut_pixels p JOIN br USING (k) LEFT JOIN lut a ON a.lut_id = p.lut_id AND a.v = lo
      LEFT JOIN lut h ON h.lut_id = p.lut_id AND h.v = hi LEFT JOIN lut n ON n.lut_id = p.lut_id AND n.is_nv""",
)
def _(spark, d):
    return L.lut_colors(T.lut_pixels(spark, d), T.lut(spark, d), "linear").select("k", "rgb.*")


@query(
    "s13_color_class",
    f"""WITH {NEAREST.replace('{pick}', 'struct_pack(r := l.r, g := l.g, b := l.b)')} SELECT p.k, coalesce(e.r, n.r) AS r, coalesce(e.g, n.g) AS g, coalesce(e.b, n.b) AS b
    FROM lut_pixels p LEFT JOIN nearest USING (k) LEFT JOIN lut n ON n.lut_id = p.lut_id AND n.is_nv""",
)
def _(spark, d):
    return L.lut_colors(T.lut_pixels(spark, d), T.lut(spark, d), "nearest").select("k", "rgb.*")


def palette_sql(value: str, palette, channel: int) -> str:
    """SQL of one interpolated channel of a constant palette."""
    steps = " ".join(
        f"WHEN {value} < {hi[0]!r} THEN round_even({lo[channel]} + ({hi[channel]} - {lo[channel]}) * (({value} - ({float(lo[0])!r}::DOUBLE)) / {float(hi[0]) - float(lo[0])!r}::DOUBLE), 0)"
        for lo, hi in zip(palette, palette[1:])
    )
    return f"(CASE WHEN {value} <= {palette[0][0]!r} THEN {palette[0][channel]} {steps} WHEN {value} IS NOT NULL THEN {palette[-1][channel]} END)::INTEGER"


@query(
    "s12_palette_linear",
    f"""SELECT layer, "row", "col", {', '.join(f"{palette_sql('(value / 500)', ELEVATION_30M, i)} AS {n}" for i, n in ((1, 'r'), (2, 'g'), (3, 'b')))} FROM scenes""",
)
def _(spark, d):
    return T.scenes(spark, d).select("layer", "row", "col", L.palette_linear(F.col("value") / 500, ELEVATION_30M).alias("c")).select("layer", "row", "col", "c.*")

