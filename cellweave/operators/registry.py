"""Integrity rules, lineage and coverage of the dataset and layer registries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.joins import dangling_refs
from cellweave.operators.nested import explode_assets
from cellweave.operators.sizing import join_small
from cellweave.session import cut_lineage, settle

# Required fields and permitted values of the registries.
DATASET_FIELDS = (
    "dataset_id", "dataset_name", "publisher", "license", "resolution",
    "access_type", "source_url", "dataset_type", "description",
)
LAYER_FIELDS = (
    "layer_id", "layer_name", "layer_type", "analytical_level", "category", "source_datasets",
    "dependencies", "transformation_script", "output_format", "s3_path", "description",
)
PERMITTED = {
    "access_type": ("gee", "manual_download", "public_api", "internal_storage"),
    "type": ("categorical_raster", "numeric_raster", "vector"),
    "output_format": ("cog", "geojson", "pmtiles"),
    "analytical_level": ("1", "2", "3"),
}


def _violations(df: DataFrame, rule: str, id_col: str, detail: Column) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"), F.col(id_col).cast("string").alias("id"), detail.cast("string").alias("detail")
    )


def missing_fields(df: DataFrame, id_col: str, fields: Sequence[str], rule: str) -> DataFrame:
    """One violation per entry and required field that is absent or blank text."""
    known = dict(df.dtypes)

    def absent(field: str) -> Column:
        if field not in known:
            return F.lit(True)
        blank = F.col(field).isNull()
        return blank | (F.trim(field) == "") if known[field] == "string" else blank

    lacking = F.array_compact(F.array(*[F.when(absent(f), F.lit(f)) for f in fields]))
    return _violations(df.withColumn("_field", F.explode(lacking)), rule, id_col, F.col("_field"))


def required_dataset_fields(datasets: DataFrame) -> DataFrame:
    return missing_fields(datasets, "dataset_id", DATASET_FIELDS, "R-01")


def required_layer_fields(layers: DataFrame) -> DataFrame:
    return missing_fields(layers, "layer_id", LAYER_FIELDS, "R-02")


def permitted_values(df: DataFrame, id_col: str, permitted: Mapping[str, Sequence[str]] = PERMITTED) -> DataFrame:
    """Values outside the permitted lists, for the listed fields the table has."""
    fields = [f for f in permitted if f in df.columns]
    bad = [
        F.when(
            ~F.col(f).cast("string").isin(list(permitted[f])), F.concat(F.lit(f"{f}="), F.col(f).cast("string"))
        )
        for f in fields
    ]
    return _violations(df.withColumn("_bad", F.explode(F.array_compact(F.array(*bad)))), "R-03", id_col, F.col("_bad"))


def level_rule(layers: DataFrame) -> DataFrame:
    """Level 1 draws on datasets only, levels 2 and 3 on layers only."""
    has_sources = F.coalesce(F.size("source_datasets") > 0, F.lit(False))
    has_dependencies = F.coalesce(F.size("dependencies") > 0, F.lit(False))
    detail = F.when((F.col("analytical_level") == 1) & has_dependencies, "level 1 with dependencies").when(
        (F.col("analytical_level") > 1) & has_sources, "level above 1 with source_datasets"
    )
    return _violations(layers.withColumn("_d", detail).where(F.col("_d").isNotNull()), "R-04", "layer_id", F.col("_d"))


def layer_edges(layers: DataFrame) -> DataFrame:
    """(layer_id, upstream) over datasets and dependencies."""
    both = F.array_distinct(
        F.concat(
            F.coalesce("source_datasets", F.array().cast("array<string>")),
            F.coalesce("dependencies", F.array().cast("array<string>")),
        )
    )
    return layers.select("layer_id", F.explode(both).alias("upstream"))


def closure(edges: DataFrame, start: DataFrame, from_col: str, to_col: str) -> DataFrame:
    """(node, reached) pairs connected by edges from the ``start`` nodes (column ``node``).

    Each round extends only the pairs found last, drops those known before and is
    written to the shared folder; cycles end because no new pair appears.
    """
    steps = cut_lineage(edges.select(F.col(from_col).alias("_from"), F.col(to_col).alias("_to")).distinct())
    frontier = cut_lineage(
        start.select("node").distinct().join(steps, F.col("node") == F.col("_from")).select("node", F.col("_to").alias("reached")).distinct()
    )
    known = frontier
    while not frontier.isEmpty():
        reached = (
            frontier.join(steps, F.col("reached") == F.col("_from"))
            .select("node", F.col("_to").alias("reached"))
            .distinct()
            .join(known, ["node", "reached"], "left_anti")
        )
        frontier = cut_lineage(reached)
        known = known.unionByName(frontier)
    return known


def numbered(names: DataFrame, name: str = "name") -> DataFrame:
    """(name, number): a number for each distinct name, written once so that all readers see the same."""
    return settle(names.select(F.col(name).alias("name")).where("name IS NOT NULL").distinct().withColumn("number", F.monotonically_increasing_id()))


def numbered_edges(edges: DataFrame, from_col: str, to_col: str) -> tuple[DataFrame, DataFrame]:
    """The edges as distinct pairs (node, reached) of numbers, and the numbers' names."""
    ends = edges.select(F.col(from_col).alias("name")).unionByName(edges.select(F.col(to_col).alias("name")))
    nodes = numbered(ends)
    node, reached = nodes.toDF("_from", "node"), nodes.toDF("_to", "reached")
    pairs = edges.select(F.col(from_col).alias("_from"), F.col(to_col).alias("_to")).join(node, "_from").join(reached, "_to")
    return pairs.select("node", "reached").distinct(), nodes


def full_closure(edges: DataFrame, from_col: str, to_col: str) -> DataFrame:
    """(node, reached) pairs from every node.

    Pairs carry their distance, and nodes are numbers. After a round all pairs of up to
    2^k steps are known; a pair of up to twice as many is one of exactly 2^k followed by a
    known one, so only pairs of that distance are joined, each pair is found from few
    others and the rounds grow with the logarithm of the longest distance.
    """
    pairs, nodes = numbered_edges(edges, from_col, to_col)
    known = settle(pairs.withColumn("steps", F.lit(1).cast("bigint")))
    reach = 1
    while True:
        edge_of_known = known.where(F.col("steps") == reach).select("node", F.col("reached").alias("_mid"))
        onward = known.select(F.col("node").alias("_mid"), "reached", "steps")
        longer = edge_of_known.join(onward, "_mid").groupBy("node", "reached").agg((F.min("steps") + reach).alias("steps"))
        new = settle(longer.join(known.select("node", "reached"), ["node", "reached"], "left_anti"))
        if new.isEmpty():
            break
        known, reach = known.unionByName(new), 2 * reach
    named = known.join(nodes.toDF("_node", "node"), "node").join(nodes.toDF("_reached", "reached"), "reached")
    return named.select(F.col("_node").alias("node"), F.col("_reached").alias("reached"))


def lineage(layers: DataFrame, start: DataFrame | None = None, direction: str = "up") -> DataFrame:
    """``up``: (layer_id, ancestor) down to raw datasets; ``down``: (source, affected) layers."""
    ends = {"up": ("layer_id", "upstream"), "down": ("upstream", "layer_id")}
    names = {"up": ("layer_id", "ancestor"), "down": ("source", "affected")}
    if direction in ends:
        edges = layer_edges(layers)
        pairs = full_closure(edges, *ends[direction]) if start is None else closure(edges, start, *ends[direction])
        return pairs.toDF(*names[direction])
    raise ValueError(f"unknown direction {direction!r}")


def impact(layers: DataFrame, dataset_id: str) -> DataFrame:
    """Layers affected by a dataset."""
    start = layers.sparkSession.range(1).select(F.lit(dataset_id).alias("node"))
    return lineage(layers, start, "down")


def build_order(layers: DataFrame) -> DataFrame:
    """(layer_id, depth): 0 without upstream layers, else one more than the deepest of them.

    Pairs of layers that a chain of exactly 1, 2, 4, ... steps joins are found by joining
    each such relation with itself, until there is none. The longest chain that ends at a
    layer is then put together from the largest power down: a layer takes the greatest
    depth a pair leads to. Both go by the logarithm of the depth. Chains as long as there
    are layers only exist on cycles, so layers that such a chain reaches, on or behind a
    cycle, come out with depth NULL.
    """
    ids = numbered(layers, "layer_id")
    upstream, own = ids.toDF("upstream", "node"), ids.toDF("layer_id", "reached")
    steps = [settle(layer_edges(layers).join(upstream, "upstream").join(own, "layer_id").select("node", "reached").distinct())]
    count, endless = ids.count(), None
    while not steps[-1].isEmpty():
        if 2 ** (len(steps) - 1) >= count:
            endless = steps.pop().select(F.col("reached").alias("number")).distinct()
            break
        onward = steps[-1].toDF("_mid", "reached")
        steps.append(settle(steps[-1].toDF("node", "_mid").join(onward, "_mid").select("node", "reached").distinct()))
    depths = ids.select("number", F.lit(0).cast("int").alias("depth"))
    if endless is not None:
        depths = depths.join(endless, "number", "left_anti")
    for k in range(len(steps) - 1, -1, -1):
        longer = steps[k].join(depths, F.col("node") == F.col("number")).select(F.col("reached").alias("number"), (F.col("depth") + 2**k).alias("depth"))
        if endless is not None:
            longer = longer.join(endless, "number", "left_anti")
        depths = settle(depths.unionByName(longer).groupBy("number").agg(F.max("depth").alias("depth")))
    return ids.join(depths, "number", "left").select(F.col("name").alias("layer_id"), "depth")


def level_monotonicity(layers: DataFrame) -> DataFrame:
    """Dependencies of a higher analytical level than the layer itself."""
    edges = layers.select("layer_id", "analytical_level", F.explode("dependencies").alias("upstream"))
    levels = layers.select(F.col("layer_id").alias("upstream"), F.col("analytical_level").alias("_level"))
    bad = edges.join(levels, "upstream").where(F.col("_level") > F.col("analytical_level"))
    return _violations(bad, "R-07", "layer_id", F.col("upstream"))


def dangling_layer_refs(layers: DataFrame, datasets: DataFrame) -> DataFrame:
    """Source datasets and dependencies that no registry knows."""
    sources = layers.select("layer_id", F.explode("source_datasets").alias("ref"))
    upstream = layers.select("layer_id", F.explode("dependencies").alias("ref"))
    return (
        dangling_refs(sources, datasets, "ref", "dataset_id")
        .withColumn("field", F.lit("source_datasets"))
        .unionByName(dangling_refs(upstream, layers, "ref", "layer_id").withColumn("field", F.lit("dependencies")))
        .select("layer_id", "field", "ref")
    )


# The asset groups of the coverage matrix.
ASSET_GROUPS = {"visual_tiles": "has_visual", "value_tiles": "has_value", "download": "has_download", "metadata": "has_metadata"}


def asset_coverage(datasets: DataFrame) -> DataFrame:
    """Which kinds of asset each dataset offers; any other asset counts as vector."""
    assets = explode_assets(datasets).select("dataset_id", "asset")
    flags = assets.groupBy("dataset_id").agg(
        *[F.max((F.col("asset") == a).cast("int")).alias(c) for a, c in ASSET_GROUPS.items()],
        F.max((~F.col("asset").isin(list(ASSET_GROUPS))).cast("int")).alias("has_vector"),
    )
    names = [*ASSET_GROUPS.values(), "has_vector"]
    return datasets.select("dataset_id").join(flags, "dataset_id", "left").select(
        "dataset_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in names]
    )


def encoding_mismatches(registry: DataFrame, metadata: DataFrame) -> DataFrame:
    """(layer, field, registry_value, metadata_value) where the two disagree."""
    both = registry.alias("a").join(metadata.alias("b"), "layer")
    pairs = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"a.{f}").cast("string").alias("registry_value"),
                F.col(f"b.{f}").cast("string").alias("metadata_value"),
            )
            for f in ("scale", "offset", "unit")
        ]
    )
    return (
        both.select("layer", F.explode(pairs).alias("p"))
        .select("layer", "p.*")
        .where(~F.col("registry_value").eqNullSafe(F.col("metadata_value")))
    )


def registry_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, change): added, changed, or removed, which breaks the append-only rule."""
    packed = F.xxhash64(F.to_json(F.struct(*[c for c in old.columns if c != key])))
    a, b = old.select(key, packed.alias("_old")), new.select(key, packed.alias("_new"))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(
        F.col("_old") != F.col("_new"), "changed"
    )
    return a.join(b, key, "full").select(key, change.alias("change")).where(F.col("change").isNotNull())
