"""Point-polygon joins over a hierarchical grid, and what builds on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions import geometry as G
from cellweave.functions.numeric import ratio, round_even
from cellweave.operators.sizing import BROADCAST_BYTES, join_small, small_side
from cellweave.session import settle

LEVEL_BASE = 4.0
LOWEST_LEVEL, HIGHEST_LEVEL = -20, 20
# Each step makes bins four times finer: more points are settled by their bin alone, at
# the price of more bins to build. Worth raising for few polygons and very many points.
FINENESS = 1
# A bin with more edges is split in 4 x 4; points of a bin beyond HOT_POINTS are dealt over as many
# salts as they are multiples of it.
MAX_EDGES = 64
SPLIT = 4
FINEST = 1e-6
HOT_POINTS = 200_000
# Margins around an edge within which rounding may decide, and the height below which
# the small constant of the ray test moves its crossing noticeably.
EDGE_SLACK = 1 + 1e-6
FLAT_EDGE = 1e-9
COORDINATE_SLACK = 1e-12


def _bin_size(level: Column) -> Column:
    """A power of two, so dividing by it is exact. An extent spans up to five bins."""
    return F.pow(F.lit(LEVEL_BASE), level - FINENESS)


def _boxed(polygons: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Exterior rings, bounding box and grid level of every polygon that has a vertex."""
    rings = polygons.select(*keep, G.exterior_rings(F.col("parts")).alias("_rings"))
    boxed = rings.where(F.size(G.all_vertices(F.col("_rings"))) > 0).select(
        *keep, "_rings", G.bbox(F.col("_rings")).alias("_box")
    )
    extent = F.greatest(F.col("_box.max_x") - F.col("_box.min_x"), F.col("_box.max_y") - F.col("_box.min_y"))
    level = F.when(extent > 0, F.ceil(F.log(extent) / F.log(F.lit(LEVEL_BASE)))).otherwise(F.lit(0))
    bounded = F.least(F.greatest(level, F.lit(LOWEST_LEVEL)), F.lit(HIGHEST_LEVEL)).cast("int")
    return boxed.withColumn("_level", bounded)


def _span(lo: str, hi: str) -> Column:
    size = _bin_size(F.col("_level"))
    return F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size))


def _near(e: Column, x: Column, y: Column, half: Column) -> Column:
    """Whether an edge may touch the square of half-width ``half`` around (x, y); never misses one."""
    dx, dy = e["xj"] - e["xi"], e["yj"] - e["yi"]
    apart = (
        (F.greatest(e["xi"], e["xj"]) < x - half) | (F.least(e["xi"], e["xj"]) > x + half)
        | (F.greatest(e["yi"], e["yj"]) < y - half) | (F.least(e["yi"], e["yj"]) > y + half)
    )
    offset = F.abs(dx * (y - e["yi"]) - dy * (x - e["xi"]))
    # A level edge is never crossed; one that is nearly level may be, far from where it lies.
    flat = (F.abs(dy) < FLAT_EDGE) & (dy != 0)
    one_side = offset > (F.abs(dx) + F.abs(dy)) * half * EDGE_SLACK
    return flat & (F.greatest(e["yi"], e["yj"]) >= y - half) & (F.least(e["yi"], e["yj"]) <= y + half) | ~(apart | one_side)


def _binned(boxed: DataFrame, keep: Sequence[str], exact: bool) -> DataFrame:
    """One row per polygon and grid bin.

    A bin no edge touches lies wholly inside, and needs no further test, or wholly
    outside, and is left out. Other bins carry the edges the rays of their points
    can meet. (For box membership alone, no edges are needed.)
    """
    size = _bin_size(F.col("_level"))
    bands = boxed.withColumn("_by", F.explode(_span("_box.min_y", "_box.max_y")))
    # Few polygons make many bins: spread the bands of each over the tasks.
    bands = bands.repartition("_by", F.col("_box"))
    if not exact:
        return bands.select(*keep, "_box", "_level", "_by", F.explode(_span("_box.min_x", "_box.max_x")).alias("_bx"))
    return _cells(bands, keep, "_rings", _span("_box.min_x", "_box.max_x"))


def _cells(bands: DataFrame, keep: Sequence[str], rings: str, across: Column) -> DataFrame:
    """Bins of the columns ``across`` in each band (_level, _by), from edges by ring that its points' rays can meet.

    ``rings`` holds closed rings of vertices, or the edges that a coarser bin has kept of each.
    """
    size = _bin_size(F.col("_level"))
    low, high = F.col("_by") * size, (F.col("_by") + 1) * size
    edges_of = G.ring_edges if rings == "_rings" else (lambda edges: edges)
    in_band = F.transform(
        F.col(rings),
        lambda r: F.filter(
            edges_of(r),
            lambda e: (F.greatest(e["yi"], e["yj"]) >= low) & (F.least(e["yi"], e["yj"]) <= high),
        ),
    )
    y, half = (F.col("_by") + 0.5) * size, size / 2

    def center_x(bx: Column) -> Column:
        return (bx + 0.5) * size

    def classified(bx: Column) -> Column:
        x = center_x(bx)
        touched = F.exists(F.col("_band"), lambda edges: F.exists(edges, lambda e: _near(e, x, y, half)))
        return F.struct(bx.alias("bx"), touched.alias("touched"))

    def resolved(b: Column) -> Column:
        x = center_x(b["bx"])
        center = F.exists(F.col("_band"), lambda edges: G.inside_edges(x, y, edges))

        def near(e: Column) -> Column:
            """Whether rays of the bin's points may cross the edge, or it parts the bin; edges wholly beyond are not near."""
            dy = F.abs(e["yj"] - e["yi"])
            right = F.greatest(e["xi"], e["xj"]) >= x - half * EDGE_SLACK
            level = right & (F.least(e["xi"], e["xj"]) <= x + half * EDGE_SLACK)
            return F.when(dy == 0, level).otherwise((right | (dy < FLAT_EDGE)) & ~beyond(e))

        def beyond(e: Column) -> Column:
            """Whether all of the edge lies to the right of the bin, clear of rounding."""
            nearest, dy = F.least(e["xi"], e["xj"]), F.abs(e["yj"] - e["yi"])
            return (nearest > x + half * EDGE_SLACK + F.abs(nearest) * COORDINATE_SLACK) & ((dy >= FLAT_EDGE) | (dy == 0))

        def passes(e: Column) -> Column:
            return (F.least(e["yi"], e["yj"]) <= low) & (F.greatest(e["yi"], e["yj"]) >= high)

        def meets(e: Column) -> Column:
            return (F.least(e["yi"], e["yj"]) < high) & (F.greatest(e["yi"], e["yj"]) >= low) & (e["yi"] != e["yj"])

        def kept_edges(edges: Column) -> Column:
            # Beyond the bin a ray crosses a chain of edges an odd number of times if and only if the chain's
            # ends lie on either side of it, so an upright edge between their heights stands for the chain. Of
            # those that pass the whole band only whether their number is odd matters.
            none = F.array(F.lit(None).cast(G.EDGE))
            before = F.concat(none, F.slice(edges, F.lit(1), F.greatest(F.size(edges) - 1, F.lit(0))))
            after = F.concat(F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 1, F.lit(0))), none)

            def linked(first: Column, then: Column) -> Column:
                return F.coalesce(beyond(first) & beyond(then) & (first["xi"] == then["xj"]) & (first["yi"] == then["yj"]), F.lit(False))

            firsts = F.filter(F.zip_with(edges, before, lambda e, o: F.struct(e.alias("e"), o.alias("o"))), lambda s: beyond(s["e"]) & ~linked(s["o"], s["e"]))
            lasts = F.filter(F.zip_with(edges, after, lambda e, o: F.struct(e.alias("e"), o.alias("o"))), lambda s: beyond(s["e"]) & ~linked(s["e"], s["o"]))
            upright = F.zip_with(firsts, lasts, lambda s, t: F.struct(
                s["e"]["xj"].alias("xi"), t["e"]["yi"].alias("yi"), s["e"]["xj"].alias("xj"), s["e"]["yj"].alias("yj")))
            ends = F.filter(upright, lambda e: meets(e) & ~passes(e))
            crossed = F.filter(upright, passes)
            one = F.filter(F.slice(crossed, F.lit(1), F.lit(1)), lambda _: F.size(crossed) % 2 == 1)
            return F.concat(F.filter(edges, near), ends, one)

        return F.struct(
            b["bx"].alias("_bx"), (~b["touched"] & center).alias("_whole"), F.when(b["touched"], F.transform(F.col("_band"), kept_edges)).alias("_edges")
        )

    row = F.transform(F.transform(across, classified), resolved)
    kept = F.filter(row, lambda b: b["_whole"] | b["_edges"].isNotNull())
    return bands.withColumn("_band", in_band).select(*keep, "_box", "_level", "_by", F.inline(kept))


def _refined(bins: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The bins, those of over MAX_EDGES edges split in SPLIT x SPLIT until none is left.

    A quadtree by rounds: each writes its bins once and splits the full ones further, down
    to FINEST of the polygon's extent, where only edges that meet in a point can be too
    many. Bins that no edge touches are not split, so their number follows the boundary.
    """
    done, columns = None, [*keep, "_box", "_level", "_by", "_bx", "_whole", "_edges"]
    extent = F.greatest(F.col("_box.max_x") - F.col("_box.min_x"), F.col("_box.max_y") - F.col("_box.min_y"))
    coarse = (F.col("_level") > LOWEST_LEVEL) & (_bin_size(F.col("_level")) > extent * FINEST)
    full = F.coalesce(coarse & (F.size(F.flatten("_edges")) > MAX_EDGES), F.lit(False))
    while True:
        cut = settle(bins.select(*columns).withColumn("_full", full))
        kept, todo = cut.where("NOT _full").drop("_full"), cut.where("_full").drop("_full")
        done = kept if done is None else done.unionByName(kept)
        if todo.isEmpty():
            return done
        finer = todo.select(
            *keep, "_box", (F.col("_level") - 1).alias("_level"), (F.col("_bx") * SPLIT).alias("_left"), "_edges",
            F.explode(F.transform(F.sequence(F.lit(0), F.lit(SPLIT - 1)), lambda j: F.col("_by") * SPLIT + j)).alias("_by"),
        ).repartition("_by", "_left", F.col("_box"))
        bins = _cells(finer, keep, "_edges", F.sequence(F.col("_left"), F.col("_left") + (SPLIT - 1)))


def _measure(boxed: DataFrame, keep: Sequence[str] = ()) -> tuple[list[int], float, int]:
    """Grid levels in use, an upper bound of the binned bytes and the most edges of a polygon, in one pass."""
    size = _bin_size(F.col("_level"))
    nx = F.floor(F.col("_box.max_x") / size) - F.floor(F.col("_box.min_x") / size) + 1
    ny = F.floor(F.col("_box.max_y") / size) - F.floor(F.col("_box.min_y") / size) + 1

    def bands(e: Column) -> Column:
        return F.floor(F.greatest(e["yi"], e["yj"]) / size) - F.floor(F.least(e["yi"], e["yj"]) / size) + 2

    edges = F.flatten(F.transform(F.col("_rings"), G.ring_edges))
    # Each bin carries the kept columns.
    carried = F.octet_length(F.to_json(F.struct(*keep))) if keep else F.lit(0)
    copies = F.aggregate(edges, F.lit(0).cast("bigint"), lambda total, e: total + bands(e))
    levels, weight, most = boxed.agg(F.collect_set("_level"), F.sum(nx * (ny * (carried + 256.0) + copies * 32.0)), F.max(F.size(edges))).first()
    return sorted(levels) or [0], float(weight or 0.0), most or 0


def _measure_bins(bins: DataFrame, keep: Sequence[str]) -> tuple[list[int], float]:
    """Levels and bytes of refined bins."""
    carried = F.octet_length(F.to_json(F.struct(*keep))) if keep else F.lit(0)
    edges = F.coalesce(F.size(F.flatten("_edges")), F.lit(0))
    levels, weight = bins.agg(F.collect_set("_level"), F.sum(carried + 256.0 + F.greatest(edges, F.lit(0)) * 32.0)).first()
    return sorted(levels) or [0], float(weight or 0.0)


def _hot_bins(points: DataFrame, levels: Sequence[int], px: Column, py: Column) -> DataFrame:
    """(_hlevel, _hx, _hy, _salts) of bins that over HOT_POINTS points meet: few, whatever the number of points."""
    level = F.explode(F.array(*[F.lit(v) for v in levels]))
    placed = points.select(px.alias("_x"), py.alias("_y")).select("_x", "_y", level.alias("_hlevel"))
    size = _bin_size(F.col("_hlevel"))
    counted = placed.groupBy("_hlevel", F.floor(F.col("_x") / size).alias("_hx"), F.floor(F.col("_y") / size).alias("_hy")).agg(F.count(F.lit(1)).alias("_n"))
    return settle(counted.where(F.col("_n") > HOT_POINTS).select("_hlevel", "_hx", "_hy", F.ceil(F.col("_n") / HOT_POINTS).alias("_salts")))


def _grid_join(
    points: DataFrame, polygons: DataFrame, keep: Sequence[str], x: str, y: str, how: str, exact: bool
) -> DataFrame:
    boxed = _boxed(polygons, keep)
    levels, weight, most = _measure(boxed, keep)
    bins = _binned(boxed, keep, exact)
    if exact and most > MAX_EDGES:
        bins = _refined(bins, keep)
        levels, weight = _measure_bins(bins, keep)
    broadcast = weight <= BROADCAST_BYTES
    px, py = F.col(x), F.col(y)
    test = (
        (px >= F.col("_box.min_x")) & (px <= F.col("_box.max_x"))
        & (py >= F.col("_box.min_y")) & (py <= F.col("_box.max_y"))
    )
    if exact:
        test = test & (F.col("_whole") | F.exists(F.col("_edges"), lambda edges: G.inside_edges(px, py, edges)))

    salted = not broadcast
    if salted:
        # Only bins that very many points meet are copied; their points are dealt over the copies by their place.
        hot = small_side(_hot_bins(points, levels, px, py), settled=True)
        same = (F.col("_level") == F.col("_hlevel")) & (F.col("_bx") == F.col("_hx")) & (F.col("_by") == F.col("_hy"))
        copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1)
        bins = bins.join(hot, same, "left").withColumn("_salt", F.explode(copies)).drop("_hlevel", "_hx", "_hy", "_salts")
        points = points.withColumn("_place", F.monotonically_increasing_id())
    bins = F.broadcast(bins) if broadcast else bins

    def probe(rows: DataFrame, level: Column, some_bins: DataFrame, kind: str) -> DataFrame:
        keyed = (
            rows.withColumn("_plevel", level)
            .withColumn("_px", F.floor(px / _bin_size(F.col("_plevel"))))
            .withColumn("_py", F.floor(py / _bin_size(F.col("_plevel"))))
        )
        on = (
            (F.col("_plevel") == F.col("_level")) & (F.col("_px") == F.col("_bx")) & (F.col("_py") == F.col("_by"))
        )
        if salted:
            met = (F.col("_plevel") == F.col("_hlevel")) & (F.col("_px") == F.col("_hx")) & (F.col("_py") == F.col("_hy"))
            dealt = F.pmod(F.col("_place"), F.coalesce("_salts", F.lit(1)))
            keyed = keyed.join(hot, met, "left").withColumn("_psalt", dealt).drop("_hlevel", "_hx", "_hy", "_salts")
            on = on & (F.col("_psalt") == F.col("_salt"))
        return keyed.join(some_bins, on & test, kind).drop("_plevel", "_px", "_py", "_psalt")

    own = ["_place"] if salted else []
    if how == "inner":
        spread = F.explode(F.array(*[F.lit(v) for v in levels])) if len(levels) > 1 else F.lit(levels[0])
        found = probe(points, spread, bins, "inner")
        return found.drop("_box", "_level", "_bx", "_by", "_whole", "_edges", "_salt", *own)
    if how == "anti":
        for v in levels:
            points = probe(points, F.lit(v), bins, "left_anti")
        return points.drop(*own)
    if how == "semi":
        matched = []
        for v in levels:
            matched.append(probe(points, F.lit(v), bins, "left_semi"))
            points = probe(points, F.lit(v), bins, "left_anti")
        result = matched[0]
        for m in matched[1:]:
            result = result.unionByName(m)
        return result.drop(*own)
    raise ValueError(f"unknown join type {how!r}")


def bbox_join(
    points: DataFrame, polygons: DataFrame, keep: Sequence[str] = ("id", "name"), x: str = "x", y: str = "y", how: str = "inner"
) -> DataFrame:
    """Points within each polygon's bounding box, all four sides inclusive."""
    return _grid_join(points, polygons, keep, x, y, how, exact=False)


def pip_join(
    points: DataFrame, polygons: DataFrame, keep: Sequence[str] = ("id", "name"), x: str = "x", y: str = "y", how: str = "inner"
) -> DataFrame:
    """Points inside the exterior rings of each polygon.

    A point in several polygons gives several rows. ``semi`` and ``anti`` keep or
    drop the points that lie in any polygon.
    """
    return _grid_join(points, polygons, keep, x, y, how, exact=True)


def zonal_stats(
    points: DataFrame, polygons: DataFrame, layers: Sequence[str], keys: Sequence[str] = ("id", "name"), n: int = 3
) -> DataFrame:
    """Pixel count, mean and maximum per polygon and layer; polygons without a pixel are absent.

    Pixels at one place (of many scenes) lie in the same polygons and equal polygons hold
    the same pixels, so each place meets each shape once: copies on both sides add up
    instead of being multiplied.
    """
    places = [F.count(F.lit(1)).alias("_n")]
    totals, stats = [F.sum("_n").alias("_n")], []
    for i, layer in enumerate(layers):
        places += [F.sum(layer).alias(f"_s{i}"), F.count(layer).alias(f"_c{i}"), F.max(layer).alias(f"_m{i}")]
        totals += [F.sum(f"_s{i}").alias(f"_s{i}"), F.sum(f"_c{i}").alias(f"_c{i}"), F.max(f"_m{i}").alias(f"_m{i}")]
        stats.append(round_even(ratio(F.col(f"_s{i}"), F.col(f"_c{i}")), n).alias(f"{layer}_mean"))
        stats.append(round_even(F.col(f"_m{i}"), n).alias(f"{layer}_max"))
    # The number of a shape must be the same in every reading, so the shapes are written once.
    shapes = settle(polygons.select("parts").distinct().withColumn("_shape", F.monotonically_increasing_id()))
    pairs = pip_join(points.groupBy("x", "y").agg(*places), shapes, keep=("_shape",))
    per_shape = pairs.groupBy("_shape").agg(*totals)
    found = shapes.join(per_shape, "_shape").withColumnRenamed("parts", "_parts")
    same = polygons.join(found, F.col("parts") == F.col("_parts"))
    return same.groupBy(*keys).agg(*totals).select(*keys, F.col("_n").alias("n_pixels"), *stats)


def clip_geometry(pixels: DataFrame, area: Sequence[float] | DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Keep cells whose centre lies in a box [west, south, east, north] or in any polygon."""
    if isinstance(area, DataFrame):
        return pip_join(pixels, area, keep=(), x=x, y=y, how="semi")
    west, south, east, north = map(float, area)
    return pixels.where(F.col(x).between(west, east) & F.col(y).between(south, north))


def unmatched(polygons: DataFrame, stats: DataFrame, key: str = "id") -> DataFrame:
    """Polygons without a statistics row."""
    return join_small(polygons, settle(stats.select(key).distinct()), key, "left_anti", settled=True)


def count_centroids(polygons: DataFrame, settlements: DataFrame, key: str = "id") -> DataFrame:
    """Settlements whose centroid lies in each polygon; zero where there is none."""
    centers = settlements.select(G.centroid(F.col("parts")).alias("_c")).where(F.col("_c").isNotNull())
    pairs = pip_join(centers.select(F.col("_c.x").alias("x"), F.col("_c.y").alias("y")), polygons, keep=(key,))
    counts = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return polygons.select(key).join(counts, key, "left").select(key, F.coalesce("_n", F.lit(0)).alias("n_agsub"))


def _lattice_cells(boxed: DataFrame, step: Column, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, _i, _j) of the lattice's centres that lie in the exterior rings.

    Where the edges cross the line of a row of centres is worked out once per row; a
    centre is inside if an odd number of crossings lies beyond it.
    """
    rows = boxed.withColumn("_j", F.explode(F.sequence(F.floor(F.col("_box.min_y") / step), F.floor(F.col("_box.max_y") / step))))
    # Few polygons make many rows of centres: spread them over the tasks.
    rows = rows.repartition("_j", F.col("_box"))
    y = (F.col("_j") + 0.5) * step
    crossings = F.transform(
        F.col("_rings"),
        lambda r: F.transform(F.filter(G.ring_edges(r), lambda e: G.straddles(y, e)), lambda e: G.crossing(y, e)),
    )
    columns = F.sequence(F.floor(F.col("_box.min_x") / step), F.floor(F.col("_box.max_x") / step))

    def inside(i: Column) -> Column:
        x = (i + 0.5) * step
        return F.exists(F.col("_at"), lambda ring: F.size(F.filter(ring, lambda at: x < at)) % 2 == 1)

    # The crossings are a column of their own before the lambdas of every centre read them.
    crossed = rows.withColumn("_at", F.explode(F.array(crossings)))
    return crossed.select(*keep, "_j", "_box", F.explode(F.filter(columns, inside)).alias("_i"))


def coverage_share(polygons: DataFrame, settlements: DataFrame, cell: float, key: str = "id") -> DataFrame:
    """Share of each polygon covered by settlements, sampled at cell centres ``cell`` apart.

    Centres sit on one global lattice, so the tolerance is set by ``cell`` alone. Both
    sides are laid on it and meet by the numbers of its cells.
    """
    step = F.lit(float(cell))
    sampled = _lattice_cells(_boxed(polygons, [key]), step, [key]).select(key, "_i", "_j")
    x, y = (F.col("_i") + 0.5) * step, (F.col("_j") + 0.5) * step
    boxed = x.between(F.col("_box.min_x"), F.col("_box.max_x")) & y.between(F.col("_box.min_y"), F.col("_box.max_y"))
    covered = _lattice_cells(_boxed(settlements, []), step).where(boxed).select("_i", "_j").distinct().withColumn("_hit", F.lit(1))
    per_polygon = (
        sampled.join(covered, ["_i", "_j"], "left")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_cells"), F.count("_hit").alias("n_covered"))
    )
    return (
        polygons.select(key)
        .join(per_polygon, key, "left")
        .select(key, round_even(ratio(F.col("n_covered"), F.col("n_cells")), 4).alias("pct_area_agsub"))
    )
