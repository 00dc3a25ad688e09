"""Polygon expressions on ``parts``: ARRAY<part: ARRAY<ring: ARRAY<STRUCT<x, y>>>>.

Ring 0 of a part is its exterior; further rings are holes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

VERTEX = "struct<x:double,y:double>"
PARTS = f"array<array<array<{VERTEX}>>>"
EDGE = "struct<xi:double,yi:double,xj:double,yj:double>"
RAY_EPSILON = 1e-15


def vertex(x: Column, y: Column) -> Column:
    """One vertex."""
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def exterior_rings(parts: Column) -> Column:
    """First ring of every part; no parts give an empty array."""
    return F.coalesce(
        F.transform(F.filter(parts, lambda p: F.size(p) > 0), lambda p: F.element_at(p, 1)),
        F.array().cast(f"array<array<{VERTEX}>>"),
    )


def all_vertices(rings: Column) -> Column:
    """Vertices of all rings in one array."""
    return F.flatten(rings)


def bbox(rings: Column) -> Column:
    """STRUCT<min_x, min_y, max_x, max_y> over all rings; NULLs when there is no vertex."""
    points = all_vertices(rings)
    xs, ys = F.transform(points, lambda v: v["x"]), F.transform(points, lambda v: v["y"])
    return F.struct(
        F.array_min(xs).alias("min_x"),
        F.array_min(ys).alias("min_y"),
        F.array_max(xs).alias("max_x"),
        F.array_max(ys).alias("max_y"),
    )


def ring_edges(ring: Column) -> Column:
    """Edges of a ring, each vertex with its predecessor, closed cyclically."""
    previous = F.concat(F.slice(ring, -1, 1), F.slice(ring, F.lit(1), F.size(ring) - 1))
    edges = F.zip_with(
        ring,
        previous,
        lambda i, j: F.struct(i["x"].alias("xi"), i["y"].alias("yi"), j["x"].alias("xj"), j["y"].alias("yj")),
    )
    return F.when(F.size(ring) > 0, edges).otherwise(F.array().cast(f"array<{EDGE}>"))


def straddles(py: Column, e: Column) -> Column:
    """Whether an edge's ends lie on either side of a height (half-open in y)."""
    return (e["yi"] > py) != (e["yj"] > py)


def crossing(py: Column, e: Column) -> Column:
    """Where an edge that straddles a height crosses it."""
    return (e["xj"] - e["xi"]) * (py - e["yi"]) / (e["yj"] - e["yi"] + F.lit(RAY_EPSILON)) + e["xi"]


def crosses(px: Column, py: Column, e: Column) -> Column:
    """Whether the ray from the point towards +x crosses the edge (half-open in y)."""
    return straddles(py, e) & (px < crossing(py, e))


def inside_edges(px: Column, py: Column, edges: Column) -> Column:
    """Odd number of crossings."""
    return F.size(F.filter(edges, lambda e: crosses(px, py, e))) % 2 == 1


def in_ring(px: Column, py: Column, ring: Column) -> Column:
    """Point-in-ring by ray casting."""
    return inside_edges(px, py, ring_edges(ring))


def any_part(parts: Column, predicate: Callable[[Column], Column]) -> Column:
    """OR of a predicate over the parts."""
    return F.exists(parts, predicate)


def in_polygon(px: Column, py: Column, parts: Column) -> Column:
    """Inside any exterior ring; holes are not looked at."""
    return any_part(exterior_rings(parts), lambda ring: in_ring(px, py, ring))


def _cross(e: Column) -> Column:
    return e["xj"] * e["yi"] - e["xi"] * e["yj"]


def _total(edges: Column, term: Callable[[Column], Column]) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + term(e))


def ring_area(ring: Column) -> Column:
    """Unsigned planar area of a ring."""
    return F.abs(_total(ring_edges(ring), _cross)) / 2


def _sum_array(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _net(part: Column, measure: Callable[[Column], Column]) -> Column:
    """Measure of the exterior ring minus the holes."""
    holes = F.slice(part, F.lit(2), F.greatest(F.size(part) - 1, F.lit(0)))
    return measure(F.element_at(part, 1)) - _sum_array(F.transform(holes, measure))


def polygon_area(parts: Column) -> Column:
    """Planar area of all parts, holes subtracted."""
    filled = F.filter(parts, lambda p: F.size(p) > 0)
    return _sum_array(F.transform(filled, lambda p: _net(p, ring_area)))


def centroid(parts: Column) -> Column:
    """Area-weighted centroid STRUCT<x, y>, holes subtracted; NULL for zero area."""

    def moment(ring: Column, i: str, j: str) -> Column:
        edges = ring_edges(ring)
        orientation = F.signum(_total(edges, _cross))
        return orientation * _total(edges, lambda e: (e[i] + e[j]) * _cross(e)) / 6

    filled = F.filter(parts, lambda p: F.size(p) > 0)
    area = polygon_area(parts)
    mx = _sum_array(F.transform(filled, lambda p: _net(p, lambda r: moment(r, "xi", "xj"))))
    my = _sum_array(F.transform(filled, lambda p: _net(p, lambda r: moment(r, "yi", "yj"))))
    return F.when(
        area > 0, F.struct(F.try_divide(mx, area).alias("x"), F.try_divide(my, area).alias("y"))
    )


def map_vertices(parts: Column, move: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Apply a coordinate transform to every vertex."""
    return F.transform(
        parts,
        lambda p: F.transform(p, lambda r: F.transform(r, lambda v: vertex(*move(v["x"], v["y"])))),
    )
