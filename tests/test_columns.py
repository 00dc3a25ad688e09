"""Column builders: invariants and edge values."""

import pytest
from pyspark.sql import functions as F

from cellweave.functions import color as C
from cellweave.functions import geometry as G
from cellweave.functions import numeric as N
from cellweave.functions import projection as P
from cellweave.operators import lut as L
from cellweave.plans.products import PRODUCTS


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_rounding_ties_to_even(spark):
    assert list(one(spark, N.round_even(F.lit(0.5)), N.round_even(F.lit(1.5)), N.round_even(F.lit(2.5)))) == [0.0, 2.0, 2.0]


def test_numbers_and_sentinels(spark):
    texts = ["12", " 7.5 ", "1e3", "-", "...", "X", "", "NaN", "1d", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select(N.to_number(F.col("t")).alias("v")).collect()
    assert [r.v for r in rows] == [12.0, 7.5, 1000.0] + [None] * 7


def test_zero_denominator_and_missing(spark):
    assert one(spark, N.ratio(F.lit(1), F.lit(0)))[0] is None
    assert one(spark, N.mask_nodata(F.lit(float("nan")), -9999.0), N.mask_nodata(F.lit(-9999.0), -9999.0))[:] == (None, None)
    assert one(spark, N.clamp(F.lit(None).cast("double"), 0.0, 1.0))[0] is None


def test_integer_cells_saturate(spark):
    got = one(spark, N.cast_cell(F.lit(300.0), "byte"), N.cast_cell(F.lit(-5.0), "byte"), N.cast_cell(F.lit(-2.5), "int16"))
    assert list(got) == [255, 0, -3]


@pytest.mark.parametrize("scale,offset", [(0.001, -1.0), (0.1, 0.0), (0.01, 0.0)])
def test_terrain_round_trip(spark, scale, offset):
    df = spark.range(0, 3000).select((F.col("id") * 0.00137 + offset).alias("v"))
    code = C.encode_terrain(F.col("v"), scale, offset)
    back = df.select("v", code.alias("c")).select("v", C.decode_rgb(F.col("c.r"), F.col("c.g"), F.col("c.b"), "terrain_rgb", F.lit(scale), F.lit(offset)).alias("d"))
    assert back.agg(F.max(F.abs(F.col("v") - F.col("d")))).first()[0] <= scale / 2 + 1e-9


def test_packed_round_trip_and_offset(spark):
    df = spark.createDataFrame([(-50.0,), (0.0,), (255.0,), (256.0,), (70000.4,), (None,)], "v DOUBLE")
    rows = df.select("v", C.encode_packed(F.col("v"), offset=10000.0).alias("c")).select("v", "c.*").collect()
    values = [r.r + 256 * r.g + 65536 * r.b for r in rows]
    assert values == [9950, 10000, 10255, 10256, 80000, 0]


def test_mercator_round_trip(spark):
    df = spark.range(0, 1000).select((F.col("id") * 0.3 - 150).alias("lon"), (F.col("id") * 0.16 - 80).alias("lat"))
    x, y = P.to_mercator(F.col("lon"), F.col("lat"))
    moved = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = P.from_mercator(F.col("x"), F.col("y"))
    worst = moved.agg(F.max(F.abs(lon - F.col("lon")) + F.abs(lat - F.col("lat")))).first()[0]
    assert worst < 1e-9


def test_utm_known_position_and_round_trip(spark):
    e, n = P.to_utm22s(F.lit(-51.23), F.lit(-30.03))
    east, north = one(spark, e, n)
    assert east == pytest.approx(477823.678, abs=2e-3) and north == pytest.approx(6677868.121, abs=2e-3)
    lon, lat = P.from_utm22s(F.lit(east), F.lit(north))
    assert list(one(spark, lon, lat)) == pytest.approx([-51.23, -30.03], abs=1e-9)


def polygon(*rings):
    return F.array(F.array(*[F.array(*[G.vertex(F.lit(float(x)), F.lit(float(y))) for x, y in ring]) for ring in rings]))


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]


def test_area_subtracts_holes_and_membership_ignores_them(spark):
    parts = polygon(SQUARE, HOLE)
    area, inside = one(spark, G.polygon_area(parts), G.in_polygon(F.lit(1.5), F.lit(1.5), parts))
    assert area == 15.0 and inside


def test_unclosed_ring_and_shared_edge(spark):
    ring = F.array(*[G.vertex(F.lit(float(x)), F.lit(float(y))) for x, y in SQUARE[:-1]])
    neighbour = F.array(*[G.vertex(F.lit(float(x) + 4), F.lit(float(y))) for x, y in SQUARE])
    left, right, centre = one(
        spark, G.in_ring(F.lit(4.0), F.lit(2.0), ring), G.in_ring(F.lit(4.0), F.lit(2.0), neighbour), G.in_ring(F.lit(2.0), F.lit(2.0), ring)
    )
    assert centre and left != right


def test_empty_polygon(spark):
    parts = F.array().cast(G.PARTS)
    area, center, rings = one(spark, G.polygon_area(parts), G.centroid(parts), F.size(G.exterior_rings(parts)))
    assert (area, center, rings) == (0.0, None, 0)


@pytest.mark.parametrize("name", sorted(PRODUCTS))
def test_palette_entries_are_hit_exactly(spark, name):
    palette = PRODUCTS[name].palette
    df = spark.createDataFrame([(float(p[0]), *p[1:4]) for p in palette], "v DOUBLE, r INT, g INT, b INT")
    for paint in (L.palette_linear, L.palette_nearest):
        rows = df.select("r", "g", "b", paint(F.col("v"), palette).alias("c")).collect()
        assert all((r.c.r, r.c.g, r.c.b) == (r.r, r.g, r.b) for r in rows)


def test_palette_clamps_outside(spark):
    palette = PRODUCTS["pv_output"].palette
    low, high = one(spark, L.palette_linear(F.lit(-1.0), palette), L.palette_linear(F.lit(9.0), palette))
    assert tuple(low) == palette[0][1:] and tuple(high) == palette[-1][1:]


def test_hex_colors(spark):
    assert one(spark, C.hex_color(F.lit("00FF07")), C.hex_color(F.lit(None).cast("string")), C.hex_color(F.lit("nan")))[:] == ("#00FF07", None, None)
