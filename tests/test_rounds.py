"""Operators that go by rounds or split their work: results against plain Python, and how many rounds they take."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.functions import geometry as G
from cellweave.operators import registry as R
from cellweave.operators import spatial as SP
from cellweave.operators import surface as SU


def layers_of(spark, edges, alone=()):
    names = sorted({x for e in edges for x in e} | set(alone))
    rows = [(n, [a for a, b in edges if b == n]) for n in names]
    return spark.createDataFrame([(n, n, 1, [], d) for n, d in rows], "layer_id string, layer_name string, analytical_level int, source_datasets array<string>, dependencies array<string>")


@pytest.fixture
def settled(monkeypatch):
    """Counts the tables each module writes."""
    count = {"n": 0}

    def counting(plain):
        def settle(df):
            count["n"] += 1
            return plain(df)

        return settle

    for module in (R, SU, SP):
        monkeypatch.setattr(module, "settle", counting(module.settle))
    return count


def test_chain_of_a_thousand(spark, settled):
    n = 1000
    chain = layers_of(spark, [(f"n{k:04d}", f"n{k + 1:04d}") for k in range(n)])
    depths = {r.layer_id: r.depth for r in R.build_order(chain).collect()}
    assert depths == {f"n{k:04d}": k for k in range(n + 1)}
    assert settled["n"] <= 2 * 11 + 2
    settled["n"] = 0
    pairs = R.lineage(chain)
    assert settled["n"] <= 13
    got = pairs.agg(F.count("*"), F.sum(F.substring("layer_id", 2, 9).cast("int") - F.substring("ancestor", 2, 9).cast("int")), F.min(F.col("layer_id") > F.col("ancestor"))).first()
    assert tuple(got) == (n * (n + 1) // 2, sum(k * (n + 1 - k) for k in range(1, n + 1)), True)


def test_random_graphs(spark):
    rng = np.random.default_rng(2)
    for cyclic in (False, True):
        edges = set()
        for _ in range(60):
            a, b = (int(x) for x in rng.integers(0, 40, 2))
            if a != b:
                edges.add((min(a, b), max(a, b)))
        edges = {(f"v{a}", f"v{b}") for a, b in edges} | ({("v39", "v20"), ("v3", "v3")} if cyclic else set())
        layers = layers_of(spark, edges, ["alone"])
        above = {b: {a for a, c in edges if c == b} for _, b in edges}
        reach = {n: set(above.get(n, ())) for n in {x for e in edges for x in e}}
        for _ in range(50):
            reach = {n: s | {x for m in s for x in reach[m]} for n, s in reach.items()}
        assert {tuple(r) for r in R.lineage(layers).collect()} == {(n, a) for n, s in reach.items() for a in s}
        on_cycle = {n for n, s in reach.items() if n in s}

        def depth(n):
            return None if n in on_cycle or reach.get(n, set()) & on_cycle else max((depth(a) + 1 for a in above.get(n, ())), default=0)

        assert {r.layer_id: r.depth for r in R.build_order(layers).collect()} == {n: depth(n) for n in {*reach, "alone"}}


def drained(dem, sx, sy):
    """Cells draining through each cell, by following every cell down."""
    to = {}
    for (r, c), v in dem.items():
        best = None
        for rank, (dr, dc) in enumerate(SU.NEIGHBOURS.values()):
            w = dem.get((r + dr, c + dc))
            if w is not None and v > w:
                drop = ((v - w) / ((dr * sy) ** 2 + (dc * sx) ** 2) ** 0.5, -rank)
                if best is None or drop > best[0]:
                    best = drop, (r + dr, c + dc)
        to[r, c] = best and best[1]
    count = dict.fromkeys(dem, 0)
    for cell in dem:
        while cell is not None:
            count[cell] += 1
            cell = to[cell]
    return count


@pytest.mark.parametrize("block", [4, 7, 256])
def test_flow_accumulation_by_blocks(spark, block):
    rng = np.random.default_rng(4)
    rough = {(r, c): float(rng.integers(0, 50)) for r in range(30) for c in range(25) if rng.random() > 0.05}
    # One long way: rows to and fro, all downhill, through many blocks.
    snake, height = {}, 5000.0
    for r in range(0, 30, 2):
        for c in range(25) if r % 4 == 0 else range(24, -1, -1):
            snake[r, c], height = height, height - 1
        snake[r + 1, 24 if r % 4 == 0 else 0], height = height, height - 1
    rows = [("rough", r, c, v) for (r, c), v in rough.items()] + [(None, r, c, v) for (r, c), v in snake.items()]
    dem = spark.createDataFrame(rows, "layer string, row long, col long, value double")
    got = {(x.layer, x.row, x.col): x.cells for x in SU.flow_accumulation(dem, 1.0, 1.0, block=block).collect()}
    assert got == {("rough", *k): n for k, n in drained(rough, 1.0, 1.0).items()} | {(None, *k): n for k, n in drained(snake, 1.0, 1.0).items()}
    assert SU.flow_accumulation(dem.limit(0), 1.0, 1.0, block=block).count() == 0


def test_rounds_touch_border_cells_only(spark, monkeypatch):
    written = []

    def counting(df, plain=SU.settle):
        out = plain(df)
        written.append((set(out.columns), out.count()))
        return out

    monkeypatch.setattr(SU, "settle", counting)
    dem = spark.range(64 * 64).selectExpr("'a' AS layer", "id div 64 AS row", "id % 64 AS col", "cast(10000 - id AS double) AS value")
    SU.flow_accumulation(dem, 1.0, 1.0, block=16).count()
    rounds = [n for columns, n in written if "entering" in columns]
    assert rounds and set(rounds) == {16 * 60} and len(rounds) <= 6


VERTICES = 100_000


@pytest.fixture(scope="module")
def coast(spark):
    """A polygon of 10^5 vertices, a comb of long edges, and points: a million at one place, 3000 elsewhere."""
    angle = np.linspace(0, 2 * np.pi, VERTICES, endpoint=False)
    radius = 40 + np.sin(angle * 7) + 0.002 * np.sin(angle * 9973)
    x, y = np.append(radius * np.cos(angle), radius[0]), np.append(radius * np.sin(angle), 0.0)
    teeth = [(100.0 + k * 0.1, 30.0 if k % 2 else -30.0) for k in range(300)] + [(130.0, -40.0), (100.0, -40.0), (100.0, -30.0)]
    rings = {"coast": list(zip(x.tolist(), y.tolist(), strict=True)), "comb": teeth}
    polygons = spark.createDataFrame([(n, n, k, [[[{"x": a, "y": b} for a, b in ring]]]) for k, (n, ring) in enumerate(rings.items())], f"id STRING, name STRING, ord INT, parts {G.PARTS}")
    rng = np.random.default_rng(8)
    spots = np.concatenate([rng.uniform(-45, 45, (2000, 2)), np.column_stack([rng.uniform(99, 131, 1000), rng.uniform(-45, 35, 1000)])])
    want = set()
    for name, ring in rings.items():
        xi, yi = np.array(ring).T
        xj, yj = np.roll(xi, 1), np.roll(yi, 1)
        for k, (px, py) in enumerate(spots):
            cross = ((yi > py) != (yj > py)) & (px < (xj - xi) * (py - yi) / (yj - yi + 1e-15) + xi)
            if cross.sum() % 2:
                want.add((k, name))
    few = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(spots)], "k long, x double, y double")
    return polygons, few.unionByName(spark.range(1_000_000).select((F.col("id") + 10_000).alias("k"), F.lit(39.0).alias("x"), F.lit(0.5).alias("y"))), want


@pytest.mark.parametrize("limit", [SP.BROADCAST_BYTES, -1])
def test_large_polygon_and_equal_points(spark, coast, monkeypatch, limit):
    polygons, points, want = coast
    monkeypatch.setattr(SP, "BROADCAST_BYTES", limit)
    joined = SP.pip_join(points, polygons, keep=("id",))
    assert {(r.k, r.id) for r in joined.where("k < 10000").collect()} == want
    heap = joined.where("k >= 10000").groupBy("id").count().collect()
    assert [tuple(r) for r in heap] in ([], [("coast", 1_000_000)])
    inside = {k for k, _ in want}
    anti = SP.pip_join(points.where("k < 10000"), polygons, keep=(), how="anti")
    assert {r.k for r in anti.collect()} == set(range(3000)) - inside


def test_split_bins_hold_few_edges(spark, coast):
    polygons, _, _ = coast
    bins = SP._refined(SP._binned(SP._boxed(polygons, ["id"]), ["id"], True), ["id"])
    most = {r.id: r.m for r in bins.groupBy("id").agg(F.max(F.size(F.flatten("_edges"))).alias("m")).collect()}
    assert max(most.values()) <= SP.MAX_EDGES
    assert bins.where("id = 'coast'").count() < VERTICES
