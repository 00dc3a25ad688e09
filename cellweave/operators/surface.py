"""Terrain and composite surfaces."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.functions.numeric import ratio
from cellweave.session import settle

BLOCK = 256
# The eight neighbours in the order that settles ties of descent.
NEIGHBOURS = {
    "e": (0, 1), "se": (1, 1), "s": (1, 0), "sw": (1, -1), "w": (0, -1), "nw": (-1, -1), "n": (-1, 0), "ne": (-1, 1),
}


def neighbourhood(pixels: DataFrame, keys: Sequence[str] = ("layer",), block: int = BLOCK, value: str = "value") -> DataFrame:
    """Each cell with the values of its eight neighbours (NULL where absent).

    Blocks are shuffled once with a one-cell rim. Inside a block every cell is set
    beside the rows above and below it, then the columns left and right are read by
    a window of at most one block row.
    """
    size = F.lit(int(block))

    def blocks(c: str) -> Column:
        return F.explode(F.array_distinct(F.array(*[F.floor((F.col(c) + d) / size) for d in (-1, 0, 1)])))

    cells = pixels.select(
        *keys, F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), F.col(value).alias("_v")
    )
    place = [*keys, "_br", "_bc"]
    rimmed = cells.withColumn("_br", blocks("row")).withColumn("_bc", blocks("col")).repartition(*place)
    stacked = rimmed.withColumn("_step", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    stacked = stacked.withColumn("row", F.col("row") + F.col("_step"))

    def slot(step: int) -> Column:
        return F.max(F.when(F.col("_step") == step, F.col("_v")))

    # A cell moved down by one is the row above its new place.
    triples = stacked.groupBy(*place, "row", "col").agg(
        F.struct(slot(1).alias("up"), slot(0).alias("mid"), slot(-1).alias("down")).alias("t"),
        F.max((F.col("_step") == 0)).alias("_cell"),
    )
    along = W.partitionBy(*place, "row").orderBy("col")

    def beside(step: int) -> Column:
        shifted = F.lag if step < 0 else F.lead
        return F.when(shifted("col").over(along) == F.col("col") + step, shifted("t").over(along))

    both = triples.withColumns({"_l": beside(-1), "_r": beside(1)})
    own = F.col("_cell") & (F.floor(F.col("row") / size) == F.col("_br")) & (F.floor(F.col("col") / size) == F.col("_bc"))
    return both.where(own).select(
        *keys, "row", "col",
        F.col("_l.up").alias("nw"), F.col("t.up").alias("n"), F.col("_r.up").alias("ne"),
        F.col("_l.mid").alias("w"), F.col("t.mid").alias("c"), F.col("_r.mid").alias("e"),
        F.col("_l.down").alias("sw"), F.col("t.down").alias("s"), F.col("_r.down").alias("se"),
    )


def slope(dem: DataFrame, sx: float, sy: float, keys: Sequence[str] = ("layer",)) -> DataFrame:
    """Slope in degrees by the Horn gradient; NULL where any of the nine cells is missing."""
    c = {n: F.col(n) for n in (*NEIGHBOURS, "c")}
    dx = ((c["ne"] + 2 * c["e"] + c["se"]) - (c["nw"] + 2 * c["w"] + c["sw"])) / (8.0 * sx)
    dy = ((c["sw"] + 2 * c["s"] + c["se"]) - (c["nw"] + 2 * c["n"] + c["ne"])) / (8.0 * sy)
    degrees = F.degrees(F.atan(F.sqrt(dx * dx + dy * dy)))
    return neighbourhood(dem, keys).select(*keys, "row", "col", F.when(c["c"].isNotNull(), degrees).alias("slope"))


def flow_direction(dem: DataFrame, sx: float, sy: float, keys: Sequence[str] = ("layer",)) -> DataFrame:
    """Steepest strictly descending neighbour (to_row, to_col) of each cell; NULL for pits."""
    options = []
    for rank, (name, (dr, dc)) in enumerate(NEIGHBOURS.items()):
        distance = ((dr * sy) ** 2 + (dc * sx) ** 2) ** 0.5
        options.append(
            F.struct(
                ((F.col("c") - F.col(name)) / F.lit(distance)).alias("drop"), F.lit(-rank).alias("rank"),
                F.lit(dr).alias("dr"), F.lit(dc).alias("dc"),
            )
        )
    best = F.array_max(F.filter(F.array(*options), lambda o: o["drop"] > 0))
    cells = neighbourhood(dem, keys).where(F.col("c").isNotNull()).withColumn("_best", best)
    return cells.select(
        *keys, "row", "col", (F.col("row") + F.col("_best.dr")).alias("to_row"), (F.col("col") + F.col("_best.dc")).alias("to_col")
    )


def _roots(down: np.ndarray) -> np.ndarray:
    """The last cell of each cell's way inside its block."""
    last = np.where(down >= 0, down, np.arange(len(down)))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            return last
        last = further


def _gathered(down: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Each cell's weight with those of all cells above it inside its block, by path doubling."""
    total, down = weight.copy(), down.copy()
    while True:
        moving = np.flatnonzero(down >= 0)
        if not len(moving):
            return total
        gain = np.zeros(len(total), np.int64)
        np.add.at(gain, down[moving], total[moving])
        total += gain
        down[moving] = down[down[moving]]


class _Block:
    """Cells of one block with the way down from each: ``down`` is a cell of the block, or -1."""

    def __init__(self, table: pa.Table, block: int):
        self.row, self.col = (table.column(c).to_numpy() for c in ("row", "col"))
        to_row, to_col = (table.column(c).combine_chunks() for c in ("to_row", "to_col"))
        self.flows = to_row.is_valid().to_numpy(zero_copy_only=False)
        self.to_row, self.to_col = (pc.fill_null(c, 0).to_numpy() for c in (to_row, to_col))
        self.top, self.left = self.row[0] // block * block, self.col[0] // block * block
        self.size = block
        self.place = np.full(block * block, -1)
        self.place[self.local(self.row, self.col)] = np.arange(len(self.row))
        inside = self.flows & (self.to_row // block == self.row // block) & (self.to_col // block == self.col // block)
        self.down = np.full(len(self.row), -1)
        self.down[inside] = self.place[self.local(self.to_row[inside], self.to_col[inside])]
        self.leaves = self.flows & ~inside

    def local(self, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        return (row - self.top) * self.size + (col - self.left)


def flow_accumulation(dem: DataFrame, sx: float, sy: float, keys: Sequence[str] = ("layer",), block: int = BLOCK) -> DataFrame:
    """Number of cells draining through each cell, itself included.

    Streams are first followed inside blocks of cells, each by one task. Of a block only
    its border cells go on: where the way from each leaves the block, and what the block
    itself sends there. On these, a share of 4 / ``block`` of the cells, paths are doubled:
    after round k a border cell knows what comes from up to 2^k blocks upstream, so the
    rounds grow with the logarithm of the number of blocks that the longest stream meets.
    What enters each block is then added along the ways inside it. Descent is strict, so
    streams end.
    """
    size = F.lit(int(block))
    place, at = [*keys, "_br", "_bc"], [*keys, "row", "col"]
    cells = settle(flow_direction(dem, sx, sy, keys).withColumns({"_br": F.floor(F.col("row") / size), "_bc": F.floor(F.col("col") / size)}))
    own = cells.select(*keys).schema.fieldNames()
    border_schema = cells.select(*at, F.col("row").alias("next_row"), F.col("col").alias("next_col"), F.col("row").alias("out_row"), F.col("col").alias("out_col"), F.lit(None).cast("bigint").alias("cells")).schema

    def summed(table: pa.Table) -> pa.Table:
        b = _Block(table, block)
        total, root = _gathered(b.down, np.ones(len(b.row), np.int64)), _roots(b.down)
        edge = np.flatnonzero((b.row == b.top) | (b.row == b.top + block - 1) | (b.col == b.left) | (b.col == b.left + block - 1))
        end = root[edge]
        made = {"next_row": (b.to_row[end], b.leaves[end]), "next_col": (b.to_col[end], b.leaves[end]), "out_row": (b.to_row[edge], b.leaves[edge]), "out_col": (b.to_col[edge], b.leaves[edge])}
        kept = table.select([*own, "row", "col"]).take(pa.array(edge))
        return pa.table([*kept.columns, *(pa.array(v, mask=~ok) for v, ok in made.values()), pa.array(total[edge])], names=[*own, "row", "col", *made, "cells"])

    border = settle(cells.groupBy(*place).applyInArrow(summed, border_schema))
    sent = border.where("out_row IS NOT NULL").groupBy(*keys, F.col("out_row").alias("row"), F.col("out_col").alias("col")).agg(F.sum("cells").alias("entering"))
    met = _with_nulls(keys, at)
    state = settle(border.drop("cells", "out_row", "out_col").alias("b").join(sent.alias("s"), met("b", "s"), "left").select(*[F.col(f"b.{c}") for c in at], "next_row", "next_col", F.coalesce("entering", F.lit(0).cast("bigint")).alias("entering")))
    while True:
        moving = state.where("next_row IS NOT NULL")
        if moving.isEmpty():
            break
        gains = moving.groupBy(*keys, F.col("next_row").alias("row"), F.col("next_col").alias("col")).agg(F.sum("entering").alias("gain"))
        onward = state.select(*keys, F.col("row").alias("next_row"), F.col("col").alias("next_col"), F.col("next_row").alias("_row"), F.col("next_col").alias("_col"))
        to = _with_nulls(keys, [*keys, "next_row", "next_col"])
        # Ended ways are left out of the join on what comes next, so it has no key of nulls.
        jumped = moving.alias("m").join(onward.alias("o"), to("m", "o")).select(*[F.col(f"m.{c}") for c in at], F.col("_row").alias("next_row"), F.col("_col").alias("next_col"), "entering")
        both = jumped.unionByName(state.where("next_row IS NULL"))
        state = settle(both.alias("b").join(gains.alias("g"), met("b", "g"), "left").select(*[F.col(f"b.{c}") for c in at], "next_row", "next_col", (F.col("entering") + F.coalesce("gain", F.lit(0).cast("bigint"))).alias("entering")))
    entering = state.where("entering > 0").select(*at, "entering", F.floor(F.col("row") / size).alias("_br"), F.floor(F.col("col") / size).alias("_bc"))
    schema = cells.select(*at, F.lit(None).cast("bigint").alias("cells")).schema

    def finished(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({f: pa.array([], left.schema.field(f).type) for f in [*own, "row", "col"]} | {"cells": pa.array([], pa.int64())})
        b = _Block(left, block)
        weight = np.ones(len(b.row), np.int64)
        weight[b.place[b.local(*(right.column(c).to_numpy() for c in ("row", "col")))]] += right.column("entering").to_numpy()
        kept = left.select([*own, "row", "col"])
        return pa.table([*kept.columns, pa.array(_gathered(b.down, weight))], names=[*own, "row", "col", "cells"])

    return cells.groupBy(*place).cogroup(entering.groupBy(*place)).applyInArrow(finished, schema)


def _with_nulls(keys: Sequence[str], names: Sequence[str]):
    """The join condition of two aliases on ``names``, keys being equal also as nulls."""

    def on(a: str, b: str) -> Column:
        test = F.lit(True)
        for c in names:
            left, right = F.col(f"{a}.{c}"), F.col(f"{b}.{c}")
            test = test & (left.eqNullSafe(right) if c in keys else left == right)
        return test

    return on


def weighted_overlay(wide: DataFrame, weights: Mapping[str, float], out: str = "score") -> DataFrame:
    """Weighted mean of min-max normalised layer columns; NULL where a layer is missing."""
    names = list(weights)
    ends = wide.agg(
        F.struct(*[F.min(n).alias(f"{n}_lo") for n in names], *[F.max(n).alias(f"{n}_hi") for n in names]).alias("e")
    ).scalar()
    total = F.lit(0.0)
    for n in names:
        span = ends[f"{n}_hi"] - ends[f"{n}_lo"]
        total = total + F.lit(float(weights[n])) * ratio(F.col(n) - ends[f"{n}_lo"], span)
    return wide.withColumn(out, total / F.lit(float(sum(weights.values()))))


def classify(pixels: DataFrame, thresholds: Sequence[float], col: str = "value", out: str = "zone") -> DataFrame:
    """Number of thresholds reached: 0 below the first."""
    zone = F.lit(0)
    for t in thresholds:
        zone = zone + (F.col(col) >= F.lit(float(t))).cast("int")
    return pixels.withColumn(out, zone)


def canopy_cover(ndvi: DataFrame, classes: DataFrame, canopy_classes: Sequence[int], threshold: float, keys: Sequence[str] = ("layer", "row", "col")) -> DataFrame:
    """1 where vegetation reaches the threshold and the class is a canopy class, else 0."""
    both = ndvi.select(*keys, "value").join(classes.select(*keys, F.col("value").alias("class")), list(keys))
    covered = (F.col("value") >= F.lit(float(threshold))) & F.col("class").isin(list(canopy_classes))
    return both.select(*keys, covered.cast("int").alias("canopy"))
