"""Joins whose broadcast is decided by a measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
MEASURE_BYTES = 4 * 1024 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; costs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES, settled: bool = False
) -> bool:
    """Whether the rows and their serialised bytes stay within the bounds.

    Measured in one map-side aggregated pass, which is spared when the estimate is
    far beyond the bounds. A ``settled`` side is small to read whatever the estimate
    of the plan it came from.
    """
    if not settled and estimated_bytes(df) > MEASURE_BYTES:
        return False
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    n, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(row))).first()
    return n <= max_rows and (size or 0) <= max_bytes


def small_side(df: DataFrame, settled: bool = False) -> DataFrame:
    """``df`` marked for broadcast when its measured size allows it.

    A larger side is returned unmarked: the join is then shuffled, and AQE splits
    the partitions of hot keys.
    """
    return F.broadcast(df) if fits_broadcast(df, settled=settled) else df


def join_small(
    left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column, how: str = "inner", settled: bool = False
) -> DataFrame:
    """Join with a side that is expected, and checked, to be small."""
    return left.join(small_side(right, settled), on, how)
