"""Rounding, ratios, clamps, casts and missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
METRES_PER_DEGREE = 111320.0


def round_even(c: Column, n: int = 0) -> Column:
    """Round to ``n`` decimals, ties to even."""
    scale = float(10**n)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def ratio(a: Column, b: Column) -> Column:
    """``a / b``; NULL where ``b`` is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def complement(p: Column, n: int = 4) -> Column:
    """``1 - p``, rounded after the subtraction."""
    return round_even(F.lit(1.0) - p, n)


def density(population: Column, area_km2: Column) -> Column:
    """Inhabitants per square kilometre, one decimal."""
    return round_even(ratio(population, area_km2), 1)


def affine(c: Column, k: float, b: float = 0.0) -> Column:
    """``c * k + b``."""
    scaled = c * F.lit(float(k))
    return scaled if b == 0.0 else scaled + F.lit(float(b))


def clamp(c: Column, lo: float, hi: float) -> Column:
    """Limit to ``[lo, hi]``; NULL stays NULL."""
    limited = F.least(F.greatest(c, F.lit(lo)), F.lit(hi))
    return F.when(c.isNotNull(), limited)


def rint(c: Column) -> Column:
    """Nearest integer, ties to even."""
    return F.rint(c)


def to_number(c: Column) -> Column:
    """Text to DOUBLE; anything that is not a number becomes NULL."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def is_valid(c: Column) -> Column:
    """Neither NULL nor NaN."""
    return c.isNotNull() & ~F.isnan(c)


def mask_nodata(c: Column, nodata: float | None = None) -> Column:
    """NaN and the nodata value become NULL."""
    keep = ~F.isnan(c)
    if nodata is not None:
        keep = keep & (c != F.lit(float(nodata)))
    return F.when(keep, c)


def set_nodata(c: Column, nodata: float) -> Column:
    """NULL and NaN become the nodata value."""
    return F.when(is_valid(c), c).otherwise(F.lit(float(nodata)))


def cast_cell(c: Column, dtype: str) -> Column:
    """Raster cell types; integer types round half away from zero and saturate."""
    if dtype == "float32":
        return c.cast("float")
    limits = {"int16": (-32768.0, 32767.0), "byte": (0.0, 255.0)}
    if dtype not in limits:
        raise ValueError(f"unknown cell type {dtype!r}")
    return clamp(F.round(c.cast("double")), *limits[dtype]).cast("smallint")


def row_sum(columns: Sequence[Column]) -> Column:
    """Sum across columns, NULL counting as zero."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(c.cast("double"), F.lit(0.0))
    return total


def deg_to_m(d: Column) -> Column:
    """Degrees to metres at the equator."""
    return d * F.lit(METRES_PER_DEGREE)


def resolution_m(text: Column) -> Column:
    """``30m`` -> 30.0; text without a metre figure gives NULL."""
    return F.nullif(F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*m\s*$", 1), F.lit("")).cast("double")


def year_range(year: Column) -> Column:
    """The half-open date range of a year."""
    y = year.cast("int")
    return F.struct(
        F.make_date(y, F.lit(1), F.lit(1)).alias("start"),
        F.make_date(y + 1, F.lit(1), F.lit(1)).alias("end"),
    )
