"""Value and colour encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellweave.functions.numeric import clamp

# The channel ranges of the published tiles.
MAX_24_BIT = 16777215
MAX_BYTE = 255


def _channels(n: Column, shifts: tuple[int, int, int]) -> Column:
    """STRUCT<r, g, b> of the three bytes; NULL counts as the nodata value 0."""
    whole = F.coalesce(n.cast("bigint"), F.lit(0).cast("bigint"))
    parts = [
        F.shiftright(whole, shift).bitwiseAND(F.lit(255).cast("bigint")).cast("int").alias(name)
        for name, shift in zip("rgb", shifts)
    ]
    return F.struct(*parts)


def encode_packed(c: Column, cap: float = MAX_24_BIT, offset: float = 0.0) -> Column:
    """Least significant byte in R. The offset is added before the clamp."""
    shifted = c if offset == 0 else c + F.lit(float(offset))
    return _channels(F.rint(clamp(shifted, 0.0, float(cap))), (0, 8, 16))


def encode_terrain(c: Column, scale: float, offset: float = 0.0) -> Column:
    """Most significant byte in R of ``rint((value - offset) / scale)``."""
    steps = F.rint((c - F.lit(float(offset))) / F.lit(float(scale)))
    return _channels(clamp(steps, 0.0, float(MAX_24_BIT)), (16, 8, 0))


def encode_class(c: Column) -> Column:
    """R holds the class; codes outside a byte saturate."""
    return _channels(F.rint(clamp(c, 0.0, float(MAX_BYTE))), (0, 8, 16))


def decode_rgb(r: Column, g: Column, b: Column, kind: Column | str, scale: Column, offset: Column) -> Column:
    """Back to the value for the three encodings, chosen per row."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    big = r.cast("double") * 65536 + g * 256 + b
    little = r.cast("double") + g * 256 + b.cast("double") * 65536
    return (
        F.when(kind == "terrain_rgb", big * scale + offset)
        .when(kind == "rgb_packed", little * scale + offset)
        .when(kind == "class_lookup", r.cast("double"))
    )


def rgb_to_hex(r: Column, g: Column, b: Column) -> Column:
    """``#RRGGBB``."""
    return F.format_string("#%02X%02X%02X", r.cast("int"), g.cast("int"), b.cast("int"))


def hex_to_rgb(h: Column) -> Column:
    """STRUCT<r, g, b> of ``#RRGGBB`` text, any case."""
    digits = F.regexp_replace(h, "^#", "")
    return F.struct(
        *[
            F.conv(F.substring(digits, start, 2), 16, 10).cast("int").alias(name)
            for name, start in zip("rgb", (1, 3, 5))
        ]
    )


def hex_color(c: Column) -> Column:
    """Prefix ``#``; a missing colour stays NULL."""
    text = c.cast("string")
    return F.when(text.isNotNull() & (text != "nan"), F.concat(F.lit("#"), text))


def color_linear(value: Column, lo: Column, hi: Column) -> Column:
    """Interpolate each channel between two LUT entries STRUCT<v, r, g, b>.

    A missing ``lo`` (value below the table) takes ``hi`` and the reverse.
    """
    t = F.coalesce(F.try_divide(value - lo["v"], hi["v"] - lo["v"]), F.lit(0.0))

    def channel(name: str) -> Column:
        mixed = F.rint(lo[name] + (hi[name] - lo[name]) * t)
        return F.coalesce(mixed, lo[name].cast("double"), hi[name].cast("double")).cast("int")

    return F.struct(*[channel(n).alias(n) for n in "rgb"])
