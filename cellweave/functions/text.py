"""Text defaults, templates and code lists."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_or(c: Column, default: str | None = "") -> Column:
    """To text; NULL becomes the default."""
    text = c.cast("string")
    return text if default is None else F.coalesce(text, F.lit(default))


def fill_template(template: Column | str, **values: Column) -> Column:
    """Replace each ``{name}``; a NULL value leaves an empty place."""
    filled = F.lit(template) if isinstance(template, str) else template
    for name, value in values.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), text_or(value))
    return filled


def map_codes(c: Column, mapping: Mapping[str, str]) -> Column:
    """Code to label; unknown codes give NULL."""
    pairs = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return F.try_element_at(pairs, c)

