"""Row filters, column subsets and collection filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.sizing import join_small


def select_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """By name with a mapping, by position with a sequence."""
    if isinstance(mapping, Mapping):
        return df.withColumnsRenamed(dict(mapping))
    return df.toDF(*mapping)


def select_band(obs: DataFrame, band: str) -> DataFrame:
    """Rows of one band; a partition filter on the collection layout."""
    return obs.where(F.col("band") == band)


def filter_date(obs: DataFrame, start: str, end: str, ts: str = "ts") -> DataFrame:
    """``[start, end)`` on a timestamp or date column."""
    return obs.where((F.col(ts) >= F.to_timestamp(F.lit(start))) & (F.col(ts) < F.to_timestamp(F.lit(end))))


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def meets_box(box: Sequence[float], w: str = "west", s: str = "south", e: str = "east", n: str = "north") -> Column:
    """Whether a footprint meets the box [west, south, east, north]."""
    west, south, east, north = map(float, box)
    return (F.col(w) <= east) & (F.col(e) >= west) & (F.col(s) <= north) & (F.col(n) >= south)


def filter_bounds(obs: DataFrame, image_meta: DataFrame, box: Sequence[float], key: str = "image_id") -> DataFrame:
    """Observations of the images whose footprint meets the box."""
    return join_small(obs, image_meta.where(meets_box(box)).select(key).distinct(), key, "left_semi")


def drop_null(df: DataFrame, cols: Sequence[str], how: str = "any") -> DataFrame:
    return df.na.drop(how=how, subset=list(cols))


def where_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """IN-list with literals, so it reaches the scan."""
    return df.where(F.col(col).isin(list(values)))


def fill_null(df: DataFrame, values: Mapping[str, float | str]) -> DataFrame:
    return df.na.fill(dict(values))


def good_batches(responses: DataFrame, status: str = "status") -> DataFrame:
    """Responses that came back whole."""
    return responses.where(F.col(status) == 200)


def batch_report(responses: DataFrame, status: str = "status") -> DataFrame:
    """One row: good and failed batches."""
    return responses.agg(
        F.count_if(F.col(status) == 200).alias("n_good"),
        F.count_if((F.col(status) != 200) | F.col(status).isNull()).alias("n_failed"),
    )
