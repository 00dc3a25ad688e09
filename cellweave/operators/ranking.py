"""Ranks, running totals and first-per-key without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.session import settle


def running_total(
    df: DataFrame,
    order_by: Sequence[str],
    amount: Column | None = None,
    keys: Sequence[str] = (),
    out: str = "total",
    slices: int | None = None,
) -> DataFrame:
    """Inclusive running total of ``amount`` (1 by default) per key in order.

    Rows are range-partitioned on (keys, order), so one hot key, or no key at all,
    spreads over many tasks; each slice is summed on its own and shifted by the
    totals of the slices before it. The slices are written to the shared folder
    before their totals are taken, so both readings see the same cut.
    """
    spark = df.sparkSession
    n = slices or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sort = [*keys, *order_by]
    cut = settle(
        df.withColumn("_amount", (F.lit(1) if amount is None else amount).cast("bigint"))
        .repartitionByRange(n, *sort)
        .withColumn("_slice", F.spark_partition_id())
    )
    inside = W.partitionBy("_slice", *keys).orderBy(*order_by).rowsBetween(W.unboundedPreceding, 0)
    totals = cut.groupBy("_slice", *keys).agg(F.sum("_amount").alias("_slice_total"))
    if keys:
        # A key present in one slice only needs no shift; the others are few per slice edge.
        spread = totals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        totals = totals.join(spread, list(keys), "left_semi")
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    shift = totals.select(
        "_slice", *keys, F.coalesce(F.sum("_slice_total").over(before), F.lit(0)).alias("_shift")
    )
    # At most two keys reach beyond any slice, so the shifts number no more than 2 n rows.
    return (
        cut.withColumn("_inside", F.sum("_amount").over(inside))
        .join(F.broadcast(shift), ["_slice", *keys], "left")
        .withColumn(out, F.col("_inside") + F.coalesce("_shift", F.lit(0)))
        .select(*df.columns, out)
    )


def dedupe_first(df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """First row per key in the given order; one pass that is aggregated before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    packed = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    first = df.groupBy(*keys).agg(F.min_by(packed, F.struct(*order)).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def batch_ids(df: DataFrame, id_col: str, n: int = 50) -> DataFrame:
    """Distinct ids in order, cut into comma-joined batches of ``n``."""
    ids = df.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    ranked = running_total(ids, ["_id"], out="_rank")
    return (
        ranked.groupBy(F.expr(f"(_rank - 1) div {int(n)}").alias("batch_no"))
        .agg(F.array_sort(F.collect_list("_id")).alias("_ids"))
        .select("batch_no", F.array_join(F.col("_ids").cast("array<string>"), ",").alias("ids"))
    )


def version_number(version: Column) -> Column:
    """Digits of ``v12`` as a number."""
    return F.nullif(F.regexp_extract(version, r"([0-9]+)", 1), F.lit("")).try_cast("bigint")


def latest_release(releases: DataFrame) -> DataFrame:
    """Highest version, then latest period, per dataset_id."""
    order = F.struct(F.coalesce(version_number(F.col("version")), F.lit(-1)), F.coalesce("period", F.lit("")))
    rest = [c for c in releases.columns if c != "dataset_id"]
    picked = releases.groupBy("dataset_id").agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select("dataset_id", *[F.col(f"_row.{c}").alias(c) for c in rest])


def order_in_group(df: DataFrame, key: str, by: str, cols: Sequence[str]) -> DataFrame:
    """Position of each row within its key, ascending by ``by``."""
    return running_total(df.select(key, by, *cols), [by], keys=[key], out="position")


def latest(df: DataFrame, col: str) -> DataFrame:
    """One row: the greatest value of a column."""
    return df.agg(F.max(col).alias(col))


def preview(df: DataFrame, by: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows in order (a top-n, not a full sort)."""
    return df.orderBy(by).limit(n)
