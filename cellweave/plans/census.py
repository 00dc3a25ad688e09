"""Census indicators by neighbourhood."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.geometry import map_vertices, polygon_area
from cellweave.functions.numeric import complement, density, ratio, round_even, row_sum, to_number
from cellweave.functions.projection import to_utm22s
from cellweave.operators.joins import attach, join_indicators, share_of_total
from cellweave.operators.nested import expand_results, extract_classification, latest_period

KEY = "neighbourhood_number"
# Classifications and category codes of the census tables.
INCOME_CLASS, WATER_CLASS, SEWAGE_CLASS = "386", "61", "11558"
INCOME_TOTAL = "9680"
POOR_INCOME = ("9681", "9682", "9692")
INCOME_BRACKETS = {
    "9681": "hh_inc_q1", "9682": "hh_inc_q2", "9683": "hh_inc_q3", "9684": "hh_inc_q4",
    "9685": "hh_inc_q5a", "9686": "hh_inc_q5b", "11780": "hh_inc_q5c", "9692": "hh_inc_none",
}
WATER_TOTAL, WATER_PIPED = "0", "92853"
SEWAGE_TOTAL, SEWAGE_FORMAL = "0", ("92855",)


def themed(responses: DataFrame, class_id: str | None = None) -> DataFrame:
    """Flat rows (neighbourhood, name, class id, value) of landed responses at the latest period."""
    flat = latest_period(expand_results(responses), "serie", "_text")
    code = extract_classification(F.col("classificacoes"), class_id)["id"] if class_id else F.lit(None).cast("string")
    return flat.select(
        F.col("localidade_id").alias(KEY),
        F.col("localidade_nome").alias("neighbourhood_name"),
        code.alias("class_id"),
        to_number(F.col("_text")).alias("value"),
    )


def population(flat: DataFrame) -> DataFrame:
    """Rows with a known population."""
    return flat.select(KEY, F.col("value").alias("population_total")).where(F.col("population_total").isNotNull())


def _sum_of(codes: Sequence[str]) -> Column:
    """Sum over the codes; zero for present rows of missing values, NULL when no row has them."""
    listed = F.col("class_id").isin(list(codes))
    return F.when(
        F.max(listed.cast("int")) == 1, F.coalesce(F.sum(F.when(listed, F.col("value"))), F.lit(0.0))
    )


def income(flat: DataFrame) -> DataFrame:
    """Poverty and bracket indicators in one aggregation of the income table."""
    is_total = F.col("class_id") == INCOME_TOTAL
    sums = flat.groupBy(KEY).agg(
        F.sum(F.when(is_total, F.col("value"))).alias("household_total"),
        F.max(is_total.cast("int")).alias("_has_total"),
        F.max(F.col("class_id").isin(list(INCOME_BRACKETS)).cast("int")).alias("_has_bracket"),
        F.coalesce(_sum_of(POOR_INCOME), F.lit(0.0)).alias("poor_households"),
        *[_sum_of([code]).alias(name) for code, name in INCOME_BRACKETS.items()],
    )
    top = row_sum([F.col(n) for n in ("hh_inc_q5a", "hh_inc_q5b", "hh_inc_q5c")])
    low = row_sum([F.col(n) for n in ("hh_inc_q1", "hh_inc_q2", "hh_inc_q3", "hh_inc_none")])
    total = F.col("household_total")
    has_total, has_bracket = F.col("_has_total") == 1, F.col("_has_bracket") == 1
    return sums.select(
        KEY,
        "household_total",
        F.when(has_total, F.col("poor_households")).alias("poor_households"),
        round_even(ratio(F.col("poor_households"), total), 4).alias("poverty_rate"),
        "hh_inc_q1", "hh_inc_q2", "hh_inc_q3", "hh_inc_q4",
        F.when(has_bracket, top).alias("hh_inc_q5"),
        "hh_inc_none",
        F.when(has_bracket, round_even(ratio(low, total), 4)).alias("pct_low_income"),
        F.when(has_bracket, round_even(ratio(top, total), 4)).alias("pct_high_income"),
    )


def water(flat: DataFrame) -> DataFrame:
    """Share of households on piped water."""
    codes = flat.groupBy(KEY).agg(
        *[F.max(F.when(F.col("class_id") == c, F.col("value"))).alias(n) for c, n in ((WATER_TOTAL, "_all"), (WATER_PIPED, "_piped"))]
    )
    return codes.select(KEY, round_even(ratio(F.col("_piped"), F.col("_all")), 4).alias("pct_piped_water"))


def sewage(flat: DataFrame) -> DataFrame:
    """Share of households with formal sewage, and its complement taken after rounding."""
    shares = share_of_total(flat, KEY, "class_id", "value", [SEWAGE_TOTAL], SEWAGE_FORMAL)
    return shares.select(
        KEY,
        F.col("share").alias("pct_formal_sewage"),
        complement(F.col("share"), 4).alias("pct_no_formal_sewage"),
    )


def indicators(pop: DataFrame, inc: DataFrame, wat: DataFrame, sew: DataFrame) -> DataFrame:
    """Star join from the flat theme tables; a neighbourhood without population has no row."""
    return join_indicators(population(pop), [income(inc), water(wat), sewage(sew)], KEY)


def area_km2(parts: Column) -> Column:
    """Polygon area on the UTM plane, holes subtracted, four decimals."""
    return round_even(polygon_area(map_vertices(parts, to_utm22s)) / 1e6, 4)


def census_features(polygons: DataFrame, table: DataFrame) -> DataFrame:
    """Indicators on the neighbourhood polygons (lon/lat), with area and density."""
    keyed = polygons.withColumnRenamed("id", KEY).withColumn("area_km2", area_km2(F.col("parts")))
    joined = attach(keyed, table, KEY)
    return joined.withColumn("pop_density_km2", density(F.col("population_total"), F.col("area_km2")))
