"""Nested responses and census indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import numeric as N
from cellweave.operators import joins as J
from cellweave.operators import nested as NE
from cellweave.plans import census as C
from cellweave.queries import tables as T
from cellweave.queries.catalog import VIEWS, even, query
from cellweave.queries.cells import utm_sql
from cellweave.sources.readers import CENSUS


def landed(spark, d, class_id="386"):
    """Responses through their JSON text, as a reader would see them."""
    text = T.census_responses(spark, d, class_id).select(F.to_json(F.struct("*")).alias("t"))
    return text.select(F.from_json("t", CENSUS).alias("r")).select("r.*")


@query("nj01_expand_results", "SELECT neighbourhood_number AS number, count(*) AS n_results FROM census_long GROUP BY 1")
def _(spark, d):
    results = NE.expand_array(landed(spark, d), "resultados")
    place = F.col("series")[0]["localidade"]["id"].alias("number")
    return results.groupBy(place).agg(F.count("*").alias("n_results"))


@query("nj02_expand_series", "SELECT neighbourhood_number AS number, neighbourhood_name AS name, text FROM census_long")
def _(spark, d):
    flat = NE.expand_results(landed(spark, d))
    return flat.select(F.col("localidade_id").alias("number"), F.col("localidade_nome").alias("name"), F.col("serie")["2010"].alias("text"))


@query("nj03_flatten_struct", """SELECT event_id, (props::JSON ->> 'k')::BIGINT AS outer_k, 'e' || user_id AS outer_inner_user, value AS outer_inner_value FROM events""")
def _(spark, d):
    e = T.read(spark, d, "events")
    inner = F.struct(F.concat(F.lit("e"), "user_id").alias("user"), F.col("value"))
    nested = F.struct(F.from_json("props", "k BIGINT")["k"].alias("k"), inner.alias("inner"))
    return NE.flatten_struct(e.select("event_id", nested.alias("outer")))


@query("nj04_extract_classification", "SELECT neighbourhood_number AS number, class_id, 'label ' || class_id AS label, NULL AS other FROM census_long")
def _(spark, d):
    flat = NE.expand_results(landed(spark, d))
    own = NE.extract_classification(F.col("classificacoes"), 386)
    return flat.select(
        F.col("localidade_id").alias("number"), own["id"].alias("class_id"), own["label"].alias("label"),
        NE.extract_classification(F.col("classificacoes"), 999)["id"].alias("other"),
    )


@query("u02_same_row_concat", "SELECT 'households' AS variavel, neighbourhood_number AS localidade_id, text FROM census_long")
def _(spark, d):
    return NE.expand_results(landed(spark, d)).select("variavel", "localidade_id", F.col("serie")["2010"].alias("text"))


@query("pf18_latest_period", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events")
def _(spark, d):
    e = T.read(spark, d, "events")
    old = F.create_map(F.lit("2000"), F.lit(-1.0), F.lit("1991"), F.lit(-2.0))
    new = F.map_concat(old, F.create_map(F.lit("2010"), F.col("value")))
    rows = e.select("event_id", F.when(F.col("event_id") % 3 == 0, new).otherwise(old).alias("serie"))
    return NE.latest_period(rows, "serie", "v").select("event_id", "v")


@query(
    "nj14_explode_categories",
    "SELECT DISTINCT '386' || (loc % 3) AS class_id, 'class ' || (loc % 3) AS class_name, p::VARCHAR AS category_id, 'cat ' || p AS category_name FROM census_counts",
)
def _(spark, d):
    counts = T.census_counts(spark, d)
    category = F.struct(F.col("p").cast("string").alias("id"), F.concat(F.lit("cat "), "p").alias("nome"))
    docs = counts.groupBy("loc").agg(F.collect_set(category).alias("categorias")).select(
        F.array(F.struct(F.concat(F.lit("386"), F.col("loc") % 3).alias("id"), F.concat(F.lit("class "), F.col("loc") % 3).alias("nome"), "categorias")).alias("classificacoes")
    )
    return NE.explode_categories(docs).distinct()


@query("j02_share_of_total", f"""SELECT neighbourhood_number, sum(CASE WHEN class_id = '9680' THEN value END) AS total,
      coalesce(sum(CASE WHEN class_id IN ('9681', '9682', '9692') THEN value END), 0) AS part,
      {even("coalesce(sum(CASE WHEN class_id IN ('9681', '9682', '9692') THEN value END), 0) / nullif(sum(CASE WHEN class_id = '9680' THEN value END), 0)", 4)} AS share
    FROM census_long GROUP BY 1""")
def _(spark, d):
    flat = C.themed(landed(spark, d), C.INCOME_CLASS)
    return J.share_of_total(flat, C.KEY, "class_id", "value", [C.INCOME_TOTAL], C.POOR_INCOME)


INCOME = f"""
  SELECT neighbourhood_number, household_total, poor AS poor_households, {even('poor / nullif(household_total, 0)', 4)} AS poverty_rate,
    q1 AS hh_inc_q1, q2 AS hh_inc_q2, q3 AS hh_inc_q3, q4 AS hh_inc_q4, CASE WHEN nb > 0 THEN 0.0::DOUBLE END AS hh_inc_q5, none AS hh_inc_none,
    CASE WHEN nb > 0 THEN {even('(coalesce(q1, 0) + coalesce(q2, 0) + coalesce(q3, 0) + coalesce(none, 0)) / nullif(household_total, 0)', 4)} END AS pct_low_income,
    CASE WHEN nb > 0 THEN {even('0.0::DOUBLE / nullif(household_total, 0)', 4)} END AS pct_high_income
  FROM (SELECT neighbourhood_number, sum(CASE WHEN class_id = '9680' THEN value END) AS household_total,
    coalesce(sum(CASE WHEN class_id IN ('9681', '9682', '9692') THEN value END), 0) AS poor,
    {', '.join(f"CASE WHEN count(*) FILTER (class_id = '{c}') > 0 THEN coalesce(sum(value) FILTER (class_id = '{c}'), 0) END AS {n}" for c, n in (('9681', 'q1'), ('9682', 'q2'), ('9683', 'q3'), ('9684', 'q4'), ('9692', 'none')))},
    count(*) FILTER (class_id NOT IN ('9680', '0')) AS nb FROM census_long GROUP BY 1)"""


@query("j01_join_indicators", f"""WITH inc AS ({INCOME}) SELECT n.nb AS neighbourhood_number, n.pop, i.poverty_rate, i.hh_inc_q3, l.lines
    FROM (SELECT (c_custkey // 10)::VARCHAR AS nb, count(*) AS pop FROM customer GROUP BY 1) n LEFT JOIN inc i ON i.neighbourhood_number = n.nb
    LEFT JOIN (SELECT CASE WHEN o_custkey // 10 % 4 <> 0 THEN (o_custkey // 10)::VARCHAR END AS nb, count(*) AS lines FROM orders GROUP BY 1) l ON l.nb = n.nb""")
def _(spark, d):
    base = T.read(spark, d, "customer").groupBy(F.expr("cast(c_custkey div 10 as string)").alias(C.KEY)).agg(F.count("*").alias("pop"))
    inc = C.income(C.themed(landed(spark, d), C.INCOME_CLASS)).select(C.KEY, "poverty_rate", "hh_inc_q3")
    known = F.expr("CASE WHEN o_custkey div 10 % 4 <> 0 THEN cast(o_custkey div 10 as string) END").alias(C.KEY)
    lines = T.read(spark, d, "orders").groupBy(known).agg(F.count("*").alias("lines"))
    return J.join_indicators(base, [inc, lines], C.KEY)


# Water and sewage answers, and lon/lat polygons, derived per neighbourhood.
VIEWS["places"] = """SELECT (c_custkey // 10)::VARCHAR AS nb, c_custkey // 10 AS loc, count(*) AS n FROM customer GROUP BY ALL"""
VIEWS["place_vertices"] = """
  SELECT nb, ring, i, -51.40::DOUBLE + 0.01::DOUBLE * (loc % 50) + dx / 1000 AS lon, -30.0::DOUBLE - 0.01::DOUBLE * ((loc // 50) % 40) + dy / 1000 AS lat
  FROM places, (VALUES (0, 0, -7.0::DOUBLE, 0.0::DOUBLE), (0, 1, 0.0, -7.0), (0, 2, 7.0, 0.0), (0, 3, 0.0, 7.0), (0, 4, -7.0, 0.0),
    (1, 0, -2.0, 0.0), (1, 1, 0.0, -3.0), (1, 2, 2.0, 0.0), (1, 3, 0.0, 3.0), (1, 4, -2.0, 0.0)) o(ring, i, dx, dy) WHERE ring = 0 OR loc % 5 = 0"""


def places(spark, d):
    customers = T.read(spark, d, "customer")
    return customers.groupBy(F.expr("c_custkey div 10").alias("loc")).agg(F.count("*").alias("n"))


def place_polygons(spark, d):
    lon = F.lit(-51.40) + F.lit(0.01) * (F.col("loc") % 50)
    lat = F.lit(-30.0) - F.lit(0.01) * F.expr("(loc div 50) % 40")

    def ring(offsets):
        return F.array(*[F.struct((lon + x / 1000).alias("x"), (lat + y / 1000).alias("y")) for x, y in offsets])

    rings = F.when(F.col("loc") % 5 == 0, F.array(ring(T.DIAMOND), ring(T.HOLE))).otherwise(F.array(ring(T.DIAMOND)))
    return places(spark, d).select(F.col("loc").cast("string").alias("id"), F.array(rings).alias("parts"))


def yes_no(spark, d, total, part, part_expr, missing):
    """Two flat rows per place: the total and a part."""
    p = places(spark, d)
    value = F.when(F.expr(missing), None).otherwise(F.col("n").cast("double"))
    rows = p.select(F.col("loc").cast("string").alias(C.KEY), F.lit(total).alias("class_id"), value.alias("value"))
    # Some places have only another class than the part.
    code = F.when(F.col("loc") % 8 != 3, part).otherwise("other").alias("class_id")
    parts = p.select(F.col("loc").cast("string").alias(C.KEY), code, F.expr(part_expr).cast("double").alias("value"))
    return rows.unionByName(parts)


AREA_SQL = f"""u AS ({utm_sql('place_vertices', 'lon', 'lat')}),
  rings AS (SELECT a.nb, a.ring, abs(sum(b.e * a.n - a.e * b.n)) / 2 AS area FROM u a JOIN u b ON a.nb = b.nb AND a.ring = b.ring AND a.i = b.i + 1 GROUP BY ALL),
  areas AS (SELECT nb, {even('sum(CASE WHEN ring = 0 THEN area ELSE -area END) / 1e6', 4)} AS area_km2 FROM rings GROUP BY nb)"""


@query(
    "p20_census_indicators",
    f"""WITH {AREA_SQL}, inc AS ({INCOME}),
    wat AS (SELECT nb, CASE WHEN loc % 8 <> 3 AND loc % 19 <> 0 THEN {even('(n // 2)::DOUBLE / n', 4)} END AS pct_piped_water FROM places),
    sew AS (SELECT nb, CASE WHEN loc % 23 <> 0 THEN {even('CASE WHEN loc % 8 <> 3 THEN (n // 3)::DOUBLE ELSE 0 END / n', 4)} END AS s FROM places)
    SELECT p.nb AS neighbourhood_number, i.* EXCLUDE (neighbourhood_number), pop AS population_total, pct_piped_water, s AS pct_formal_sewage, {even('1.0::DOUBLE - s', 4)} AS pct_no_formal_sewage,
      area_km2, {even('pop / nullif(area_km2, 0)', 1)} AS pop_density_km2
    FROM places p JOIN areas a USING (nb) LEFT JOIN (SELECT neighbourhood_number AS nb, value AS pop FROM census_long WHERE class_id = '9680' AND value IS NOT NULL) t USING (nb)
    LEFT JOIN inc i ON i.neighbourhood_number = t.nb LEFT JOIN wat ON wat.nb = t.nb LEFT JOIN sew ON sew.nb = t.nb""",
)
def _(spark, d):
    inc = C.themed(landed(spark, d), C.INCOME_CLASS)
    pop = C.themed(landed(spark, d), C.INCOME_CLASS).where(F.col("class_id") == C.INCOME_TOTAL)
    wat = yes_no(spark, d, C.WATER_TOTAL, C.WATER_PIPED, "n div 2", "loc % 19 = 0")
    sew = yes_no(spark, d, C.SEWAGE_TOTAL, C.SEWAGE_FORMAL[0], "n div 3", "loc % 23 = 0")
    table = C.indicators(pop, inc, wat, sew)
    return C.census_features(place_polygons(spark, d), table).drop("parts")


@query("s15_utm_area", f"WITH {AREA_SQL} SELECT nb AS id, area_km2 FROM areas")
def _(spark, d):
    return place_polygons(spark, d).select("id", C.area_km2(F.col("parts")).alias("area_km2"))


@query("s02_share_complement", f"SELECT nb, {even('1.0::DOUBLE - ' + even('(n // 3)::DOUBLE / n', 4), 4)} AS rest FROM places")
def _(spark, d):
    share = N.round_even(N.ratio(F.expr("n div 3"), F.col("n")), 4)
    return places(spark, d).select(F.col("loc").cast("string").alias("nb"), N.complement(share, 4).alias("rest"))
