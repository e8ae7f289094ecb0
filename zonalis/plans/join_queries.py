"""Staging, marts, equi-, range- and nearest joins."""

from pyspark.sql import functions as F

from zonalis.operators import joins as J
from zonalis.operators import sets as S
from zonalis.operators import spatial as P
from zonalis.plans import marts
from zonalis.plans.frames import AREAS, HOUSING, LABOUR, areas, housing, labour, r, with_sql
from zonalis.plans.registry import query

# Boxes lie along a strip, so that each meets a handful of others at any scale.
# Areas are customers; deaths are their orders, services their orders' lines;
# stations are suppliers with their lines' observations.
RAW_CTES = (AREAS, LABOUR, """
raw_abs_census AS (SELECT sa2_code, people AS total_population, unemployed * 100.0 / people AS unemployment_rate, balance AS median_age,
  balance * 10 AS median_household_income FROM areas JOIN labour USING (area_id)),
raw_abs_seifa AS (SELECT sa2_code, score AS seifa_irsad_score, (floor(score / 1000) + 1)::DOUBLE AS seifa_irsd_decile FROM areas WHERE score IS NOT NULL),
raw_abs_geographic AS (SELECT sa2_code AS geographic_id, sa2_name AS geographic_name, lat, lon, (area_id % 50 + 1)::DOUBLE AS area_square_km, segment AS remoteness_category FROM areas),
raw_aihw_mortality AS (SELECT sa2_code AS geographic_id, o_totalprice / 1000 AS value, o_orderpriority AS cause_of_death, o_orderkey FROM orders JOIN areas ON o_custkey = area_id),
raw_medicare_utilisation AS (SELECT sa2_code AS geographic_id, l_quantity AS utilisation_rate, l_discount * 100 AS bulk_billed_percentage
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN areas ON o_custkey = area_id),
raw_bom_climate AS (SELECT printf('%09d', s_suppkey) AS station_id, s_name AS station_name, round(113.0 + ((s_suppkey * 613) % 400) * 0.1, 6) AS longitude,
  round(-43.0 + ((s_suppkey * 389) % 330) * 0.1, 6) AS latitude, l_quantity AS temperature_max_celsius, l_extendedprice / 1000 AS rainfall_mm
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)""")


def raw_tables(t):
    a = areas(t)
    people = a.join(labour(t), "area_id")
    deaths = t.orders.join(a.select("area_id", "sa2_code"), F.col("o_custkey") == F.col("area_id"))
    services = t.lineitem.join(deaths.select("o_orderkey", "sa2_code"), F.col("l_orderkey") == F.col("o_orderkey"))
    obs = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return {
        "raw_abs_census": people.select(
            "sa2_code", F.col("people").alias("total_population"), (F.col("unemployed") * 100.0 / F.col("people")).alias("unemployment_rate"),
            F.col("balance").alias("median_age"), (F.col("balance") * 10).alias("median_household_income")),
        "raw_abs_seifa": a.filter("score IS NOT NULL").select(
            "sa2_code", F.col("score").alias("seifa_irsad_score"), (F.floor(F.col("score") / 1000) + 1).cast("double").alias("seifa_irsd_decile")),
        "raw_abs_geographic": a.select(
            F.col("sa2_code").alias("geographic_id"), F.col("sa2_name").alias("geographic_name"), "lat", "lon",
            (F.col("area_id") % 50 + 1).cast("double").alias("area_square_km"), F.col("segment").alias("remoteness_category")),
        "raw_aihw_mortality": deaths.select(
            F.col("sa2_code").alias("geographic_id"), (F.col("o_totalprice") / 1000).alias("value"),
            F.col("o_orderpriority").alias("cause_of_death"), "o_orderkey"),
        "raw_medicare_utilisation": services.select(
            F.col("sa2_code").alias("geographic_id"), F.col("l_quantity").alias("utilisation_rate"),
            (F.col("l_discount") * 100).alias("bulk_billed_percentage")),
        "raw_bom_climate": obs.select(
            F.format_string("%09d", "s_suppkey").alias("station_id"), F.col("s_name").alias("station_name"),
            F.round(113.0 + ((F.col("s_suppkey") * 613) % 400) * 0.1, 6).alias("longitude"),
            F.round(-43.0 + ((F.col("s_suppkey") * 389) % 330) * 0.1, 6).alias("latitude"),
            F.col("l_quantity").alias("temperature_max_celsius"), (F.col("l_extendedprice") / 1000).alias("rainfall_mm")),
    }


@query("staged_projections", "2.3-01", sql=with_sql(*RAW_CTES) + """
SELECT 'census' AS source, sa2_code, total_population::DOUBLE AS measure FROM raw_abs_census
UNION ALL SELECT 'seifa', sa2_code, seifa_irsad_score FROM raw_abs_seifa UNION ALL SELECT 'geographic', geographic_id, area_square_km FROM raw_abs_geographic
UNION ALL SELECT 'mortality', geographic_id, value FROM raw_aihw_mortality UNION ALL SELECT 'medicare', geographic_id, utilisation_rate FROM raw_medicare_utilisation
UNION ALL SELECT 'climate', station_id, temperature_max_celsius FROM raw_bom_climate""")
def _(t):
    raw = raw_tables(t)
    parts = []
    for name, code, value in (("abs_census", "sa2_code", "total_population"), ("abs_seifa", "sa2_code", "seifa_irsad_score"),
                              ("abs_geographic", "sa2_code", "area_square_km"), ("aihw_mortality", "sa2_code", "mortality_rate"),
                              ("medicare_utilisation", "sa2_code", "utilisation_rate"), ("bom_climate", "station_id", "temperature_max_celsius")):
        parts.append(marts.stage(raw, f"raw_{name}").select(
            F.lit(name.split("_")[0 if name.startswith(("medicare",)) else 1]).alias("source"), F.col(code).alias("sa2_code"),
            F.col(value).cast("double").alias("measure")))
    return S.stack(*parts)


_SOCIO = """socio AS (SELECT c.sa2_code, total_population, median_age, median_household_income, unemployment_rate, seifa_irsad_score, seifa_irsd_decile,
  area_square_km, remoteness_category FROM raw_abs_census c LEFT JOIN raw_abs_seifa s ON c.sa2_code = s.sa2_code LEFT JOIN raw_abs_geographic g ON c.sa2_code = g.geographic_id)"""
_HEALTH = """health AS (SELECT m.geographic_id AS sa2_code, m.mortality_rate, u.utilisation_rate, u.bulk_billed_percentage FROM
  (SELECT geographic_id, avg(value) AS mortality_rate FROM raw_aihw_mortality GROUP BY 1) m LEFT JOIN
  (SELECT geographic_id, avg(utilisation_rate) AS utilisation_rate, avg(bulk_billed_percentage) AS bulk_billed_percentage FROM raw_medicare_utilisation GROUP BY 1) u USING (geographic_id))"""
_DERIVED = """derived AS (SELECT *, mortality_rate * 0.5 + utilisation_rate * 0.3 + bulk_billed_percentage * 0.2 AS composite_health_index
  FROM health JOIN socio USING (sa2_code))"""


@query("socioeconomic_profile", "2.4-01", sql=with_sql(*RAW_CTES, _SOCIO) + """
SELECT sa2_code, total_population, median_age, round(median_household_income, 4) AS median_household_income, round(unemployment_rate, 8) AS unemployment_rate,
  seifa_irsad_score, seifa_irsd_decile, area_square_km, remoteness_category FROM socio""")
def _(t):
    return marts.socioeconomic_profile(raw_tables(t)).withColumns({
        "median_household_income": r(F.col("median_household_income"), 4), "unemployment_rate": r(F.col("unemployment_rate"))})


@query("health_profile_as_joined", "2.4-02", sql=with_sql(*RAW_CTES) + """
SELECT m.geographic_id AS sa2_code, round(m.value, 5) AS mortality_rate, u.utilisation_rate, round(u.bulk_billed_percentage, 6) AS bulk_billed_percentage,
  c.temperature_max_celsius, c.rainfall_mm FROM raw_aihw_mortality m LEFT JOIN raw_medicare_utilisation u ON m.geographic_id = u.geographic_id
  LEFT JOIN raw_bom_climate c ON m.geographic_id = c.station_id""")
def _(t):
    return marts.health_profile(raw_tables(t)).withColumns({
        "mortality_rate": F.round("mortality_rate", 5), "bulk_billed_percentage": F.round("bulk_billed_percentage", 6)})


def _derived(t):
    raw = raw_tables(t)
    m = marts.master_health_record(marts.health_profile_by_area(raw), marts.socioeconomic_profile(raw))
    return marts.derived_health_indicators(m)


@query("master_health_record", "2.4-03", "2.3-12", sql=with_sql(*RAW_CTES, _SOCIO, _HEALTH, _DERIVED) + """
SELECT sa2_code, round(mortality_rate, 7) AS mortality_rate, round(utilisation_rate, 8) AS utilisation_rate, round(bulk_billed_percentage, 8) AS bulk_billed_percentage,
  total_population, remoteness_category, seifa_irsd_decile, substr(sa2_code, 1, 1) AS state_code FROM derived""")
def _(t):
    return _derived(t).select("sa2_code", r(F.col("mortality_rate"), 7).alias("mortality_rate"), r(F.col("utilisation_rate")).alias("utilisation_rate"),
                              r(F.col("bulk_billed_percentage")).alias("bulk_billed_percentage"), "total_population", "remoteness_category",
                              "seifa_irsd_decile", "state_code")


@query("composite_index_top_areas", "2.13-01", "2.7-01", sql=with_sql(*RAW_CTES, _SOCIO, _HEALTH, _DERIVED) + """
SELECT sa2_code, round(composite_health_index, 6) AS composite_health_index FROM derived WHERE composite_health_index IS NOT NULL
ORDER BY derived.composite_health_index DESC, sa2_code LIMIT 10""")
def _(t):
    top = S.top_and_bottom(_derived(t), "sa2_code", "composite_health_index", 10).filter("side = 'top'")
    return top.select("sa2_code", r(F.col("composite_health_index"), 6).alias("composite_health_index"))


@query("health_summary", "2.5-01", sql=with_sql(*RAW_CTES, _SOCIO, _HEALTH, _DERIVED) + """
SELECT count(DISTINCT sa2_code) AS total_sa2, round(avg(mortality_rate), 5) AS avg_mortality_rate, round(avg(utilisation_rate), 6) AS avg_utilisation_rate,
  sum(total_population)::BIGINT AS total_population, round(avg(composite_health_index), 5) AS avg_composite_index FROM derived""")
def _(t):
    s = marts.health_summary(_derived(t))
    return s.select("total_sa2", r(F.col("avg_mortality_rate"), 5).alias("avg_mortality_rate"), r(F.col("avg_utilisation_rate"), 6).alias("avg_utilisation_rate"),
                    "total_population", r(F.col("avg_composite_index"), 5).alias("avg_composite_index"))


@query("mart_key_tests", "2.14-04", sql=with_sql(*RAW_CTES) + """
SELECT (SELECT count(*) FROM (SELECT geographic_id FROM raw_aihw_mortality GROUP BY 1 HAVING count(*) > 1)) AS repeated_keys, 0::BIGINT AS null_keys""")
def _(t):
    return J.unique_and_present(raw_tables(t)["raw_aihw_mortality"], "geographic_id").withColumn(
        "null_keys", F.col("null_keys").cast("long"))


@query("one_to_one_domains", "2.4-04", sql=with_sql(LABOUR, HOUSING) + """
SELECT p_partkey AS area_id, 2021 AS census_year, p_size AS size, h.rented AS rented_housing, l.unemployed AS unemployed_employment
FROM part LEFT JOIN housing h ON h.area_id = p_partkey LEFT JOIN labour l ON l.area_id = p_partkey""".replace(
    "h.rented AS", "h.rented::DOUBLE AS").replace("l.unemployed AS", "l.unemployed::DOUBLE AS"))
def _(t):
    year = F.lit(2021).alias("census_year")
    base = t.part.select(F.col("p_partkey").alias("area_id"), year, F.col("p_size").alias("size"))
    out = J.domain_joins(base, {
        "housing": housing(t).select("area_id", year, F.col("rented").cast("double").alias("rented")),
        "employment": labour(t).select("area_id", year, F.col("unemployed").cast("double").alias("unemployed")),
        "education": t.labels}, ["area_id", "census_year"])
    return out


@query("dimension_unknown_member", "2.4-05", sql="""
SELECT event_id, coalesce(c_custkey + 10000, -99) AS geo_sk FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 0""")
def _(t):
    dim = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("geo_id"), (F.col("c_custkey") + 10000).alias("geo_sk"))
    return J.lookup(t.events.select("event_id", "user_id"), dim, "user_id", "geo_id", "geo_sk").select("event_id", "geo_sk")


@query("merged_sources", "2.4-06", "2.2-17", "2.8-03", sql=with_sql(LABOUR, HOUSING) + """
SELECT coalesce(l.area_id, h.area_id, s_suppkey) AS area_id, coalesce(s_acctbal, h.rented, l.people)::DOUBLE AS measure, coalesce(h.males, NULL)::DOUBLE AS males,
  concat_ws(',', CASE WHEN l.area_id IS NOT NULL THEN 'health' END, CASE WHEN h.area_id IS NOT NULL THEN 'demographic' END,
   CASE WHEN s_suppkey IS NOT NULL THEN 'geographic' END) AS sources
FROM labour l FULL JOIN housing h ON l.area_id = h.area_id FULL JOIN supplier ON s_suppkey = coalesce(l.area_id, h.area_id)""")
def _(t):
    m = J.merge_sources({
        "health": labour(t).select("area_id", F.col("people").cast("double").alias("measure")),
        "demographic": housing(t).select("area_id", F.col("rented").cast("double").alias("measure"), F.col("males").cast("double").alias("males")),
        "geographic": t.supplier.select(F.col("s_suppkey").alias("area_id"), F.col("s_acctbal").alias("measure"))}, "area_id")
    return m.withColumn("sources", F.array_join("sources", ","))


# Customers carry an area code, a postcode of four areas or an unknown kind; every
# SA3 and SA4 occurs once as a record of its own.
_CODES = """k AS (SELECT 'c' || area_id AS rec, CASE segment WHEN 'AUTOMOBILE' THEN 'SA2_code' WHEN 'HOUSEHOLD' THEN 'zip' ELSE 'meshblock' END AS kind,
  CASE segment WHEN 'AUTOMOBILE' THEN sa2_code WHEN 'HOUSEHOLD' THEN printf('%04d', area_id // 3 % 10000) ELSE 'x' END AS code, balance AS people FROM areas
  UNION ALL SELECT DISTINCT 's' || sa3_code, ' sa3 ', sa3_code, 100.0 FROM areas UNION ALL SELECT DISTINCT 's' || sa4_code, 'statistical_area_4', sa4_code, 1000.0 FROM areas)"""
_CONC = """base AS (SELECT DISTINCT sa2_code AS target FROM areas), conc AS (SELECT 'sa2' AS code_type, target AS code, target, 1.0::DOUBLE AS factor FROM base
  UNION ALL SELECT 'sa3', substr(target, 1, 5), target, 1.0 / count(*) OVER (PARTITION BY substr(target, 1, 5)) FROM base
  UNION ALL SELECT 'sa4', substr(target, 1, 3), target, 1.0 / count(*) OVER (PARTITION BY substr(target, 1, 3)) FROM base
  UNION ALL SELECT 'postcode', printf('%04d', area_id // 4 % 10000), sa2_code, 0.25 FROM areas)"""


def _concordance(t):
    a = areas(t)
    post = a.select(F.lit("postcode").alias("code_type"), F.format_string("%04d", F.floor(F.col("area_id") / 4) % 10000).alias("code"),
                    F.col("sa2_code").alias("target"), F.lit(0.25).alias("factor"))
    return J.area_concordance(a, "sa2_code").unionByName(post)


def _coded(t):
    a, seg = areas(t), F.col("segment")
    kind = F.when(seg == "AUTOMOBILE", "SA2_code").when(seg == "HOUSEHOLD", "zip").otherwise("meshblock")
    code = (F.when(seg == "AUTOMOBILE", F.col("sa2_code"))
            .when(seg == "HOUSEHOLD", F.format_string("%04d", F.floor(F.col("area_id") / 3) % 10000)).otherwise("x"))
    people = a.select(F.concat(F.lit("c"), F.col("area_id").cast("string")).alias("rec"), kind.alias("kind"), code.alias("code"),
                      F.col("balance").alias("people"))
    for level, name, n in (("sa3_code", " sa3 ", 100.0), ("sa4_code", "statistical_area_4", 1000.0)):
        up = a.select(level).distinct().select(F.concat(F.lit("s"), F.col(level)).alias("rec"), F.lit(name).alias("kind"),
                                               F.col(level).alias("code"), F.lit(n).alias("people"))
        people = people.unionByName(up)
    return people


_NORMAL = "CASE trim(lower(kind)) WHEN 'sa2_code' THEN 'sa2' WHEN 'statistical_area_4' THEN 'sa4' WHEN 'zip' THEN 'postcode' ELSE trim(lower(kind)) END"


@query("concordance_allocation", "2.4-07", "2.4-08", sql=with_sql(AREAS, _CODES, _CONC, f"n AS (SELECT *, {_NORMAL} AS code_type FROM k)") + """
SELECT rec, n.code_type, target AS target_area, round(coalesce(factor, 0), 8) AS allocation_factor,
  CASE WHEN target IS NULL THEN NULL WHEN n.code_type = 'postcode' THEN 'population_weighted' WHEN n.code_type = 'sa2' THEN 'direct' ELSE 'area_weighted' END AS mapping_method,
  CASE WHEN target IS NULL THEN NULL WHEN n.code_type = 'postcode' THEN 0.95 WHEN n.code_type = 'sa2' THEN 1.0 WHEN n.code_type = 'sa3' THEN 0.9 ELSE 0.8 END::DOUBLE AS mapping_confidence,
  people, CASE WHEN target IS NULL AND n.code_type = 'meshblock' THEN 'unsupported_code_type' WHEN target IS NULL THEN 'no_mapping' END AS mapping_error, a.lat AS latitude
FROM n LEFT JOIN conc c ON c.code_type = n.code_type AND c.code = n.code LEFT JOIN areas a ON a.sa2_code = target""")
def _(t):
    centroids = areas(t).select(F.col("sa2_code").alias("area"), F.col("lat").alias("latitude"))
    m = J.map_to_areas(_coded(t), "code", "kind", _concordance(t), key=["rec"], centroids=centroids)
    return m.withColumn("allocation_factor", r(F.col("allocation_factor"))).drop("kind", "code")


@query("concordance_totals", "2.4-07", sql=with_sql(AREAS, _CODES, _CONC, f"n AS (SELECT *, {_NORMAL} AS code_type FROM k)") + """
SELECT target AS target_area, round(sum(people * factor), 6) AS people FROM n JOIN conc c ON c.code_type = n.code_type AND c.code = n.code GROUP BY 1""")
def _(t):
    m = J.map_to_areas(_coded(t), "code", "kind", _concordance(t), key=["rec"])
    return J.allocated_totals(m, ["people"]).withColumn("people", r(F.col("people"), 6))


BOXES = """boxes AS (SELECT s_suppkey AS box_id, s_acctbal AS people, 113.0::DOUBLE + s_suppkey * 0.37::DOUBLE AS x0, 113.0::DOUBLE + s_suppkey * 0.37::DOUBLE + 0.5 + (s_suppkey % 7) * 0.5 AS x1,
  -43.0 + ((s_suppkey * 53) % 310) / 10.0 AS y0, -43.0 + ((s_suppkey * 53) % 310) / 10.0 + 0.5 + (s_suppkey % 5) * 0.5 AS y1 FROM supplier)"""
_BOX = ["x0", "x1", "y0", "y1"]


def boxes(t):
    k = F.col("s_suppkey")
    x0, y0 = 113.0 + k * 0.37, -43.0 + ((k * 53) % 310) / 10.0
    return t.supplier.select(k.alias("box_id"), F.col("s_acctbal").alias("people"), x0.alias("x0"), (x0 + 0.5 + (k % 7) * 0.5).alias("x1"),
                             y0.alias("y0"), (y0 + 0.5 + (k % 5) * 0.5).alias("y1"))


@query("points_in_boxes", "2.4-09", sql=with_sql(AREAS, BOXES) + """
SELECT area_id, box_id FROM areas JOIN boxes ON lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1""")
def _(t):
    return P.points_in_boxes(areas(t), boxes(t), point=("area_id", "lon", "lat"), box_id="box_id", box=_BOX)


@query("boxes_meeting", "2.4-10", sql=with_sql(BOXES) + """
SELECT a.box_id, b.box_id AS other FROM boxes a JOIN boxes b ON NOT (a.x1 < b.x0 OR a.x0 > b.x1 OR a.y1 < b.y0 OR a.y0 > b.y1)""")
def _(t):
    b = boxes(t)
    o = b.select(F.col("box_id").alias("other"), *[F.col(c).alias(f"o_{c}") for c in _BOX])
    return P.boxes_meeting(b, o, a_id="box_id", b_id="other", a_box=_BOX, b_box=[f"o_{c}" for c in _BOX]).select("box_id", "other")


@query("sibling_counts", "2.4-11", sql=with_sql(AREAS) + "SELECT area_id, sa3_code, count(*) OVER (PARTITION BY sa3_code) - 1 AS sibling_count FROM areas")
def _(t):
    return J.sibling_counts(areas(t).select("area_id", "sa2_code", "sa3_code"), "sa2_code", "sa3_code").drop("sa2_code")


@query("parent_member_lists", "2.4-11", sql=with_sql(AREAS, "p AS (SELECT sa4_code, sa2_code, (row_number() OVER (PARTITION BY sa4_code ORDER BY sa2_code) - 1) // 25 AS chunk FROM areas)") + """
SELECT sa4_code, chunk::INTEGER AS chunk, string_agg(sa2_code, ',' ORDER BY sa2_code) AS members FROM p GROUP BY 1, 2""")
def _(t):
    m = J.members_in_chunks(areas(t), "sa2_code", "sa4_code", chunk=25)
    return m.withColumn("members", F.array_join("members", ","))


_KM = "2 * 6371.0 * asin(least(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)), 1))"


@query("close_centroids", "2.4-12", sql=with_sql(AREAS, f"d AS (SELECT a.lon, a.lat, {_KM} AS km FROM areas a JOIN areas b ON a.area_id <> b.area_id)") + """
SELECT lon, lat, 1::BIGINT AS copies, count(*) AS close, round(min(km), 6) AS nearest_km FROM d WHERE km < 5 GROUP BY 1, 2""")
def _(t):
    c = P.close_locations(areas(t), "lon", "lat", 5.0)
    return c.withColumn("nearest_km", r(F.col("nearest_km"), 6))


@query("far_centroids", "2.4-12", sql=with_sql(AREAS) + f"""
SELECT lon, lat, 1::BIGINT AS copies FROM areas a WHERE EXISTS (SELECT 1 FROM areas b WHERE {_KM} > 4000)""")
def _(t):
    return P.far_locations(areas(t), "lon", "lat", 4000.0)


@query("adjacency_problems", "2.4-13", sql=with_sql(BOXES, """
d AS (SELECT x0, x1, y0, y1, count(*) AS copies FROM boxes GROUP BY 1, 2, 3, 4),
p AS (SELECT a.*, b.x0 AS o_x0, b.x1 AS o_x1, b.y0 AS o_y0, b.y1 AS o_y1, b.copies AS other_copies, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) AS ov,
  sqrt(pow(greatest(a.x0 - b.x1, b.x0 - a.x1, 0), 2) + pow(greatest(a.y0 - b.y1, b.y0 - a.y1, 0), 2)) AS gap
  FROM d a JOIN d b ON row(a.x0, a.x1, a.y0, a.y1) < row(b.x0, b.x1, b.y0, b.y1))""") + """
SELECT x0, x1, y0, y1, o_x0, o_x1, o_y0, o_y1, copies, other_copies, CASE WHEN ov > 0 THEN 'overlap' ELSE 'gap' END AS problem, round(ov, 8) AS overlap_area, round(gap, 8) AS gap
FROM p WHERE ov > 0 OR (gap > 0 AND gap < 0.25)""")
def _(t):
    a = P.adjacency_problems(boxes(t), _BOX, 0.25)
    return a.withColumns({"overlap_area": r(F.col("overlap_area")), "gap": r(F.col("gap"))})


@query("boundary_join_density", "2.4-16", sql=with_sql(BOXES) + """
SELECT box_id, round(s_acctbal / (x1 - x0), 6) AS population_density FROM supplier JOIN boxes ON s_suppkey = box_id""")
def _(t):
    b = boxes(t).select(F.col("box_id").alias("SA2_CODE21"), (F.col("x1") - F.col("x0")).alias("area_sqkm"))
    d = J.join_boundaries(t.supplier, b, "s_suppkey", "SA2_CODE21", "s_acctbal", "area_sqkm")
    return d.select(F.col("SA2_CODE21").alias("box_id"), r(F.col("population_density"), 6).alias("population_density"))


@query("area_relations", "2.4-18", sql=with_sql(AREAS, BOXES, """
m AS (SELECT a.box_id, count(*) AS k FROM boxes a JOIN boxes b ON a.box_id <> b.box_id AND NOT (a.x1 < b.x0 OR a.x0 > b.x1 OR a.y1 < b.y0 OR a.y0 > b.y1) GROUP BY 1),
s AS (SELECT box_id, count(*) AS k FROM areas JOIN boxes ON lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1 GROUP BY 1)""") + """
SELECT box_id, people, coalesce(m.k, 0) AS adjacent_areas, coalesce(s.k, 0) AS services_inside, round(people / s.k, 6) AS catchment
FROM boxes LEFT JOIN m USING (box_id) LEFT JOIN s USING (box_id)""")
def _(t):
    a = P.area_relations(boxes(t), areas(t), area_id="box_id", box=_BOX, population="people", service=("area_id", "lon", "lat"))
    return a.withColumn("catchment", r(F.col("catchment"), 6))


_STATIONS = """st AS (SELECT printf('%09d', s_suppkey) AS station_id, round(113.0 + ((s_suppkey * 613) % 400) * 0.1, 6) AS lon, round(-43.0 + ((s_suppkey * 389) % 330) * 0.1, 6) AS lat FROM supplier)"""


def stations(t):
    return t.supplier.select(F.format_string("%09d", "s_suppkey").alias("station_id"),
                             F.round(113.0 + ((F.col("s_suppkey") * 613) % 400) * 0.1, 6).alias("slon"),
                             F.round(-43.0 + ((F.col("s_suppkey") * 389) % 330) * 0.1, 6).alias("slat"))


@query("nearest_station", "2.4-19", sql=with_sql(AREAS, _STATIONS, f"d AS (SELECT a.area_id, b.station_id, {_KM} AS km FROM areas a, st b)") + """
SELECT area_id, arg_min(station_id, row(km, station_id)) AS station_id, round(min(km), 6) AS distance_km FROM d GROUP BY 1""")
def _(t):
    n = P.nearest_station(areas(t), stations(t), area=("area_id", "lon", "lat"), station=("station_id", "slon", "slat"))
    return n.withColumn("distance_km", r(F.col("distance_km"), 6))


@query("nearest_services", "2.4-18", sql=with_sql(AREAS, _STATIONS, f"d AS (SELECT a.area_id, b.station_id, {_KM} AS km FROM areas a, st b)") + """
SELECT area_id, row_number() OVER (PARTITION BY area_id ORDER BY km, station_id)::INTEGER AS rank, station_id AS service_id, round(km, 6) AS distance_km
FROM d QUALIFY row_number() OVER (PARTITION BY area_id ORDER BY km, station_id) <= 5""")
def _(t):
    n = P.nearest_services(areas(t), stations(t), area=("area_id", "lon", "lat"), service=("station_id", "slon", "slat"), k=5)
    return n.withColumn("distance_km", r(F.col("distance_km"), 6))


@query("hot_spots", "2.4-18", sql=with_sql(AREAS, """
a AS (SELECT area_id, floor((lon + 180) / 2) AS cx, floor((lat + 90) / 2) AS cy, balance AS v FROM areas),
c AS (SELECT cx, cy, count(*) AS c, sum(v) AS s FROM a GROUP BY 1, 2), w AS (SELECT count(*) AS n, avg(v) AS m, stddev_pop(v) AS d FROM a),
h AS (SELECT x.cx, x.cy, sum(y.c) AS k, sum(y.s) AS s FROM c x JOIN c y ON abs(x.cx - y.cx) <= 1 AND abs(x.cy - y.cy) <= 1 GROUP BY 1, 2),
z AS (SELECT area_id, k::BIGINT AS neighbours, CASE WHEN k < n THEN (h.s - m * k) / (d * sqrt((n * k - k * k) / (n - 1))) END AS z FROM a JOIN h USING (cx, cy), w)""") + """
SELECT area_id, neighbours, round(z, 6) AS z, CASE WHEN z >= 1.96 THEN 'hot' WHEN z <= -1.96 THEN 'cold' ELSE 'none' END AS spot FROM z""")
def _(t):
    h = P.hot_spots(areas(t), area_id="area_id", lon="lon", lat="lat", value="balance", cell=2.0)
    return h.withColumn("z", r(F.col("z"), 6))


@query("mart_with_nearest_climate", "2.4-19", "2.4-03", sql=with_sql(*RAW_CTES, _SOCIO, _STATIONS, f"""
d AS (SELECT a.sa2_code, b.station_id, {_KM} AS km FROM areas a, st b), n AS (SELECT sa2_code, arg_min(station_id, row(km, station_id)) AS station_id FROM d GROUP BY 1),
c AS (SELECT station_id, avg(temperature_max_celsius) AS tx, avg(rainfall_mm) AS rain FROM raw_bom_climate GROUP BY 1),
m AS (SELECT geographic_id AS sa2_code, avg(value) AS mr FROM raw_aihw_mortality GROUP BY 1)""") + """
SELECT sa2_code, round(mr, 7) AS mortality_rate, round(tx, 7) AS temperature_max_celsius, round(rain, 7) AS rainfall_mm FROM m JOIN socio USING (sa2_code) JOIN n USING (sa2_code) JOIN c USING (station_id)""")
def _(t):
    raw = raw_tables(t)
    n = P.nearest_station(areas(t), stations(t), area=("sa2_code", "lon", "lat"), station=("station_id", "slon", "slat"))
    m = marts.master_health_record(marts.health_profile_by_area(raw, n), marts.socioeconomic_profile(raw))
    return m.select("sa2_code", r(F.col("mortality_rate"), 7).alias("mortality_rate"), r(F.col("temperature_max_celsius"), 7).alias("temperature_max_celsius"),
                    r(F.col("rainfall_mm"), 7).alias("rainfall_mm"))
