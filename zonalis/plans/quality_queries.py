"""Rules, scores and gates over whole tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.functions import codes
from zonalis.operators import census as C
from zonalis.operators import quality as Q
from zonalis.operators import sets as S
from zonalis.plans.frames import AGE_COLUMNS, AGES, AREAS, HOUSING, LABOUR, ages, areas, housing, labour, r, with_sql
from zonalis.plans.registry import query


def area_rules():
    return [Q.outside("balance", 0, 9900), Q.not_matching("sa2_code", r"^[12]\d{8}$", Q.WARNING), Q.empty("score", Q.INFO),
            Q.outside("lat", -43, -12, Q.WARNING)]


_FOUND = """v AS (SELECT area_id, 'balance_range' AS rule_id, 'ERROR' AS severity, 'validity' AS dimension FROM areas WHERE balance < 0 OR balance > 9900
  UNION ALL SELECT area_id, 'sa2_code_pattern', 'WARNING', 'validity' FROM areas WHERE NOT regexp_full_match(sa2_code, '[12][0-9]{8}')
  UNION ALL SELECT area_id, 'score_missing', 'INFO', 'completeness' FROM areas WHERE score IS NULL
  UNION ALL SELECT area_id, 'lat_range', 'WARNING', 'validity' FROM areas WHERE lat < -43 OR lat > -12)"""


@query("rule_violations", "2.14-01", "2.14-02", "2.17-02", sql=with_sql(AREAS, _FOUND) + "SELECT area_id, rule_id, severity, dimension FROM v")
def _(t):
    return Q.violations(areas(t), "area_id", area_rules()).select("area_id", "rule_id", "severity", "dimension")


@query("rule_breach_counts", "2.14-02", sql=with_sql(AREAS, _FOUND) + "SELECT rule_id, severity, count(*) AS breaches, (SELECT count(*) FROM areas) AS rows FROM v GROUP BY 1, 2")
def _(t):
    return Q.rule_counts(areas(t), area_rules())


@query("schema_check", "2.14-03", sql="""
SELECT 'o_missing' AS "column", 'missing_required' AS problem, count(*) AS rows FROM orders UNION ALL SELECT 'o_optional', 'missing', count(*) FROM orders
UNION ALL SELECT 'o_orderdate', 'unexpected', count(*) FROM orders UNION ALL SELECT 'o_totalprice', 'unexpected', count(*) FROM orders UNION ALL SELECT 'o_orderstatus', 'wrong_type', count(*) FROM orders""")
def _(t):
    want = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_orderstatus", T.DoubleType()),
                         T.StructField("o_orderpriority", T.StringType()), T.StructField("o_missing", T.StringType()), T.StructField("o_optional", T.StringType())])
    return Q.schema_check(t.orders, want, ["o_missing"])


@query("indicator_ranges", "2.14-05", sql=with_sql(LABOUR, "x AS (SELECT people * 6.0 AS median_age, unemployed * 10.0 AS smoking_rate FROM labour)") + """
SELECT 'median_age_absolute' AS rule_id, 'ERROR' AS severity, count(*) FILTER (WHERE median_age < 15 OR median_age > 80) AS breaches, count(*) AS rows FROM x
UNION ALL SELECT 'median_age_typical', 'WARNING', count(*) FILTER (WHERE median_age BETWEEN 15 AND 80 AND NOT median_age BETWEEN 25 AND 55), count(*) FROM x
UNION ALL SELECT 'smoking_rate_absolute', 'ERROR', count(*) FILTER (WHERE smoking_rate < 0 OR smoking_rate > 100), count(*) FROM x
UNION ALL SELECT 'smoking_rate_typical', 'WARNING', count(*) FILTER (WHERE smoking_rate BETWEEN 0 AND 100 AND NOT smoking_rate BETWEEN 5 AND 30), count(*) FROM x""")
def _(t):
    d = labour(t).select((F.col("people") * 6.0).alias("median_age"), (F.col("unemployed") * 10.0).alias("smoking_rate"))
    return Q.rule_counts(d, Q.indicator_rules(d.columns))


@query("business_ranges", "2.14-06", sql=with_sql(LABOUR, "x AS (SELECT people * 20 AS total_population, unemployed * 9.0 AS mortality_rate, managers * 250.0 AS seifa_score FROM labour)") + """
SELECT 'total_population_bounds' AS rule_id, 'ERROR' AS severity, count(*) FILTER (WHERE NOT total_population BETWEEN 100 AND 50000) AS breaches, count(*) AS rows FROM x
UNION ALL SELECT 'mortality_rate_bounds', 'ERROR', count(*) FILTER (WHERE NOT mortality_rate BETWEEN 0 AND 50), count(*) FROM x
UNION ALL SELECT 'seifa_score_bounds', 'ERROR', count(*) FILTER (WHERE NOT seifa_score BETWEEN 400 AND 1200), count(*) FROM x""")
def _(t):
    d = labour(t).select((F.col("people") * 20).alias("total_population"), (F.col("unemployed") * 9.0).alias("mortality_rate"), (F.col("managers") * 250.0).alias("seifa_score"))
    return Q.rule_counts(d, Q.business_range_rules(d.columns))


@query("business_consistency", "2.14-07", sql=with_sql(AGES, """
x AS (SELECT area_id, total_population AS tp, males - area_id % 2 AS m, females AS f, age_0_4 + age_5_9 AS two, age_0_4 * 10.0 AS median_age, age_5_9 * 20.0 AS mr, area_id % 9 AS q1, area_id % 7 AS q2, area_id % 11 AS q3 FROM ages)""") + """
SELECT area_id, 'age_group_totals' AS rule_id FROM x WHERE abs(two - tp) / tp::DOUBLE > 0.02 UNION ALL SELECT area_id, 'sex_distribution' FROM x WHERE abs(m + f - tp) / tp::DOUBLE > 0.01
UNION ALL SELECT area_id, 'income_quartiles' FROM x WHERE q1 > q2 OR q2 > q3 UNION ALL SELECT area_id, 'young_area_high_mortality' FROM x WHERE median_age < 30 AND mr > 30""")
def _(t):
    i = F.col("area_id")
    d = ages(t).select("area_id", "total_population", (F.col("males") - i % 2).alias("males"), "females", "age_0_4", "age_5_9", (F.col("age_0_4") * 10.0).alias("median_age"),
                       (F.col("age_5_9") * 20.0).alias("mortality_rate"), (i % 9).alias("income_q1"), (i % 7).alias("income_median"), (i % 11).alias("income_q3"))
    return Q.violations(d, "area_id", Q.business_consistency_rules(d.columns, ["age_0_4", "age_5_9"])).select("area_id", "rule_id")


@query("mixed_data_years", "2.14-07", sql="SELECT count(DISTINCT year(o_orderdate)) AS years, count(DISTINCT year(o_orderdate)) > 1 AS mixed_years FROM orders")
def _(t):
    return Q.several_years(t.orders.select(F.year("o_orderdate").alias("yr")), "yr")


@query("demographic_stage_rules", "2.14-08", sql=with_sql(AGES) + """
SELECT area_id, 'population_mismatch' AS rule_id FROM ages WHERE abs(males - 12 + females - total_population) > greatest(10, total_population * 0.01)
UNION ALL SELECT area_id, 'age_mismatch' FROM ages WHERE abs(age_0_4 + age_5_9 - total_population) > total_population * 0.05""")
def _(t):
    d = ages(t).withColumn("males", F.col("males") - 12)
    return Q.violations(d, "area_id", Q.demographic_stage_rules(["age_0_4", "age_5_9"])).select("area_id", "rule_id")


@query("census_warnings", "2.14-09", sql=with_sql(LABOUR, "l AS (SELECT *, employed_full_time + employed_part_time + unemployed AS f FROM labour)") + """
SELECT rule_id, breaches FROM (SELECT 'employed_full_time_negative' AS rule_id, 0 AS breaches UNION ALL SELECT 'employed_part_time_negative', 0 UNION ALL SELECT 'unemployed_negative', 0
  UNION ALL SELECT 'not_in_labour_force_negative', 0 UNION ALL SELECT 'unemployment_rate_extreme', count(*) FILTER (WHERE unemployed * 100.0 / f > 25) FROM l
  UNION ALL SELECT 'participation_rate_extreme', count(*) FILTER (WHERE f * 100.0 / labour_force_pop < 30 OR f * 100.0 / labour_force_pop > 95) FROM l
  UNION ALL SELECT 'labour_force_sum', count(*) FILTER (WHERE abs(f + not_in_labour_force - labour_force_pop) > labour_force_pop * 0.05) FROM l)""")
def _(t):
    return Q.census_warning_counts(C.labour_force(labour(t))).select("rule_id", "breaches")


@query("hierarchy_checks", "2.14-10", sql=with_sql(AREAS, "x AS (SELECT sa2_code, sa3_code, CASE WHEN area_id % 10 = 3 THEN '999' ELSE sa4_code END AS sa4_code, CASE WHEN area_id % 8 <> 0 THEN state_code END AS state_code FROM areas)") + """
SELECT sa2_code, 'sa3_in_sa4' AS rule_id FROM x WHERE NOT starts_with(sa3_code, sa4_code) UNION ALL SELECT sa2_code, 'sa4_in_state' FROM x WHERE NOT starts_with(sa4_code, state_code)
UNION ALL SELECT sa2_code, 'chain_incomplete' FROM x WHERE state_code IS NULL""")
def _(t):
    i = F.col("area_id")
    d = areas(t).withColumns({"sa4_code": F.when(i % 10 == 3, "999").otherwise(F.col("sa4_code")), "state_code": F.when(i % 8 != 0, F.col("state_code"))})
    return Q.violations(d, "sa2_code", Q.hierarchy_rules()).select("sa2_code", "rule_id")


@query("coordinate_checks", "2.14-11", "2.1-09", sql=with_sql(AREAS, """
x AS (SELECT area_id, CASE WHEN segment = 'BUILDING' THEN 0.0 ELSE round(lat, 3) END AS lat, CASE WHEN segment = 'BUILDING' THEN 0.0 WHEN segment = 'MACHINERY' THEN lon + 100 ELSE lon END AS lon FROM areas)""") + """
SELECT area_id, 'longitude_range' AS rule_id FROM x WHERE NOT lon BETWEEN -180 AND 180 UNION ALL SELECT area_id, 'outside_australia' FROM x WHERE NOT (lon BETWEEN 96 AND 169 AND lat BETWEEN -55 AND -9)
UNION ALL SELECT area_id, 'null_island' FROM x WHERE lat = 0 AND lon = 0
UNION ALL SELECT area_id, 'low_precision' FROM x""")
def _(t):
    seg = F.col("segment")
    d = areas(t).select("area_id", F.when(seg == "BUILDING", 0.0).otherwise(F.round("lat", 3)).alias("lat"),
                        F.when(seg == "BUILDING", 0.0).when(seg == "MACHINERY", F.col("lon") + 100).otherwise(F.col("lon")).alias("lon"))
    return Q.violations(d, "area_id", Q.coordinate_rules("lon", "lat")).select("area_id", "rule_id")


@query("duplicate_coordinates", "2.14-12", sql=with_sql(AREAS) + """
SELECT round(lon) AS lon, round(lat) AS lat, count(*) AS areas FROM areas GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t):
    return Q.duplicate_coordinates(areas(t).select("lon", "lat"), "lon", "lat", 0)


@query("plausibility_checks", "2.14-13", sql=with_sql(AREAS, "x AS (SELECT area_id, (area_id % 40)::DOUBLE AS area, balance * 100 AS people, lon, lat - 15 AS lat, area_id % 2 = 0 AS coastal FROM areas)") + """
SELECT area_id, 'area_below_minimum' AS rule_id FROM x WHERE area < 0.001 UNION ALL SELECT area_id, 'density_zero_area' FROM x WHERE area <= 0
UNION ALL SELECT area_id, 'density_extreme' FROM x WHERE area > 0 AND people / area > 50000 UNION ALL SELECT area_id, 'centroid_outside' FROM x WHERE NOT (lat BETWEEN -54.777 AND -9.142 AND lon BETWEEN 72.246 AND 167.998)
UNION ALL SELECT area_id, 'coastal_mismatch' FROM x WHERE coastal <> (abs(lat + 43.7) < 0.5 OR abs(lat + 10.7) < 0.5 OR abs(lon - 113.2) < 0.5 OR abs(lon - 153.6) < 0.5)""")
def _(t):
    i = F.col("area_id")
    d = areas(t).select("area_id", (i % 40).cast("double").alias("area"), (F.col("balance") * 100).alias("people"), "lon", (F.col("lat") - 15).alias("lat"), (i % 2 == 0).alias("coastal"))
    return Q.violations(d, "area_id", Q.plausibility_rules("area", "people", "lon", "lat", "coastal")).select("area_id", "rule_id")


@query("boundary_checks", "2.14-14", "2.9-05", sql=with_sql(AREAS) + """
SELECT area_id, 'parent_missing' AS rule_id FROM areas WHERE area_id % 6 = 0 UNION ALL SELECT area_id, 'code_digits' FROM areas WHERE area_id % 5 = 0
UNION ALL SELECT area_id, 'area_range' FROM areas WHERE (area_id % 5 = 0 AND area_id % 9 < 10) OR (area_id % 5 <> 0 AND area_id % 9 < 1)
UNION ALL SELECT area_id, 'ring_invalid' FROM areas WHERE area_id % 4 = 1""")
def _(t):
    i = F.col("area_id")
    p = [F.array(F.lit(130.0), F.lit(-30.0)), F.array(F.lit(131.0), F.lit(-30.0)), F.array(F.lit(131.0), F.lit(-29.0))]
    ring = F.when(i % 4 == 1, F.array(p[0], p[1], p[2], p[1])).otherwise(F.array(p[0], p[1], p[2], p[0]))
    d = areas(t).select("area_id", F.when(i % 5 == 0, "SA3").otherwise("SA2").alias("kind"), "sa2_code", F.when(i % 6 == 0, "").otherwise(F.col("sa3_code")).alias("parent"),
                        F.array(ring).alias("rings"), (i % 9).cast("double").alias("area"))
    return Q.violations(d, "area_id", Q.boundary_rules("kind", "sa2_code", "parent", "rings", "area")).select("area_id", "rule_id")


@query("six_dimension_score", "2.14-15", sql=with_sql(AREAS, """
s AS (SELECT (count(sa2_code) / count(*)::DOUBLE * 1.0 + count(score) / count(*)::DOUBLE * 0.8) / 1.8 AS completeness,
  ((count(*) FILTER (WHERE score < 9000))::DOUBLE / count(score) + (count(*) FILTER (WHERE segment <> 'BUILDING'))::DOUBLE / count(*)) / 2 AS validity,
  avg(starts_with(sa2_code, state_code)::INT) AS consistency, avg((balance < 5000)::INT) AS timeliness, count(DISTINCT sa3_code) / count(*)::DOUBLE AS uniqueness, count(*) AS rows FROM areas),
o AS (SELECT *, completeness * 0.25 + validity * 0.25 + consistency * 0.2 + 0.9 * 0.15 + timeliness * 0.1 + uniqueness * 0.05 AS overall FROM s)""") + """
SELECT rows, round(completeness, 8) AS completeness, round(validity, 8) AS validity, consistency, round(timeliness, 8) AS timeliness, round(uniqueness, 8) AS uniqueness, round(overall, 8) AS overall,
  CASE WHEN overall >= 0.95 THEN 'EXCELLENT' WHEN overall >= 0.85 THEN 'GOOD' WHEN overall >= 0.7 THEN 'ACCEPTABLE' WHEN overall >= 0.5 THEN 'POOR' ELSE 'CRITICAL' END AS grade FROM o""")
def _(t):
    d = areas(t)
    dated = F.when(F.col("balance") < 5000, F.lit("2023-06-30")).otherwise("2001-12-31").cast("date")
    s = Q.quality_score(d, completeness={"critical": ["sa2_code"], "high": ["score"]}, validity={"score": F.col("score") < 9000, "segment": F.col("segment") != "BUILDING"},
                        consistency=[F.col("sa2_code").startswith(F.col("state_code"))], dated=dated, as_of="2024-01-01", keys=["sa3_code"])
    return s.select("rows", *[r(F.col(c)).alias(c) for c in ("completeness", "validity", "consistency", "timeliness", "uniqueness", "overall")], "grade")


@query("census_quality_metrics", "2.14-16", sql=with_sql(LABOUR, HOUSING, """
x AS (SELECT p_partkey, h.rented AS a, h.males AS b, l.people AS c, l.managers AS d, l.people AS people, p_size AS tp FROM part LEFT JOIN housing h ON h.area_id = p_partkey AND h.rented > 5 LEFT JOIN labour l ON l.area_id = p_partkey)""") + """
SELECT p_partkey, (a IS NOT NULL)::INT::DOUBLE AS housing_completeness, (c IS NOT NULL)::INT::DOUBLE AS employment_completeness, ((a IS NOT NULL)::INT + (c IS NOT NULL)::INT) / 2.0::DOUBLE AS data_completeness_score,
  coalesce(people / tp::DOUBLE BETWEEN 0.6 * 0.95 AND 0.8 * 1.05, true) AS population_consistency_flag FROM x""")
def _(t):
    h = housing(t).filter("rented > 5").select(F.col("area_id").alias("p_partkey"), F.col("rented").alias("rented_housing"), F.col("males").alias("males_housing"))
    e = labour(t).select(F.col("area_id").alias("p_partkey"), F.col("people").alias("people_employment"), F.col("managers").alias("managers_employment"))
    d = t.part.select("p_partkey", "p_size").join(h, "p_partkey", "left").join(e, "p_partkey", "left")
    q = Q.census_quality(d, ["housing", "employment"], population="p_size", working_age="people_employment")
    return d.select("p_partkey", *[q[c].alias(c) for c in ("housing_completeness", "employment_completeness", "data_completeness_score", "population_consistency_flag")])


@query("census_overall_score", "2.14-16", sql=with_sql(LABOUR) + """
SELECT area_id, round(greatest(0, CASE WHEN unemployed > 2 THEN (people * 4 * 0.3 + managers * 10 * 0.25 + professionals * 10 * 0.25) / 0.8 ELSE (people * 4 * 0.3 + managers * 10 * 0.25 + 90 * 0.2 + professionals * 10 * 0.25) / 1.0 END
  - least(unemployed * 2, 20)), 8) AS overall FROM labour""")
def _(t):
    c = F.col
    s = Q.census_overall(c("people") * 4.0, c("managers") * 10.0, F.when(c("unemployed") <= 2, 90.0), c("professionals") * 10.0, c("unemployed"))
    return labour(t).select("area_id", r(s).alias("overall"))


@query("health_stage_quality", "2.14-17", sql=with_sql(AREAS) + """
SELECT area_id, (1 + (score IS NOT NULL)::INT) / 5.0 * 100 AS health_data_completeness,
  CASE WHEN score IS NULL THEN 0.5 + 0.0 ELSE ((CASE WHEN score / 100 BETWEEN 70 AND 90 THEN 1.0 WHEN score = 0 THEN NULL ELSE 0.5 END) + CASE WHEN score <= 5000 THEN 1.0 ELSE 0.5 END) / 2 END AS health_overall_quality_score
FROM areas WHERE score IS NULL OR score <> 0""".replace("CASE WHEN score IS NULL THEN 0.5 + 0.0", "CASE WHEN score IS NULL THEN 1.0"))
def _(t):
    a = areas(t).filter("score IS NULL OR score <> 0")
    d = a.select("area_id", (F.col("score") / 100).alias("life_expectancy"),
                 F.when(F.col("score").isNotNull(), F.create_map(F.lit("all"), F.col("score"), F.lit("infant"), F.lit(5.0))).otherwise(F.create_map(F.lit("infant"), F.lit(5.0))).alias("mortality_indicators"))
    h = Q.health_stage(d)
    return d.select("area_id", *[c.alias(n) for n, c in h.items()])


@query("demographic_stage_quality", "2.14-17", sql=with_sql(AREAS, "x AS (SELECT *, area_id % 40 AS m, area_id % 30 AS f FROM areas)") + """
SELECT area_id, round((2 + (score IS NOT NULL)::INT) / 3.0, 8) AS population_completeness, round(2 / 6.0, 8) AS age_distribution_completeness,
  0.5::DOUBLE AS seifa_completeness, concat_ws(',', CASE WHEN abs(score - (m + f)) <= greatest(5, score * 0.005) THEN 'high_quality_population' END, 'complete_seifa') AS flags FROM x""")
def _(t):
    i = F.col("area_id")
    d = areas(t).select("area_id", "sa2_code", F.col("score").alias("total_population"), (i % 40).alias("male_population"), (i % 30).alias("female_population"),
                        F.lit(1).alias("age_0_4"), F.lit(2).alias("age_5_14"), F.col("balance").alias("irsd_score"))
    q = Q.demographic_stage(d.columns, ["age_0_4", "age_5_14"], ["irsd"])
    return d.select("area_id", *[r(q[c]).alias(c) for c in ("population_completeness", "age_distribution_completeness", "seifa_completeness")],
                    F.array_join(q["demographic_quality_flags"], ",").alias("flags"))


_PLACES = "greatest(length(regexp_extract(rtrim(printf('%.12f', {0}), '0'), '[.]([0-9]*)', 1)), 1)"


@query("geographic_stage_quality", "2.14-17", sql=with_sql(AREAS, f"""
p AS (SELECT *, (1 + (2 + (score IS NOT NULL)::INT) / 3.0 + 0 + 0.5) / 4 AS complete, CASE WHEN score IS NULL THEN 0.0 WHEN score BETWEEN 0.1 AND 10000 THEN 1.0 ELSE 0.5 END AS size,
  least(1, ({_PLACES.format('round(lat, 2)')} + {_PLACES.format('lon')}) / 12.0) AS coordinates, CASE WHEN area_id % 2 = 0 THEN 1.0 ELSE 2 / 3.0 END AS chain FROM areas)""") + """
SELECT area_id, round(complete, 8) AS geographic_completeness, round((coordinates + size + chain) / 3, 8) AS geographic_accuracy,
  round((complete + (coordinates + size + chain) / 3) / 2, 8) AS geographic_overall_quality, 'complete_hierarchy' AS flags FROM p""")
def _(t):
    # Every other area carries its state's number where its name belongs: a break in the chain.
    named = F.when(F.col("area_id") % 2 == 0, codes.state_of_code(F.col("sa2_code"))).otherwise(F.col("state_code"))
    d = areas(t).withColumns({"lat": F.round("lat", 2), "remote": F.lit(None).cast("string"), "named": named})
    q = Q.geographic_stage("sa2_code", "sa3_code", "sa4_code", "named", "lon", "lat", "score", F.lit(None), ["segment", "remote"])
    parts = [r(q[f"geographic_{n}"]).alias(f"geographic_{n}") for n in ("completeness", "accuracy", "overall_quality")]
    return d.select("area_id", *parts, F.array_join(q["geographic_quality_flags"], ",").alias("flags"))


_GATE = with_sql(AREAS, "b AS (SELECT count(*) AS rows, count(*) FILTER (WHERE balance < 0 OR balance > 9900) AS a, count(*) FILTER (WHERE score IS NULL) AS c, count(score) AS k FROM areas)")


@query("quality_gate", "2.14-18", sql=_GATE + """
SELECT mode, rows, 50.0::DOUBLE AS quality_score, round((3 + k / rows::DOUBLE) / 4 * 100, 8) AS completeness_score, floor(rows / 2.0)::BIGINT AS passed_records, gate
FROM b, (VALUES ('strict', 'failed'), ('permissive', 'passed'), ('selective', 'passed_with_warnings')) v(mode, gate)""")
def _(t):
    d = areas(t).select("sa2_code", "balance", "score", "lat")
    rules = [Q.outside("balance", 0, 9900), Q.empty("score"), Q.not_matching("sa2_code", r"^\d{9}$"), Q.empty("sa2_code")]
    parts = [Q.stage_metrics(d, rules, ["sa2_code_pattern"], mode=m).withColumn("mode", F.lit(m)) for m in ("strict", "permissive", "selective")]
    return S.stack(*parts).withColumns({"quality_score": r(F.col("quality_score")), "completeness_score": r(F.col("completeness_score"))})


@query("model_validation_summary", "2.14-19", sql=with_sql(AREAS, """
x AS (SELECT *, balance < 0 OR balance > 9900 AS e, NOT regexp_full_match(sa2_code, '[12][0-9]{8}') AS w1, lat < -43 OR lat > -12 AS w2 FROM areas)""") + """
SELECT count(*) AS rows, count(*) FILTER (WHERE NOT e) AS valid, count(*) FILTER (WHERE e) AS invalid, count(*) FILTER (WHERE w1 OR w2) AS warned,
  round((count(*) FILTER (WHERE NOT e))::DOUBLE / count(*), 8) AS success_rate FROM x""")
def _(t):
    s, _top = Q.model_summary(areas(t), "area_id", area_rules())
    return s.withColumn("success_rate", r(F.col("success_rate")))


@query("commonest_rules", "2.14-19", "2.5-21", sql=with_sql(AREAS, _FOUND) + "SELECT rule_id, count(*) AS n FROM v GROUP BY 1 ORDER BY n DESC, rule_id LIMIT 10")
def _(t):
    return Q.model_summary(areas(t), "area_id", area_rules())[1]


@query("validation_summary", "2.5-21", sql=with_sql(AREAS, _FOUND) + """
SELECT count(*) AS validations, count(*) FILTER (WHERE severity = 'ERROR') AS errors, count(*) FILTER (WHERE severity = 'WARNING') AS warnings,
  count(*) FILTER (WHERE severity = 'INFO') AS infos, count(DISTINCT area_id) AS affected, round(1 - (count(*) FILTER (WHERE severity = 'ERROR'))::DOUBLE / count(*), 8) AS success_rate FROM v""")
def _(t):
    s = Q.summary(Q.violations(areas(t), "area_id", area_rules()), "area_id", F.lit(0))
    return s.drop("rows").withColumn("success_rate", r(F.col("success_rate")))


@query("dimension_scores", "2.5-21", sql=with_sql(AREAS, _FOUND, """
d AS (SELECT dimension, count(*) FILTER (WHERE severity = 'ERROR') AS errors, count(*) FILTER (WHERE severity = 'WARNING') AS warnings FROM v GROUP BY 1),
s AS (SELECT *, greatest(0, 1 - (2 * errors + warnings) / (SELECT count(*) FROM areas)::DOUBLE) AS score FROM d),
o AS (SELECT sum(score * CASE dimension WHEN 'completeness' THEN 0.3 ELSE 0.15 END) / sum(CASE dimension WHEN 'completeness' THEN 0.3 ELSE 0.15 END) AS overall FROM s)""") + """
SELECT dimension, errors, warnings, round(score, 8) AS score, round(overall, 8) AS overall,
  CASE WHEN overall >= 0.95 THEN 'EXCELLENT' WHEN overall >= 0.85 THEN 'GOOD' WHEN overall >= 0.7 THEN 'ACCEPTABLE' WHEN overall >= 0.5 THEN 'POOR' ELSE 'CRITICAL' END AS grade FROM s, o""")
def _(t):
    from zonalis.operators.common import attach_row
    a = areas(t)
    s = Q.dimension_scores(Q.violations(a, "area_id", area_rules()), a.agg(F.count(F.lit(1)).alias("rows"))).drop("rows")
    out = attach_row(s, Q.overall_from_dimensions(s))
    return out.withColumns({"score": r(F.col("score")), "overall": r(F.col("overall"))})


@query("validations_per_hour", "2.5-21", sql="SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00') AS hour, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def _(t):
    return Q.counts_per_hour(t.events.filter("event_type = 'error'"), "ts")


@query("schema_integrity", "2.14-20", sql="""
SELECT 'temperature_order' AS rule_id, count(*) FILTER (WHERE l_quantity - 10 > l_linenumber * 6) AS breaches FROM lineitem UNION ALL SELECT 'sunshine_hours', count(*) FILTER (WHERE l_quantity > 16) FROM lineitem
UNION ALL SELECT 'decile_range', count(*) FILTER (WHERE l_linenumber * 2 > 10) FROM lineitem UNION ALL SELECT 'score_range', count(*) FILTER (WHERE NOT l_quantity * 50 BETWEEN 1 AND 2000) FROM lineitem
UNION ALL SELECT 'age_at_death', count(*) FILTER (WHERE l_quantity * 3 > 120) FROM lineitem UNION ALL SELECT 'registration_gap', count(*) FILTER (WHERE abs(year(l_shipdate) - 1997) > 3) FROM lineitem
UNION ALL SELECT 'interval_holds_value', count(*) FILTER (WHERE NOT l_quantity BETWEEN 5 AND 45) FROM lineitem UNION ALL SELECT 'sex_total', count(*) FILTER (WHERE abs(2 * l_linenumber - l_quantity) > 3) FROM lineitem""")
def _(t):
    q = F.col("l_quantity")
    d = t.lineitem.select(
        (q - 10).alias("min_temperature"), (F.col("l_linenumber") * 6).alias("max_temperature"), q.alias("sunshine_hours"), (F.col("l_linenumber") * 2).alias("decile"), (q * 50).alias("score"),
        (q * 3).alias("age_at_death"), F.year("l_shipdate").alias("death_year"), F.lit(1997).alias("registration_year"), q.alias("value"), F.lit(5).alias("confidence_lower"),
        F.lit(45).alias("confidence_upper"), F.col("l_linenumber").alias("males"), F.col("l_linenumber").alias("females"), q.alias("total_population"))
    rules = [x for k in ("weather", "seifa", "mortality", "health", "census") for x in Q.schema_integrity_rules(k, d.columns)]
    return Q.rule_counts(d, rules).select("rule_id", "breaches")


@query("standards_compliance", "2.14-21", sql=with_sql(AREAS) + """
SELECT round(avg((score IS NOT NULL)::INT), 8) AS reporting, avg(regexp_full_match(sa2_code, '[0-9]{9}')::INT) AS geography,
  round((avg((score IS NOT NULL)::INT) + avg(regexp_full_match(sa2_code, '[0-9]{9}')::INT)) / 2 * 100, 8) AS score FROM areas""")
def _(t):
    s = Q.compliance(areas(t), "sa2_code", "score")
    return s.withColumns({"reporting": r(F.col("reporting")), "score": r(F.col("score"))})


@query("standard_field_gaps", "2.14-22", sql=with_sql(AREAS) + """
SELECT r_name AS standard, 'score' AS field, round((SELECT count(score) / count(*)::DOUBLE FROM areas), 8) AS share, 0.5 + r_regionkey * 0.12 AS required_share,
  (SELECT count(score) / count(*)::DOUBLE FROM areas) >= 0.5 + r_regionkey * 0.12 AS met FROM region UNION ALL SELECT r_name, 'absent', 0, 0.1, false FROM region""")
def _(t):
    st = t.region.select(F.col("r_name").alias("standard"), F.lit("score").alias("field"), (0.5 + F.col("r_regionkey") * 0.12).alias("required_share")).unionByName(
        t.region.select(F.col("r_name").alias("standard"), F.lit("absent").alias("field"), F.lit(0.1).alias("required_share")))
    return Q.standard_gaps(areas(t), st).withColumn("share", r(F.col("share")))


@query("geographic_stage_score", "2.14-23", sql=with_sql(AREAS, "x AS (SELECT CASE WHEN score IS NOT NULL THEN sa2_code END AS code, segment FROM areas)") + """
SELECT count(*) AS rows, count(*) FILTER (WHERE code LIKE '5%') AS errors, round((1 - (count(*) FILTER (WHERE code LIKE '5%'))::DOUBLE / count(*)) * 100, 8) AS quality_score,
  round((count(code) + count(segment)) / (2.0 * count(*)) * 100, 8) AS completeness_score, round(count(code) * 100.0 / count(*), 8) AS accuracy_score, 'failed' AS status FROM x""")
def _(t):
    d = areas(t).select(F.when(F.col("score").isNotNull(), F.col("sa2_code")).alias("code"), "segment")
    s = Q.geographic_score(d, "code", "segment", [Q.not_matching("code", "^[1-4]")])
    return s.withColumns({c: r(F.col(c)) for c in ("quality_score", "completeness_score", "accuracy_score")})


@query("metric_alerts", "2.17-04", sql="""
SELECT event_id, event_type, value, CASE event_type WHEN 'error' THEN 30.0 ELSE 50.0 END AS threshold FROM events
WHERE (event_type = 'error' AND value > 30) OR (event_type = 'purchase' AND value > 50)""")
def _(t):
    return Q.metric_alerts(t.events.select("event_id", "event_type", "value"), "event_type", "value", {"error": 30, "purchase": 50})


@query("age_sum_warnings", "2.14-09", sql=with_sql(AGES) + "SELECT 'age_sum' AS rule_id, count(*) FILTER (WHERE abs(" + " + ".join(AGE_COLUMNS) + " - total_population - area_id % 9) > 5) AS breaches FROM ages")
def _(t):
    d = ages(t).withColumn("total_population", F.col("total_population") + F.col("area_id") % 9)
    return Q.census_warning_counts(d).select("rule_id", "breaches")
