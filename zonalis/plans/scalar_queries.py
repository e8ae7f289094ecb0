"""Text, code, date, ratio and coordinate expressions over whole tables."""

from pyspark.sql import functions as F

from zonalis.functions import codes, geo, ratios
from zonalis.functions import fixed_values as V
from zonalis.plans.frames import AGE_COLUMNS, AGES, AREAS, HOUSING, LABOUR, ages, areas, housing, labour, r, with_sql
from zonalis.plans.registry import query


def case(pairs, default="NULL"):
    return "CASE " + " ".join(f"WHEN {p} THEN {v}" for p, v in pairs) + f" ELSE {default} END"


def q(text):
    return "'" + text.replace("'", "''") + "'"


@query("text_clean", "2.9-01", sql="""
SELECT doc_id, trim(replace(replace(replace(text, chr(13), ' '), chr(10), ' '), '"', '''')) AS cleaned,
       upper(lang) AS lang_upper, lower(trim(source)) AS source_lower FROM documents""")
def _(t):
    return t.documents.select(
        "doc_id", codes.clean_text(F.col("text")).alias("cleaned"),
        F.upper("lang").alias("lang_upper"), F.lower(F.trim("source")).alias("source_lower"))


_AGE_TEXT = "CASE WHEN p_size > 48 THEN 'All Ages' WHEN p_size > 46 THEN 'Over 85+' WHEN p_size > 24 THEN " \
    "'Ages ' || (p_size - p_size % 10 + 5) || '-' || (p_size - p_size % 10 + 14) ELSE " \
    "'AGED ' || (p_size - p_size % 5) || '-' || (p_size - p_size % 5 + 4) || ' years' END"


@query("age_group_standard", "2.9-02", sql=f"""
WITH x AS (SELECT p_partkey, {_AGE_TEXT} AS raw FROM part)
SELECT p_partkey, raw, """ + case(
    [(f"regexp_matches(lower(raw), '(^|[^0-9]){b.replace('+', '[+]')}{'' if b.endswith('+') else '([^0-9]|$)'}')", q(b))
     for b in V.AGE_BANDS] + [("contains(lower(raw), 'all ages')", "'all_ages'")], "lower(trim(raw))") + " AS age_group FROM x")
def _(t):
    return t.part.select("p_partkey", F.expr(_AGE_TEXT).alias("raw")).withColumn(
        "age_group", codes.standard_age_group(F.col("raw")))


@query("sex_standard", "2.9-03", sql="""
SELECT c_custkey, CASE WHEN c_mktsegment LIKE 'M%' THEN 'Male' WHEN c_mktsegment LIKE 'F%' THEN 'Female'
  ELSE 'Persons' END AS sex FROM customer""")
def _(t):
    return t.customer.select("c_custkey", codes.standard_sex(
        F.concat(F.lit(" "), F.substring("c_mktsegment", 1, 1), F.lit(" "))).alias("sex"))


@query("parent_codes", "2.9-04", sql=with_sql(AREAS) + """
SELECT sa2_code, CASE WHEN length(sa2_code) IN (9, 11) THEN substr(sa2_code, 1, 5) END AS sa3,
  CASE WHEN length(sa2_code) IN (9, 11) THEN substr(sa2_code, 1, 3) END AS sa4,
  CASE WHEN length(sa2_code) IN (9, 11) THEN substr(sa2_code, 1, 1) END AS state_digit FROM areas""")
def _(t):
    c = F.col("sa2_code")
    return areas(t).select(
        c, codes.parent_code(c, "SA3").alias("sa3"), codes.parent_code(c, "SA4").alias("sa4"),
        codes.parent_code(c, "STATE").alias("state_digit"))


@query("code_checks", "2.9-05", sql=with_sql(AREAS) + """
SELECT sa2_code, regexp_full_match(sa2_code, '[0-9]{9}') AND substr(sa2_code,1,1) BETWEEN '1' AND '9' AS sa2_ok,
  length(sa2_code) = 9 AND starts_with(sa2_code, sa3_code) AS in_sa3,
  length(sa2_code) = 9 AND starts_with(sa2_code, '3' || substr(sa4_code, 2)) AS in_moved_sa4,
  lpad(area_id::VARCHAR, 9, '0') AS padded FROM areas""")
def _(t):
    c = F.col("sa2_code")
    return areas(t).select(
        c, codes.valid_code(c, "SA2").alias("sa2_ok"),
        codes.contained(c, "SA2", F.col("sa3_code"), "SA3").alias("in_sa3"),
        codes.contained(c, "SA2", F.concat(F.lit("3"), F.substring("sa4_code", 2, 2)), "SA4").alias("in_moved_sa4"),
        F.lpad(F.col("area_id").cast("string"), 9, "0").alias("padded"))


@query("state_of_code", "2.9-06", sql=with_sql(AREAS) + "SELECT sa2_code, " + case(
    [(f"substr(sa2_code,1,1) = '{k}'", q(v)) for k, v in V.STATES.items()], "'OT'") + " AS state_abbr FROM areas")
def _(t):
    return areas(t).select("sa2_code", codes.state_of_code(F.col("sa2_code")).alias("state_abbr"))


@query("level_of_modal_length", "2.9-07", sql=with_sql(AREAS) + """
SELECT mode(length(sa2_code))::INTEGER AS modal_length,
  CASE mode(length(sa2_code)) WHEN 6 THEN 'SA3' WHEN 3 THEN 'SA4' ELSE 'SA2' END AS geographic_level FROM areas""")
def _(t):
    n = areas(t).agg(F.mode(F.length("sa2_code"), True).alias("modal_length"))
    return n.withColumn("geographic_level", codes.level_of_length(F.col("modal_length")))


_PC = case([(" OR ".join(f"pc BETWEEN {a} AND {b}" for a, b in rs), q(s)) for s, rs in V.POSTCODES.items()])


@query("postcode_state", "2.9-08", sql=with_sql(AREAS, f"""
p AS (SELECT area_id, (area_id * 37) % 10400 AS pc, state_code FROM areas), s AS (
SELECT area_id, pc, state_code, CASE WHEN pc <= 9999 THEN {_PC} END AS pc_state FROM p)""") + """
SELECT area_id, lpad(pc::VARCHAR, CASE WHEN pc > 9999 THEN 5 ELSE 4 END, '0') AS postcode, pc_state,
  CASE WHEN pc > 9999 THEN 'invalid_format' WHEN pc_state IS NULL THEN 'unknown_postcode'
    WHEN pc_state <> """ + case([(f"state_code = '{k}'", q(v)) for k, v in V.STATES.items()]) + """
    THEN 'state_mismatch' END AS problem FROM s""")
def _(t):
    a = areas(t).withColumn("pc", (F.col("area_id") * 37) % 10400)
    pc = F.col("pc")
    return a.select(
        "area_id", codes.padded_postcode(pc).alias("postcode"), codes.postcode_state(pc).alias("pc_state"),
        codes.postcode_problem(pc, codes.state_of_code(F.col("state_code"))).alias("problem"))


_ST = case([(f"lon BETWEEN {b[0]} AND {b[1]} AND lat BETWEEN {b[2]} AND {b[3]}", q(s))
            for s, b in V.STATE_BOUNDS.items()])


@query("state_of_point", "2.9-09", "2.9-10", sql=with_sql(AREAS, f"s AS (SELECT area_id, {_ST} AS point_state FROM areas)")
       + "SELECT area_id, point_state, " + case([(f"point_state = '{k}'", q(v)) for k, v in V.TIME_ZONES.items()],
                                                 "'Australia/Sydney'") + " AS time_zone FROM s")
def _(t):
    s = areas(t).select("area_id", geo.state_of_point(F.col("lon"), F.col("lat")).alias("point_state"))
    return s.withColumn("time_zone", codes.time_zone(F.col("point_state")))


@query("decimal_places", "2.9-11", sql="""
SELECT c_custkey, greatest(length(x), 1)::INTEGER AS places, length(x) >= 2 AS enough
FROM (SELECT c_custkey, regexp_extract(rtrim(printf('%.6f', c_acctbal), '0'), '[.]([0-9]*)', 1) AS x FROM customer)""")
def _(t):
    p = codes.decimal_places(F.col("c_acctbal"))
    return t.customer.select("c_custkey", p.alias("places"), (p >= 2).alias("enough"))


_ICD = "chr((65 + p_partkey % 26)::INTEGER) || printf('%02d', (p_partkey * 7) % 100) || CASE WHEN p_size > 25 THEN '.' || (p_size % 10) ELSE '' END"


@query("icd10_chapter", "2.9-12", sql=f"""
WITH x AS (SELECT p_partkey, CASE WHEN p_size = 50 THEN lower({_ICD}) ELSE {_ICD} END AS icd10 FROM part)
SELECT p_partkey, icd10, regexp_full_match(icd10, '[A-Z][0-9]{{2}}([.][0-9]{{1,2}})?') AS icd10_ok, """
       + case([(f"regexp_matches(icd10, '^{p}')", q(v)) for p, v in V.ICD_CHAPTERS], "'Other causes'")
       + " AS chapter FROM x")
def _(t):
    code = F.concat(
        F.chr(65 + F.col("p_partkey") % 26), F.format_string("%02d", (F.col("p_partkey") * 7) % 100),
        F.when(F.col("p_size") > 25, F.concat(F.lit("."), (F.col("p_size") % 10).cast("string"))).otherwise(""))
    x = t.part.select("p_partkey", F.when(F.col("p_size") == 50, F.lower(code)).otherwise(code).alias("icd10"))
    return x.select("*", codes.valid_icd10(F.col("icd10")).alias("icd10_ok"),
                    codes.icd10_chapter(F.col("icd10")).alias("chapter"))


@query("age_band_5", "2.9-13", sql="""
SELECT p_partkey, CASE WHEN age < 1 THEN '0' WHEN age < 5 THEN '1-4' WHEN age >= 85 THEN '85+'
  ELSE (age // 5 * 5) || '-' || (age // 5 * 5 + 4) END AS band
FROM (SELECT p_partkey, (p_partkey * 13) % 100 AS age FROM part)""")
def _(t):
    return t.part.select("p_partkey", codes.age_band_5((F.col("p_partkey") * 13) % 100).alias("band"))


_PLACE = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Metropolitan Ring' WHEN 'BUILDING' THEN 'New Town' " \
         "WHEN 'MACHINERY' THEN 'Farming Belt' WHEN 'HOUSEHOLD' THEN 'Harbour City' ELSE c_mktsegment END"


@query("urbanisation_and_remoteness", "2.9-14", "2.9-15", sql=with_sql(AREAS) + f"""
SELECT c_custkey, CASE WHEN regexp_matches(lower({_PLACE}), 'city|urban|metropolitan') THEN 'major_urban'
   WHEN contains(lower({_PLACE}), 'town') THEN 'other_urban'
   WHEN regexp_matches(lower({_PLACE}), 'rural|farming|agricultural') THEN 'rural_balance' ELSE 'other_urban' END AS urbanisation,
  CASE WHEN state_code IN ('1','2') THEN 'Major Cities of Australia' WHEN state_code IN ('5','7')
    THEN 'Very Remote Australia' ELSE 'Inner Regional Australia' END AS remoteness
FROM customer JOIN areas ON c_custkey = area_id""")
def _(t):
    a = areas(t).withColumnsRenamed({"segment": "c_mktsegment", "area_id": "c_custkey"})
    return a.select("c_custkey", codes.urbanisation_by_name(F.expr(_PLACE)).alias("urbanisation"),
                    codes.remoteness_by_state(F.col("state_code")).alias("remoteness"))


@query("indicator_codes", "2.9-16", sql="""
SELECT p_partkey, 'MORT_' || upper(replace(p_name, ' ', '_')) AS mortality_code,
  'MEDICARE_' || upper(replace(p_type, ' ', '_')) AS service_code FROM part""")
def _(t):
    return t.part.select("p_partkey", codes.indicator_code("MORT", F.col("p_name")).alias("mortality_code"),
                         codes.indicator_code("MEDICARE", F.col("p_type")).alias("service_code"))


@query("dates_in_two_formats", "2.9-17", sql="""
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed,
  CASE WHEN o_orderpriority <> '5-LOW' THEN date_diff('day', o_orderdate::DATE, DATE '2002-01-01')::DOUBLE END AS age_days,
  CASE WHEN o_orderpriority <> '5-LOW' THEN round(date_diff('day', o_orderdate::DATE, DATE '2002-01-01') / 30.44, 8) END AS age_months
FROM orders""")
def _(t):
    text = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("not a date"))
            .when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "dd/MM/yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    d = codes.parse_date(text)
    days = codes.age_days(d, F.lit("2002-01-01").cast("date"))
    return t.orders.select("o_orderkey", F.date_format(d, "yyyy-MM-dd").alias("parsed"),
                           days.cast("double").alias("age_days"), F.round(days / 30.44, 8).alias("age_months"))


@query("iso_timestamps", "2.9-18", sql="SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def _(t):
    return t.events.select("event_id", codes.iso_timestamp(F.col("ts")).alias("iso"))


def _pct_sql(num, den, name, scale=100):
    return f"round(CASE WHEN {den} > 0 THEN ({num})::DOUBLE / {den} * {scale} ELSE 0 END, 8) AS {name}"


_WORK = ["age_15_19", "age_20_24", "age_25_29", "age_30_34", "age_35_39", "age_40_44", "age_45_49",
         "age_50_54", "age_55_59", "age_60_64"]
_YOUNG = ["age_0_4", "age_5_9", "age_10_14"]
_OLD = ["age_65_69", "age_70_74", "age_75_79", "age_80_84", "age_85_plus"]


@query("guarded_ratios", "2.10-01", "2.10-02", sql=with_sql(AGES, f"""
s AS (SELECT *, {' + '.join(_WORK)} AS work, {' + '.join(_YOUNG)} AS young, {' + '.join(_OLD)} AS old FROM ages)""")
       + "SELECT area_id, work, young, old, " + ", ".join([
           _pct_sql("young + old", "work", "dependency_ratio"), _pct_sql("males", "females", "sex_ratio"),
           _pct_sql("young", "work", "child_ratio"), _pct_sql("old", "work", "elderly_ratio")]) + " FROM s")
def _(t):
    s = ages(t).withColumns({"work": ratios.row_sum(_WORK), "young": ratios.row_sum(_YOUNG), "old": ratios.row_sum(_OLD)})
    return s.select(
        "area_id", "work", "young", "old",
        r(ratios.pct(F.col("young") + F.col("old"), "work")).alias("dependency_ratio"),
        r(ratios.pct("males", "females")).alias("sex_ratio"), r(ratios.pct("young", "work")).alias("child_ratio"),
        r(ratios.pct("old", "work")).alias("elderly_ratio"))


@query("mean_age_deviation", "2.10-03", sql=with_sql(AGES) + "SELECT area_id, round(CASE WHEN total_population > 0 THEN ("
       + " + ".join(f"{c} * {m}" for c, m in V.AGE_MIDPOINTS.items())
       + ") / (" + " + ".join(AGE_COLUMNS) + ") ELSE 0 END - 38.4, 8) AS deviation FROM ages")
def _(t):
    a = ages(t)
    return a.select("area_id", r(ratios.mean_age_deviation(a.columns)).alias("deviation"))


_IND = ["indigenous", "non_indigenous", "indigenous_not_stated"]
_OCC = ["managers", "professionals", "technicians_trades", "clerical_administrative", "labourers"]


@query("diversity_simpson", "2.10-04", sql=with_sql(AGES) + """
SELECT area_id, round(1 - (pow(indigenous / n, 2) + pow(non_indigenous / n, 2) + pow(indigenous_not_stated / n, 2)), 8)
  AS diversity FROM (SELECT *, (indigenous + non_indigenous + indigenous_not_stated)::DOUBLE AS n FROM ages)""")
def _(t):
    return ages(t).select("area_id", r(ratios.simpson(_IND)).alias("diversity"))


@query("diversity_shannon", "2.10-05", "2.17-03", sql=with_sql(LABOUR, f"s AS (SELECT *, ({' + '.join(_OCC)})::DOUBLE AS n FROM labour)")
       + "SELECT area_id, round(-(" + " + ".join(
           f"CASE WHEN {c} > 0 THEN {c} / n * ln({c} / n) ELSE 0 END" for c in _OCC) + ") / ln(5), 8) + 0.0 AS diversity FROM s")
def _(t):
    return labour(t).select("area_id", r(ratios.shannon(_OCC)).alias("diversity"))


@query("skill_imbalance", "2.10-06", sql=with_sql(LABOUR, """
l AS (SELECT area_id, unnest([managers + professionals, technicians_trades + clerical_administrative, labourers]) AS x FROM labour),
g AS (SELECT area_id, count(x) FILTER (WHERE x > 0) AS k, stddev_pop(x) FILTER (WHERE x > 0) AS s, avg(x) FILTER (WHERE x > 0) AS m
      FROM l GROUP BY area_id)""") + """
SELECT area_id, round(CASE WHEN k < 2 THEN 0 ELSE least(s / m * 100, 100) END, 8) AS imbalance FROM g""")
def _(t):
    levels = [F.col("managers") + F.col("professionals"),
              F.col("technicians_trades") + F.col("clerical_administrative"), F.col("labourers")]
    return labour(t).select("area_id", r(ratios.skill_imbalance(levels)).alias("imbalance"))


@query("rent_and_mortgage", "2.10-09", "2.10-10", sql=with_sql(HOUSING, """
h AS (SELECT area_id, median_rent_weekly AS w, median_mortgage_monthly AS m, median_rent_weekly * 4.33 / median_mortgage_monthly AS ratio FROM housing)""") + """
SELECT area_id, round(w * 4.33, 8) AS rent_monthly, round(ratio, 8) AS ratio,
  CASE WHEN ratio > 0.7 THEN 'Low Purchase Affordability' WHEN ratio > 0.5 THEN 'Moderate Purchase Affordability'
    ELSE 'High Purchase Affordability' END AS affordability,
  CASE WHEN m <= 1500 THEN 'Under $1,500' WHEN m <= 2500 THEN '$1,500-$2,500' WHEN m <= 3500 THEN '$2,500-$3,500'
    WHEN m <= 5000 THEN '$3,500-$5,000' ELSE 'Over $5,000' END AS mortgage_range,
  CASE WHEN w <= 300 THEN 'Under $300' WHEN w <= 500 THEN '$300-$500' WHEN w <= 700 THEN '$500-$700'
    WHEN w <= 1000 THEN '$700-$1,000' ELSE 'Over $1,000' END AS rent_range FROM h""")
def _(t):
    w = ratios.positive_or_null(F.col("median_rent_weekly"))
    m = ratios.positive_or_null(F.col("median_mortgage_monthly"))
    ratio = ratios.monthly_rent(w) / m
    return housing(t).select(
        "area_id", r(ratios.monthly_rent(w)).alias("rent_monthly"), r(ratio).alias("ratio"),
        ratios.affordability(ratio).alias("affordability"),
        ratios.right_closed_bin(m, ratios.MORTGAGE_RANGES).alias("mortgage_range"),
        ratios.right_closed_bin(w, ratios.RENT_RANGES).alias("rent_range"))


@query("min_max_normalise", "2.10-12", sql="""
SELECT c_custkey, round(least(greatest(c_acctbal, 0), 5000) / 5000 * 100, 8) AS plain,
  round(100 - least(greatest(c_acctbal, 300), 700) / 400 * 100 + 75, 8) AS inverse_corrected,
  round(100 - (least(greatest(c_acctbal, 300), 700) - 700) / (-400) * 100, 8) + 0.0 AS inverse_as_coded FROM customer""")
def _(t):
    c = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", r(ratios.normalise(c, 0, 5000)).alias("plain"),
        r(ratios.normalise(c, 700, 300, inverse=True)).alias("inverse_corrected"),
        r(ratios.normalise(c, 700, 300, inverse=True, as_coded=True)).alias("inverse_as_coded"))


_STD_BANDS = {"age_0_4": ["age_0_4"], "age_5_14": ["age_5_9", "age_10_14"], "age_15_24": ["age_15_19", "age_20_24"],
              "age_25_44": ["age_25_29", "age_30_34", "age_35_39", "age_40_44"],
              "age_45_64": ["age_45_49", "age_50_54", "age_55_59", "age_60_64"], "age_65_plus": _OLD}


@query("age_standardised_rate", "2.10-13", sql=with_sql(AGES, """
x AS (SELECT *, 1000.0 * indigenous / total_population AS overall FROM ages)""") + "SELECT area_id, round((" + " + ".join(
    f"CASE WHEN {' + '.join(cs)} > 0 THEN overall * {V.AGE_RATE_MULTIPLIER[b]} * {V.STANDARD_POPULATION[b]} ELSE 0 END"
    for b, cs in _STD_BANDS.items()) + ") / (" + " + ".join(
    f"CASE WHEN {' + '.join(cs)} > 0 THEN {float(V.STANDARD_POPULATION[b])} ELSE 0 END" for b, cs in _STD_BANDS.items())
    + "), 8) AS asr FROM x")
def _(t):
    pops = {b: ratios.row_sum(cs) for b, cs in _STD_BANDS.items()}
    overall = F.lit(1000.0) * F.col("indigenous") / F.col("total_population")
    rates = ratios.age_specific_rates(overall, pops)
    return ages(t).select("area_id", r(ratios.age_standardised_rate(rates)).alias("asr"))


@query("weather_formulas", "2.10-14", sql="""
SELECT l_orderkey, l_linenumber, round(CASE WHEN t >= 27 THEN -42.379 + 2.04901523*t + 10.14333127*h - 0.22475541*t*h
   - 6.83783e-3*t*t - 5.481717e-2*h*h + 1.22874e-3*t*t*h + 8.5282e-4*t*h*h - 1.99e-6*t*t*h*h END, 6) AS heat_index,
  round(CASE WHEN e > 0 THEN p / (e * 30) END, 10) AS aridity, t - h / 10 AS temperature_range
FROM (SELECT *, l_quantity AS t, l_discount * 1000 AS h, l_tax * 100 AS e, l_extendedprice / 100 AS p FROM lineitem)""")
def _(t):
    x = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("t"), (F.col("l_discount") * 1000).alias("h"),
        (F.col("l_tax") * 100).alias("e"), (F.col("l_extendedprice") / 100).alias("p"))
    return x.select("l_orderkey", "l_linenumber", r(ratios.heat_index(F.col("t"), F.col("h")), 6).alias("heat_index"),
                    r(ratios.aridity(F.col("p"), F.col("e")), 10).alias("aridity"),
                    (F.col("t") - F.col("h") / 10).alias("temperature_range"))


@query("cause_specific_rates", "2.10-15", sql=with_sql(LABOUR) + "SELECT area_id, "
       + _pct_sql("unemployed", "labour_force_pop", "rate_per_100k", 100000) + ", "
       + _pct_sql("unemployed", "people", "proportional_pct") + " FROM labour")
def _(t):
    return labour(t).select("area_id", r(ratios.pct("unemployed", "labour_force_pop", 1e5)).alias("rate_per_100k"),
                            r(ratios.pct("unemployed", "people")).alias("proportional_pct"))


@query("compactness", "2.10-16", sql="""
SELECT p_partkey, round(4 * pi() * p_size / (p_retailprice * p_retailprice) * 10000, 8) AS compactness_e4 FROM part""")
def _(t):
    return t.part.select("p_partkey", r(ratios.compactness(F.col("p_size"), F.col("p_retailprice")) * 10000).alias("compactness_e4"))


_HAV = "sqrt(pow(sin(radians(lat + 33.8688) / 2), 2) + cos(radians(-33.8688)) * cos(radians(lat)) * pow(sin(radians(lon - 151.2093) / 2), 2))"


@query("distances_to_sydney", "2.10-17", "2.10-18", sql=with_sql(AREAS, f"d AS (SELECT area_id, lat, lon, {_HAV} AS h FROM areas)") + """
SELECT area_id, round(2 * 6371.0 * asin(h), 8) AS haversine, round(2 * 6378.137 * atan2(h, sqrt(1 - h * h)), 8) AS great_circle,
  round(sqrt(pow((lon - 151.2093) * 111.32 * cos(radians((lat - 33.8688) / 2)), 2) + pow((lat + 33.8688) * 110.54, 2)), 8) AS planar,
  2 * 6371.0 * asin(h) <= 1000 AS within_1000,
  round((degrees(atan2(sin(radians(lon - 151.2093)) * cos(radians(lat)), cos(radians(-33.8688)) * sin(radians(lat))
     - sin(radians(-33.8688)) * cos(radians(lat)) * cos(radians(lon - 151.2093)))) + 360) % 360, 8) AS bearing FROM d""")
def _(t):
    lat0, lon0, lat, lon = F.lit(-33.8688), F.lit(151.2093), F.col("lat"), F.col("lon")
    km = geo.haversine_km(lat0, lon0, lat, lon)
    return areas(t).select(
        "area_id", r(km).alias("haversine"), r(geo.great_circle_km(lat0, lon0, lat, lon)).alias("great_circle"),
        r(geo.planar_km(lon0, lat0, lon, lat)).alias("planar"), (km <= 1000).alias("within_1000"),
        r(geo.bearing_degrees(lat0, lon0, lat, lon)).alias("bearing"))


_SYS = "CASE segment WHEN 'AUTOMOBILE' THEN 'gda94' WHEN 'BUILDING' THEN 'AGD66' WHEN 'MACHINERY' THEN 'WGS84' " \
       "WHEN 'HOUSEHOLD' THEN 'MGA_ZONE_54' ELSE 'UTM' END"


@query("datum_shift", "2.10-19", sql=with_sql(AREAS, f"""
x AS (SELECT area_id, lat, lon, upper({_SYS}) AS sys, floor((lon - 114) / 6) + 49 AS zone FROM areas)""") + """
SELECT area_id, round(CASE sys WHEN 'GDA94' THEN lon + 0.06155/111000.0 WHEN 'AGD66' THEN lon + 0.00013 WHEN 'WGS84' THEN lon
    WHEN 'MGA_ZONE_54' THEN CASE WHEN zone = 54 THEN lon END END, 9) AS lon_2020,
  round(CASE sys WHEN 'GDA94' THEN lat - 0.01087/111000.0 WHEN 'AGD66' THEN lat - 0.00008 WHEN 'WGS84' THEN lat
    WHEN 'MGA_ZONE_54' THEN CASE WHEN zone = 54 THEN lat END END, 9) AS lat_2020,
  CASE WHEN sys IN ('GDA94','AGD66','WGS84') OR (sys = 'MGA_ZONE_54' AND zone = 54) THEN NULL ELSE 'unsupported_system' END AS error FROM x""")
def _(t):
    lon, lat, err = geo.to_gda2020_approx(F.col("lon"), F.col("lat"), F.expr(_SYS))
    return areas(t).select("area_id", F.round(lon, 9).alias("lon_2020"), F.round(lat, 9).alias("lat_2020"), err.alias("error"))


@query("mga_zone", "2.10-20", sql=with_sql(AREAS) + """
SELECT area_id, (CASE WHEN lon >= 156 THEN 56 WHEN lon >= 114 THEN 49 + floor((lon - 114) / 6) END)::DOUBLE AS zone FROM areas""")
def _(t):
    return areas(t).select("area_id", geo.mga_zone(F.col("lon"), F.col("lat")).cast("double").alias("zone"))


def _box_sql(name):
    b = V.BOUNDS[name]
    return f"lon BETWEEN {b[0]} AND {b[1]} AND lat BETWEEN {b[2]} AND {b[3]}"


@query("coordinate_bounds", "2.10-21", sql=with_sql(AREAS, "x AS (SELECT area_id, lat, lon + 4 AS lon FROM areas)")
       + "SELECT area_id, " + ", ".join(f"{_box_sql(n)} AS {n}" for n in V.BOUNDS) + " FROM x")
def _(t):
    a = areas(t).withColumn("lon", F.col("lon") + 4)
    return a.select("area_id", *[geo.in_bounds(F.col("lon"), F.col("lat"), b).alias(n) for n, b in V.BOUNDS.items()])


@query("density_classes", "2.10-22", sql="""
SELECT c_custkey, CASE WHEN c_acctbal >= 400 THEN 'major_urban' WHEN c_acctbal >= 100 THEN 'other_urban'
  WHEN c_acctbal >= 10 THEN 'bounded_locality' ELSE 'rural_balance' END AS urbanisation,
  CASE WHEN c_acctbal >= 400 THEN 'Major Cities' WHEN c_acctbal >= 100 THEN 'Inner Regional'
  WHEN c_acctbal >= 10 THEN 'Outer Regional' ELSE 'Remote' END AS remoteness FROM customer""")
def _(t):
    return t.customer.select("c_custkey", geo.density_urbanisation(F.col("c_acctbal")).alias("urbanisation"),
                             geo.density_remoteness(F.col("c_acctbal")).alias("remoteness"))


@query("nearest_major_centre", "2.4-17", sql=with_sql(AREAS, "d AS (SELECT area_id, least(" + ", ".join(
    f"round(sqrt(pow(lat - ({a}), 2) + pow(lon - {b}, 2)) * 111, 1)" for a, b in V.MAJOR_CENTRES.values()) + ") AS km FROM areas)") + """
SELECT area_id, km, round(CASE WHEN km <= 50 THEN 100.0 WHEN km <= 200 THEN 100.0 - (km - 50) / 150 * 50
  ELSE greatest(0.0, 50.0 - (km - 200) / 500 * 50) END, 8) AS accessibility FROM d""")
def _(t):
    km = F.least(*geo.centre_distances(F.col("lat"), F.col("lon")).values())
    d = areas(t).select("area_id", km.alias("km"))
    return d.withColumn("accessibility", r(geo.accessibility_score(F.col("km"))))


@query("small_cell_suppression", "2.3-16", sql=with_sql(LABOUR) + """
SELECT area_id, CASE WHEN unemployed >= 5 THEN unemployed::DOUBLE END AS unemployed, unemployed < 5 AS suppressed,
  CASE WHEN unemployed < 5 THEN '<5' ELSE unemployed::VARCHAR END AS display,
  CASE WHEN unemployed >= 5 THEN labourers::DOUBLE END AS benefits FROM labour""")
def _(t):
    value, hidden, display = codes.small_cell(F.col("unemployed"))
    return labour(t).select("area_id", value.cast("double").alias("unemployed"), hidden.alias("suppressed"), display.alias("display"),
                            F.when(~hidden, F.col("labourers")).cast("double").alias("benefits"))
