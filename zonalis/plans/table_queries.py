"""Mapping, filling, aggregation, ranking, top lists and set operations."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.operators import aggregates as A
from zonalis.operators import impute as I
from zonalis.operators import mapping as M
from zonalis.operators import ranking as R
from zonalis.operators import sets as S
from zonalis.operators.common import attach_row
from zonalis.plans.frames import AREAS, LABOUR, areas, labour, r, with_sql
from zonalis.plans.registry import query
from zonalis.session import scratch_path

# --- mapping and filters -------------------------------------------------


@query("column_mapping", "2.3-02", "2.17-01", sql="""
SELECT p_partkey::VARCHAR AS item_code, lower(p_name) AS item_name, upper(trim(p_brand)) AS maker,
  p_size::DOUBLE AS size_value, TRY_CAST(p_type AS BIGINT)::DOUBLE AS type_number FROM part""")
def _(t):
    return M.apply_mappings(t.part, [
        M.ColumnMapping("p_partkey", "item_code", "string", required=True),
        M.ColumnMapping("p_name", "item_name", "string", "lowercase"),
        M.ColumnMapping("p_brand", "maker", "string", "uppercase"),
        M.ColumnMapping("p_size", "size_value", "float"),
        M.ColumnMapping("p_type", "type_number", "float", "to_int"),
        M.ColumnMapping("not_there", "unused"),
    ])


@query("standard_column_names", "2.3-03", sql="""
SELECT c_custkey AS customer_key, c_name AS full_name, c_acctbal AS account_balance FROM customer""")
def _(t):
    return t.customer.select(F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Full-Name"),
                             F.col("c_acctbal").alias("ACCOUNT BALANCE")).transform(M.standard_names)


@query("candidate_columns", "2.3-04", "2.3-05", sql="""
SELECT s_suppkey AS geographic_id, s_name AS area_name, trunc(s_acctbal)::BIGINT AS total_population,
  0::BIGINT AS males FROM supplier""")
def _(t):
    d = M.resolve_candidates(t.supplier, {
        "geographic_id": ["SA2_CODE", "s_suppkey"], "area_name": ["s_name", "s_nationkey"],
        "total_population": ["Tot_P_P", "s_acctbal"]}, required=["geographic_id"])
    return M.ensure_counts(d, ["total_population", "males"]).select("geographic_id", "area_name", "total_population", "males")


@query("missing_dropped", "2.3-06", sql=with_sql(AREAS) + "SELECT area_id, score FROM areas WHERE score IS NOT NULL")
def _(t):
    return I.drop_missing(areas(t).select("area_id", "score"))


@query("missing_constants", "2.3-07", sql=with_sql(AREAS) + """
SELECT area_id, coalesce(score, 0) AS zero_filled, coalesce(score, -1.5) AS custom_filled FROM areas""")
def _(t):
    d = areas(t).select("area_id", F.col("score").alias("zero_filled"), F.col("score").alias("custom_filled"))
    return I.fill_constant(d, {"zero_filled": 0.0, "custom_filled": -1.5})


@query("missing_statistics", "2.3-08", sql=with_sql(AREAS, """
m AS (SELECT floor(score / 1000) AS k, count(*) AS n FROM areas WHERE score IS NOT NULL GROUP BY 1),
s AS (SELECT avg(score) AS a, median(score) AS b FROM areas),
mo AS (SELECT k FROM m ORDER BY n DESC, k LIMIT 1)""") + """
SELECT area_id, round(coalesce(score, (SELECT a FROM s)), 6) AS by_mean, round(coalesce(score, (SELECT b FROM s)), 6) AS by_median,
  coalesce(floor(score / 1000), (SELECT k FROM mo))::DOUBLE AS by_mode FROM areas""")
def _(t):
    d = areas(t).select("area_id", F.col("score").alias("by_mean"), F.col("score").alias("by_median"),
                        F.floor(F.col("score") / 1000).cast("double").alias("by_mode"))
    d = I.fill_statistic(d, ["by_mean"], "mean")
    d = I.fill_statistic(d, ["by_median"], "median")
    d = I.fill_statistic(d, ["by_mode"], "mode")
    return d.withColumns({"by_mean": r(F.col("by_mean"), 6), "by_median": r(F.col("by_median"), 6)})


@query("missing_carried", "2.3-09", sql=with_sql(AREAS) + """
SELECT area_id, last_value(score IGNORE NULLS) OVER (PARTITION BY state_code ORDER BY area_id) AS forward,
  first_value(score IGNORE NULLS) OVER (PARTITION BY state_code ORDER BY area_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS backward
FROM areas""")
def _(t):
    d = areas(t).select("area_id", "state_code", F.col("score").alias("forward"), F.col("score").alias("backward"))
    d = I.fill_forward(d, "forward", ["area_id"], ["state_code"])
    return I.fill_backward(d, "backward", ["area_id"], ["state_code"]).select("area_id", "forward", "backward")


@query("missing_interpolated", "2.3-10", sql=with_sql(AREAS, """
p AS (SELECT *, row_number() OVER (PARTITION BY state_code ORDER BY area_id) AS rn FROM areas),
k AS (SELECT *, last_value(CASE WHEN score IS NOT NULL THEN rn END IGNORE NULLS) OVER w AS pr,
  last_value(score IGNORE NULLS) OVER w AS pv,
  first_value(CASE WHEN score IS NOT NULL THEN rn END IGNORE NULLS) OVER f AS nr, first_value(score IGNORE NULLS) OVER f AS nv
  FROM p WINDOW w AS (PARTITION BY state_code ORDER BY rn),
  f AS (PARTITION BY state_code ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""") + """
SELECT area_id, round(coalesce(score, pv + (nv - pv) * (rn - pr) / (nr - pr)), 6) AS filled FROM k""")
def _(t):
    d = I.fill_interpolated(areas(t).select("area_id", "state_code", "score"), "score", ["area_id"], ["state_code"])
    return d.select("area_id", r(F.col("score"), 6).alias("filled"))


@query("schema_enforced", "2.3-11", sql="""
SELECT o_orderkey::VARCHAR AS order_code, CASE o_orderstatus WHEN 'F' THEN 1.5 ELSE -1.0 END AS weight, 2021::BIGINT AS census_year,
  substr(o_orderpriority, 1, 1)::BIGINT AS priority FROM orders""")
def _(t):
    d = t.orders.select(F.col("o_orderkey").alias("order_code"),
                        F.when(F.col("o_orderstatus") == "F", "1.5").otherwise("n/a").alias("weight"),
                        F.substring("o_orderpriority", 1, 1).alias("priority"), "o_custkey")
    schema = T.StructType([T.StructField("order_code", T.StringType()), T.StructField("weight", T.DoubleType()),
                           T.StructField("census_year", T.LongType()), T.StructField("priority", T.LongType())])
    return M.enforce_schema(d, schema, {"weight": -1.0, "census_year": 2021})


@query("equality_filters", "2.3-12", sql=with_sql(AREAS) + """
SELECT area_id, sa2_code FROM areas WHERE state_code = '2' AND segment = 'BUILDING'""")
def _(t):
    return M.equals(areas(t), state_code="2", segment="BUILDING").select("area_id", "sa2_code")


@query("point_lookup", "2.3-12", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 1234")
def _(t):
    return M.equals(t.orders, o_orderkey=1234).select("o_orderkey", "o_custkey", "o_totalprice")


@query("distinct_categories", "2.3-13", "2.7-03", sql="SELECT DISTINCT p_type AS category FROM part WHERE p_type IS NOT NULL ORDER BY 1")
def _(t):
    return S.sorted_distinct(t.part.select(F.col("p_type").alias("category")), "category")


@query("page_of_rows", "2.3-14", "2.7-06", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def _(t):
    return M.page(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 50, 100)


@query("page_by_index", "2.3-14", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 40 OFFSET 280")
def _(t):
    path = scratch_path(t.spark, "pages")
    M.write_pages(t.orders.select("o_orderkey", "o_totalprice"), path, ["o_totalprice", "o_orderkey"], 40)
    return M.read_page(t.spark, path, ["o_totalprice", "o_orderkey"], 7)


@query("quality_filter", "2.3-15", sql=with_sql(LABOUR) + """
SELECT area_id, unemployed::DOUBLE / people AS quality FROM labour WHERE unemployed::DOUBLE / people >= 0.5""")
def _(t):
    d = labour(t).select("area_id", (F.col("unemployed") / F.col("people")).alias("quality"))
    return M.quality_filter(d, "quality")


@query("duplicate_rows", "2.3-17", sql="""
SELECT o_custkey, o_orderpriority, count(*) AS copies FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t):
    return M.duplicate_rows(t.orders.select("o_custkey", "o_orderpriority"))


@query("rows_without_duplicates", "2.3-17", sql="SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(t):
    return t.lineitem.select("l_partkey", "l_suppkey").dropDuplicates()


@query("table_rules", "2.3-18", sql="""
WITH g AS (SELECT count(*) AS k FROM events GROUP BY user_id, event_type, value), f AS (SELECT sum(k) AS n, max(k) AS m FROM g)
SELECT 'non_empty' AS rule, n > 0 AS passed FROM f UNION ALL SELECT 'no_duplicates', m <= 1 FROM f
UNION ALL SELECT 'min_records:5000', n >= 5000 FROM f""")
def _(t):
    return M.check_rules(t.events.select("user_id", "event_type", "value"), ["non_empty", "no_duplicates", "min_records:5000"])


@query("rules_applied", "2.3-18", sql="SELECT DISTINCT event_type AS kind, user_id FROM events")
def _(t):
    return M.apply_rules(t.events.select("event_type", "user_id"),
                         ["fill_nulls", "remove_duplicates", "rename_column:event_type->kind"])


@query("version_upgrade", "2.3-19", sql=with_sql(AREAS) + """
SELECT sa2_code AS geographic_id, round((balance - 32) * 5 / 9, 6) AS max_temperature,
  CASE area_id % 5 WHEN 1 THEN 'Y' WHEN 2 THEN 'G' WHEN 3 THEN 'Q' WHEN 4 THEN 'P' ELSE 'N' END AS quality_flag,
  (area_id % 7) + coalesce(CASE WHEN score IS NOT NULL THEN 3 END, 0) AS deaths_0_4,
  floor((area_id % 50) * 0.25)::BIGINT AS children_0_4, round((2000 - area_id + 1) / 2000.0 * 100, 6) AS percentile,
  lat AS centroid_lat, '2.0.0' AS schema_version FROM areas""")
def _(t):
    v1 = areas(t).select(
        F.col("sa2_code").alias("area_code"), F.col("balance").alias("temp_max"), F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"), (F.col("area_id") % 5).alias("quality_code"), (F.col("area_id") % 7).alias("infant_deaths"),
        F.when(F.col("score").isNotNull(), 3).alias("child_deaths"), (F.col("area_id") % 50).alias("children"),
        F.col("area_id").alias("rank"), F.lit(2000).alias("total_areas"))
    v2 = M.upgrade_to_v2(v1, fahrenheit=["max_temperature"])
    return v2.select("geographic_id", r(F.col("max_temperature"), 6).alias("max_temperature"), "quality_flag", "deaths_0_4",
                     "children_0_4", r(F.col("percentile"), 6).alias("percentile"),
                     F.col("centroid.latitude").alias("centroid_lat"), "schema_version")


# --- aggregation ----------------------------------------------------------


@query("summary_totals", "2.5-01", sql="""
SELECT count(DISTINCT o_custkey) AS areas, round(avg(o_totalprice), 4) AS avg_price, round(sum(o_totalprice), 2) AS total FROM orders""")
def _(t):
    return t.orders.agg(F.count_distinct("o_custkey").alias("areas"), r(F.avg("o_totalprice"), 4).alias("avg_price"),
                        r(F.sum("o_totalprice"), 2).alias("total"))


@query("count_and_mean_by_state", "2.5-02", sql=with_sql(AREAS) + """
SELECT state, count(*) AS n, round(avg(score), 6) AS avg_score FROM areas GROUP BY state""")
def _(t):
    return areas(t).groupBy("state").agg(A.count_rows().alias("n"), r(F.avg("score"), 6).alias("avg_score"))


@query("grouped_statistics", "2.5-03", sql="""
SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 2) AS l_quantity_mean, round(stddev_samp(l_quantity), 2) AS l_quantity_std,
  round(min(l_quantity), 2) AS l_quantity_min, round(max(l_quantity), 2) AS l_quantity_max, count(l_quantity) AS l_quantity_count,
  round(avg(l_extendedprice), 2) AS l_extendedprice_mean FROM lineitem GROUP BY 1, 2""")
def _(t):
    return A.grouped_stats(t.lineitem, ["l_returnflag", "l_linestatus"],
                           {"l_quantity": ["mean", "std", "min", "max", "count"], "l_extendedprice": ["mean"]}, places=2)


@query("pivot_state_year", "2.5-04", sql="""
SELECT year(o_orderdate)::INTEGER AS yr, """ + ", ".join(
    f"round(avg(o_totalprice) FILTER (WHERE o_orderstatus = '{s}'), 6) AS status_{s.lower()}" for s in "FOP") + ", "
       + ", ".join(f"count(*) FILTER (WHERE o_orderstatus = '{s}') AS n_{s.lower()}" for s in "FOP") + " FROM orders GROUP BY 1")
def _(t):
    o = t.orders.select(F.year("o_orderdate").alias("yr"), "o_orderstatus", "o_totalprice")
    m = A.pivot_mean(o, ["yr"], "o_orderstatus", ["F", "O", "P"], "o_totalprice")
    n = A.pivot_count(o, ["yr"], "o_orderstatus", ["F", "O", "P"])
    return m.select("yr", *[r(F.col(s), 6).alias(f"status_{s.lower()}") for s in "FOP"]).join(
        n.select("yr", *[F.col(s).alias(f"n_{s.lower()}") for s in "FOP"]), "yr")


@query("describe_numeric", "2.5-05", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS "min",
 round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3,
 max({c})::DOUBLE AS "max" FROM lineitem""" for c in ("l_quantity", "l_extendedprice", "l_discount")))
def _(t):
    d = A.describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return d.withColumns({c: r(F.col(c), 4) for c in ("mean", "std", "q1", "median", "q3")})


@query("area_indicator_methods", "2.5-06", sql="""
SELECT l_suppkey, round(avg(l_quantity), 6) AS l_quantity, round(median(l_extendedprice), 6) AS l_extendedprice,
  max(l_tax) AS l_tax, round(sum(x * l_linenumber) / sum(l_linenumber), 6) AS x
FROM (SELECT *, CASE WHEN l_discount > 0.01 THEN l_discount END AS x FROM lineitem) GROUP BY l_suppkey""")
def _(t):
    d = t.lineitem.withColumn("x", F.when(F.col("l_discount") > 0.01, F.col("l_discount")))
    out = A.area_aggregate(d, "l_suppkey", {"l_quantity": "mean", "l_extendedprice": "median", "l_tax": "max", "x": "weighted_mean"},
                           weight="l_linenumber")
    return out.withColumns({c: r(F.col(c), 6) for c in ("l_quantity", "l_extendedprice", "x")})


_CORR = {"qty_price": ("l_quantity", "l_extendedprice"), "qty_disc": ("l_quantity", "l_discount"),
         "qty_tax": ("l_quantity", "l_tax"), "price_disc": ("l_extendedprice", "l_discount"),
         "price_tax": ("l_extendedprice", "l_tax"), "disc_tax": ("l_discount", "l_tax")}


@query("correlation_pairs", "2.5-07", sql="SELECT " + ", ".join(
    f"round(corr({a}, {b}), 8) AS {n}" for n, (a, b) in _CORR.items()) + " FROM lineitem")
def _(t):
    c = A.correlations(t.lineitem, _CORR)
    return c.select(*[r(F.col(n)).alias(n) for n in _CORR])


@query("correlation_matrix", "2.5-08", sql=with_sql(LABOUR) + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 8) AS corr, count(*) AS pairs FROM labour"
    for i, a in enumerate(["managers", "unemployed", "people"]) for b in ["managers", "unemployed", "people"][i + 1:]))
def _(t):
    return A.correlation_matrix(labour(t), ["managers", "unemployed", "people"]).withColumn("corr", r(F.col("corr")))


@query("histogram_50", "2.5-09", sql="""
WITH m AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
SELECT c_mktsegment, greatest(0, least(49, floor((c_acctbal - lo) / ((hi - lo) / 50))))::INTEGER AS bin, count(*) AS n
FROM customer, m GROUP BY 1, 2""")
def _(t):
    return A.histogram(t.customer, "c_acctbal", 50, ["c_mktsegment"])


@query("heat_map_bins", "2.5-10", sql="""
WITH m AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_discount) AS c, max(l_discount) AS d FROM lineitem)
SELECT greatest(0, least(9, floor((l_quantity - a) / ((b - a) / 10))))::INTEGER AS x_bin,
  greatest(0, least(9, floor((l_discount - c) / ((d - c) / 10))))::INTEGER AS y_bin, round(sum(l_tax), 4) AS z_sum, count(*) AS n
FROM lineitem, m GROUP BY 1, 2""")
def _(t):
    return A.heat_map(t.lineitem, "l_quantity", "l_discount", "l_tax").withColumn("z_sum", r(F.col("z_sum"), 4))


@query("box_statistics", "2.5-11", sql="""
WITH q AS (SELECT o_orderpriority AS p, quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS median, quantile_cont(o_totalprice, 0.75) AS q3
  FROM orders GROUP BY 1), f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT p AS o_orderpriority, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
  min(o_totalprice) FILTER (WHERE o_totalprice BETWEEN lo AND hi) AS low_whisker,
  max(o_totalprice) FILTER (WHERE o_totalprice BETWEEN lo AND hi) AS high_whisker,
  count(*) FILTER (WHERE NOT o_totalprice BETWEEN lo AND hi) AS outliers
FROM orders JOIN f ON p = o_orderpriority GROUP BY p""")
def _(t):
    b = A.box_stats(t.orders, "o_totalprice", ["o_orderpriority"])
    return b.withColumns({c: r(F.col(c), 4) for c in ("q1", "median", "q3")})


def _profile_sql(c, numeric):
    stats = (f"min({c})::DOUBLE, max({c})::DOUBLE, round(avg({c}), 6), round(median({c}), 6), round(stddev_samp({c}), 6)"
             if numeric else "NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE")
    return f"""SELECT '{c}', count(*), count({c}), count(DISTINCT {c}), count({c}) / count(*)::DOUBLE,
 round(count(DISTINCT {c}) / count({c})::DOUBLE, 8), {stats} FROM areas"""


@query("column_profile", "2.5-12", sql=with_sql(AREAS) + """
SELECT * FROM (""" + " UNION ALL ".join([_profile_sql("sa2_code", False), _profile_sql("segment", False),
                                         _profile_sql("score", True), _profile_sql("area_id", True)])
       + """) AS p("column", rows, filled, distinct_values, completeness, uniqueness, "min", "max", mean, median, std)""")
def _(t):
    p = A.column_profile(areas(t), ["sa2_code", "segment", "score", "area_id"])
    return p.withColumns({c: r(F.col(c), 6) for c in ("mean", "median", "std")}).withColumn("uniqueness", r(F.col("uniqueness")))


@query("completeness_by_domain", "2.5-13", sql=with_sql(AREAS, """
s AS (SELECT (count(score) + count(segment)) / 2.0 / count(*) AS health, count(lat) / count(*)::DOUBLE AS place FROM areas)""") + """
SELECT round(health, 8) AS health, place, round((health + place) / 2, 8) AS overall, (health + place) / 2 >= 0.85 AS passed FROM s""")
def _(t):
    c = A.completeness(areas(t), {"health": ["score", "segment"], "place": ["lat"]})
    return c.select(r(F.col("health")).alias("health"), "place", r(F.col("overall")).alias("overall"), "passed")


@query("dominant_value", "2.5-14", sql="""
WITH c AS (SELECT o_orderstatus AS value, count(*) AS k FROM orders GROUP BY 1)
SELECT value, round(k / (SELECT sum(k) FROM c)::DOUBLE, 8) AS share, k / (SELECT sum(k) FROM c)::DOUBLE > 0.8 AS dominant
FROM c ORDER BY k DESC, value DESC LIMIT 1""")
def _(t):
    return A.value_share(t.orders, "o_orderstatus").withColumn("share", r(F.col("share")))


@query("contingency_table", "2.5-15", sql="SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2")
def _(t):
    return A.contingency(t.labels, "quality", "toxic")


@query("usage_report", "2.5-16", sql="""
WITH e AS (SELECT *, CASE WHEN value > 50 THEN 'csv' WHEN value > 20 THEN 'json' ELSE 'parquet' END AS f FROM events
  WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25')
SELECT 'total' AS section, 'all' AS item, count(*) AS n, round(avg(value), 8) AS mean FROM e
UNION ALL SELECT 'kind', event_type, count(*), round(avg(value), 8) FROM e GROUP BY event_type
UNION ALL SELECT 'format', f, count(*), round(avg(value), 8) FROM e GROUP BY f""")
def _(t):
    fmt = F.when(F.col("value") > 50, "csv").when(F.col("value") > 20, "json").otherwise("parquet")
    u = A.usage_report(t.events, "ts", "event_type", fmt, "value", "2024-01-05", "2024-01-25")
    return u.withColumn("mean", r(F.col("mean")))


@query("operation_statistics", "2.5-17", sql="""
SELECT event_type, count(*) AS n, round(avg((value > 5)::INT), 8) AS success_rate, round(avg(value), 6) AS avg_duration,
  min(value) AS min_duration, max(value) AS max_duration, round(sum(value), 4) AS total_duration, round(count(*) / 240.0, 8) AS per_hour
FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1""")
def _(t):
    s = A.operation_stats(t.events, "event_type", F.col("value") > 5, "value", "ts", "2024-01-10", "2024-01-20")
    return s.withColumns({"success_rate": r(F.col("success_rate")), "avg_duration": r(F.col("avg_duration"), 6),
                          "total_duration": r(F.col("total_duration"), 4), "per_hour": r(F.col("per_hour"))})


@query("duration_percentiles", "2.5-18", sql="""
WITH q AS (SELECT event_type AS e, """ + ", ".join(f"quantile_cont(value, {p / 100}) AS p{p}" for p in (25, 50, 75, 90, 95, 99)) + """
  FROM events GROUP BY 1)
SELECT event_type, """ + ", ".join(f"round(any_value(p{p}), 6) AS p{p}" for p in (50, 75, 90, 95, 99)) + """,
  round(avg((NOT value BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25))::INT), 8) AS outlier_share,
  round(stddev_pop(value) / avg(value) * 100, 6) AS cv_pct FROM events JOIN q ON e = event_type GROUP BY 1""")
def _(t):
    d = A.duration_percentiles(t.events, "event_type", "value")
    return d.select("event_type", *[r(F.col(c), 6).alias(c) for c in ("p50", "p75", "p90", "p95", "p99")],
                    r(F.col("outlier_share")).alias("outlier_share"), r(F.col("cv_pct"), 6).alias("cv_pct"))


@query("slowdown_check", "2.5-19", sql="""
WITH s AS (SELECT event_type, avg(value) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS b, avg(value) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') AS n,
  avg((value > 5)::INT) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS bo, avg((value > 5)::INT) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') AS no
  FROM events GROUP BY 1)
SELECT event_type, round(b, 6) AS base_avg, round(n, 6) AS recent_avg, n > b * 1.2 AS slower, no < bo - 0.05 AS less_successful FROM s""")
def _(t):
    s = A.regression_check(t.events, "event_type", "ts", "value", F.col("value") > 5, "2024-01-16")
    return s.select("event_type", r(F.col("base_avg"), 6).alias("base_avg"), r(F.col("recent_avg"), 6).alias("recent_avg"),
                    "slower", "less_successful")


_STATEMENT = "CASE event_type WHEN 'click' THEN 'select * from clicks where id = ' || user_id " \
             "WHEN 'purchase' THEN 'INSERT INTO sales VALUES (' || event_id || ', ''x' || user_id || ''')' " \
             "WHEN 'view' THEN 'update views set n = ' || user_id ELSE 'vacuum ' || event_type END"


@query("statement_patterns", "2.5-20", sql=f"""
WITH s AS (SELECT {_STATEMENT} AS q, value FROM events),
p AS (SELECT regexp_replace(regexp_replace(q, '''[^'']*''', '?', 'g'), '\\b[0-9]+\\b', '?', 'g') AS pattern,
  upper(regexp_extract(q, '^\\s*(\\w+)', 1)) AS verb, value FROM s)
SELECT pattern, CASE WHEN verb IN ('SELECT','INSERT','UPDATE','DELETE') THEN verb ELSE 'OTHER' END AS kind, count(*) AS n,
  round(avg(value), 6) AS avg_duration, max(value) AS max_duration, round(sum(value), 4) AS total_duration FROM p GROUP BY 1, 2""")
def _(t):
    q = A.query_patterns(t.events.select(F.expr(_STATEMENT).alias("q"), "value"), "q", "value")
    return q.withColumns({"avg_duration": r(F.col("avg_duration"), 6), "total_duration": r(F.col("total_duration"), 4)})


@query("coverage_totals", "2.5-22", sql=with_sql(AREAS) + """
SELECT round(sum(balance), 2) AS population, count(DISTINCT sa2_code) AS areas,
  (SELECT count(*) FROM region WHERE r_name NOT IN (SELECT state FROM areas WHERE score > 9990)) AS missing_states,
  abs(sum(balance) / 7000000.0 - 1) <= 0.10 AS population_ok, abs(count(DISTINCT sa2_code) / 1500.0 - 1) <= 0.05 AS areas_ok FROM areas""")
def _(t):
    c = A.coverage_totals(areas(t), "sa2_code", "state", "balance", t.region.select(F.col("r_name").alias("state")),
                          expected_population=7e6, expected_areas=1500, covered=F.col("score") > 9990)
    return c.withColumn("population", r(F.col("population"), 2))


@query("group_code_check", "2.5-23", sql="""
SELECT p_type, sum(k)::BIGINT AS rows, count(*) AS codes, count(*) FILTER (WHERE k > 1) AS repeated,
  count(*) = CASE p_type WHEN 'ECONOMY' THEN 25 WHEN 'SMALL' THEN 24 END IS TRUE AS count_ok
FROM (SELECT p_type, p_brand, count(*) AS k FROM part GROUP BY 1, 2) GROUP BY 1""".replace("count(*) = CASE", "coalesce(count(*) = CASE").replace("END IS TRUE", "END, false)"))
def _(t):
    return A.group_code_check(t.part, "p_type", "p_brand", {"ECONOMY": 25, "SMALL": 24})


@query("climate_statistics", "2.5-24", sql="""
WITH w AS (SELECT l_suppkey AS station, month(l_shipdate)::INTEGER AS m, l_quantity AS tx, l_quantity - 20 AS tn, l_extendedprice / 1000 AS rain,
  l_returnflag AS wind FROM lineitem),
u AS (SELECT station, m, wind, count(*) AS k FROM w GROUP BY 1, 2, 3),
p AS (SELECT station, m, arg_min(wind, row(-k, wind)) AS prevailing_wind FROM u GROUP BY 1, 2)
SELECT w.station, w.m, round(avg(tx), 6) AS mean_max, max(tx) AS highest, min(tn) AS lowest, count(*) FILTER (WHERE tx > 35) AS days_over_35,
  count(*) FILTER (WHERE tx > 40) AS days_over_40, count(*) FILTER (WHERE tn < 0) AS days_below_0, count(*) FILTER (WHERE tn < -5) AS days_below_minus_5,
  round(avg(rain), 9) AS mean_rain, count(*) FILTER (WHERE rain > 1) AS rain_days_1, count(*) FILTER (WHERE rain > 10) AS rain_days_10,
  count(*) FILTER (WHERE rain > 25) AS rain_days_25, round(median(rain), 6) AS median_rain, round(quantile_cont(rain, 0.1), 6) AS p10_rain,
  round(quantile_cont(rain, 0.9), 6) AS p90_rain, any_value(prevailing_wind) AS prevailing_wind
FROM w JOIN p ON w.station = p.station AND w.m = p.m GROUP BY 1, 2""")
def _(t):
    w = t.lineitem.select(F.col("l_suppkey").alias("station"), F.month("l_shipdate").alias("m"), F.col("l_quantity").alias("tx"),
                          (F.col("l_quantity") - 20).alias("tn"), (F.col("l_extendedprice") / 1000).alias("rain"), F.col("l_returnflag").alias("wind"))
    c = A.climate_stats(w, ["station", "m"], "tx", "tn", "rain", "wind").drop("completeness_pct")
    return c.withColumns({x: r(F.col(x), 9 if x == "mean_rain" else 6) for x in ("mean_max", "mean_rain", "median_rain", "p10_rain", "p90_rain")})


@query("mortality_statistics", "2.5-25", sql="""
SELECT o_custkey AS area, year(o_orderdate)::INTEGER AS yr, count(*) AS total_deaths, count(*) FILTER (WHERE o_orderstatus = 'F') AS deaths_male,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS deaths_female, count(*) FILTER (WHERE substr(o_orderpriority,1,1) = '1') AS deaths_0_4,
  count(*) FILTER (WHERE substr(o_orderpriority,1,1) IN ('2')) AS deaths_85_plus, count(*) FILTER (WHERE o_totalprice > 250000) AS cause_cancer,
  100 AS population, round(sum(greatest(75.0 - o_totalprice / 5000, 0)), 6) AS years_of_life_lost, round(count(*) / 100.0 * 100000, 4) AS crude_rate
FROM orders GROUP BY 1, 2""")
def _(t):
    d = t.orders.select(
        F.col("o_custkey").alias("area"), F.year("o_orderdate").alias("yr"), F.lit(1).alias("deaths"), F.lit(100).alias("pop"),
        F.when(F.col("o_orderstatus") == "F", "Male").when(F.col("o_orderstatus") == "O", "Female").otherwise("Persons").alias("sex"),
        F.when(F.col("o_orderpriority").startswith("1"), "0-4").when(F.col("o_orderpriority").startswith("2"), "85+").alias("band"),
        F.when(F.col("o_totalprice") > 250000, "Cancer").alias("cause"), (F.col("o_totalprice") / 5000).alias("age"))
    m = A.mortality_stats(d, ["area", "yr"], "deaths", "sex", "band", "cause", ["0-4", "85+"], ["Cancer"], "pop", age="age")
    return m.withColumns({"years_of_life_lost": r(F.col("years_of_life_lost"), 6), "crude_rate": r(F.col("crude_rate"), 4)})


@query("index_aggregate", "2.5-26", sql=with_sql(AREAS, """
x AS (SELECT *, floor(score / 1000)::INT + 1 AS decile FROM areas WHERE score IS NOT NULL),
g AS (SELECT state, sum((2 * rn - n - 1) * score) / (max(n) * sum(score)) AS gini FROM (SELECT state, score,
  row_number() OVER (PARTITION BY state ORDER BY score) AS rn, count(*) OVER (PARTITION BY state) AS n FROM x) GROUP BY 1)""") + """
SELECT state, count(*) AS areas, sum(area_id)::BIGINT AS population, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS sd,
  min(score) AS "min", max(score) AS "max", """ + ", ".join(f"count(*) FILTER (WHERE decile = {i}) AS decile_{i}" for i in range(1, 11)) + ", "
       + ", ".join(f"count(*) FILTER (WHERE ceil(decile / 2.0) = {i}) AS quintile_{i}" for i in range(1, 6))
       + ", round(median(score), 6) AS median, round(any_value(gini), 8) AS gini FROM x JOIN g USING (state) GROUP BY state")
def _(t):
    a = areas(t).withColumn("decile", F.floor(F.col("score") / 1000) + 1)
    x = A.index_aggregate(a, ["state"], "score", "decile", "area_id")
    return x.withColumns({**{c: r(F.col(c), 6) for c in ("mean", "sd", "median")}, "gini": r(F.col("gini"))})


@query("indicator_summary", "2.5-27", sql=with_sql(AREAS, """
f AS (SELECT sa4_code AS parent, sa3_code AS area, o_orderpriority AS kind, round(o_totalprice * 100)::BIGINT AS v FROM orders JOIN areas ON area_id = o_custkey),
p AS (SELECT parent, kind, sum(v)::DOUBLE / count(*) AS pm FROM f GROUP BY 1, 2), n AS (SELECT kind, sum(v)::DOUBLE / count(*) AS nm FROM f GROUP BY 1)""") + """
SELECT parent, area, kind, count(*) AS n, round(sum(v)::DOUBLE / count(*), 6) AS mean, round(sum(v)::DOUBLE / count(*) - any_value(pm), 6) AS vs_parent, round(sum(v)::DOUBLE / count(*) - any_value(nm), 6) AS vs_nation
FROM f JOIN p USING (parent, kind) JOIN n USING (kind) GROUP BY 1, 2, 3""")
def _(t):
    a = areas(t).select("area_id", F.col("sa4_code").alias("parent"), F.col("sa3_code").alias("area"))
    f = t.orders.join(a, F.col("o_custkey") == F.col("area_id")).select("parent", "area", F.col("o_orderpriority").alias("kind"), F.round(F.col("o_totalprice") * 100).cast("long").alias("v"))
    s = A.indicator_summary(f, "area", "parent", "kind", "v")
    return s.withColumns({c: r(F.col(c), 6) for c in ("mean", "vs_parent", "vs_nation")})


@query("top_causes_by_area", "2.5-27", "2.7-05", sql="""
WITH c AS (SELECT l_suppkey, month(l_shipdate)::INTEGER AS cause, count(*) AS n FROM lineitem GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, cause) AS place FROM c)
SELECT l_suppkey, string_agg(cause::VARCHAR, ',' ORDER BY place) AS top_causes FROM k WHERE place <= 3 GROUP BY 1""")
def _(t):
    d = t.lineitem.select("l_suppkey", F.month("l_shipdate").alias("cause"))
    return A.top_causes(d, ["l_suppkey"], "cause")


# --- ranking and windows ---------------------------------------------------

_DECILE = "greatest(1, CASE WHEN n > 1 THEN ({q} * (rn - 1) + n - 2) // (n - 1) ELSE 1 END)"


def _rank_sql(part, q):
    over = f"PARTITION BY {part} " if part else ""
    return with_sql(AREAS, f"""k AS (SELECT area_id, rank() OVER ({over}ORDER BY score) AS rk,
  row_number() OVER ({over}ORDER BY score, area_id) AS rn, count(*) OVER ({'PARTITION BY ' + part if part else ''}) AS n
  FROM areas WHERE score IS NOT NULL)""") + f"""
SELECT a.area_id, rk::DOUBLE AS score_rank, ({_DECILE.format(q=q)})::DOUBLE AS decile FROM areas a LEFT JOIN k ON a.area_id = k.area_id"""


@query("rank_and_decile_national", "2.6-01", "2.6-02", sql=_rank_sql("", "10").replace(
    "({q}".format(q="10"), "(10").replace("(greatest(1, CASE WHEN n > 1", "(CASE WHEN n IS NULL THEN NULL ELSE greatest(1, CASE WHEN n > 1")
       .replace("ELSE 1 END))::DOUBLE", "ELSE 1 END) END)::DOUBLE"))
def _(t):
    d = R.rank_scores(areas(t).select("area_id", "score"), "score", "area_id")
    return d.select("area_id", F.col("score_rank").cast("double").alias("score_rank"), F.col("score_decile").cast("double").alias("decile"))


@query("rank_and_decile_state", "2.6-03", "2.6-04", sql=_rank_sql("state_code", "least(10, n)").replace(
    "(greatest(1, CASE WHEN n > 1", "(CASE WHEN n IS NULL THEN NULL ELSE greatest(1, CASE WHEN n > 1")
       .replace("ELSE 1 END))::DOUBLE", "ELSE 1 END) END)::DOUBLE"))
def _(t):
    d = R.rank_within_state(areas(t).select("area_id", "state_code", "score"), "score", "area_id", "state_code")
    return d.select("area_id", F.col("score_state_rank").cast("double").alias("score_rank"),
                    F.col("score_state_decile").cast("double").alias("decile"))


@query("quintile_labels", "2.6-05", sql=with_sql(AREAS, """
e AS (SELECT quantile_cont(score, 0.2) AS a, quantile_cont(score, 0.4) AS b, quantile_cont(score, 0.6) AS c, quantile_cont(score, 0.8) AS d FROM areas)""") + """
SELECT area_id, CASE WHEN score IS NULL THEN NULL WHEN score <= a THEN 'Most Disadvantaged' WHEN score <= b THEN 'Disadvantaged'
  WHEN score <= c THEN 'Average' WHEN score <= d THEN 'Advantaged' ELSE 'Most Advantaged' END AS quintile FROM areas, e""")
def _(t):
    return R.quintile_labels(areas(t).select("area_id", "score"), "score").select("area_id", "quintile")


@query("z_scores", "2.6-06", sql=with_sql(AREAS) + """
SELECT area_id, round((score - (SELECT avg(score) FROM areas)) / (SELECT stddev_pop(score) FROM areas), 8) AS score_zscore FROM areas""")
def _(t):
    return R.z_scores(areas(t).select("area_id", "score"), ["score"]).select("area_id", r(F.col("score_zscore")).alias("score_zscore"))


def _ladder_sql(agg, value):
    ctes = [AREAS, f"v AS (SELECT *, {value} AS x FROM areas)"]
    for lv in ("sa3_code", "sa4_code", "state_code"):
        ctes.append(f"m_{lv} AS (SELECT {lv}, {agg} AS m FROM v WHERE x IS NOT NULL GROUP BY 1)")
    ctes.append(f"m_all AS (SELECT {agg} AS m FROM v WHERE x IS NOT NULL)")
    return with_sql(*ctes) + """
SELECT area_id, round(coalesce(x, a.m, b.m, c.m, (SELECT m FROM m_all), 0), 6) AS filled FROM v
LEFT JOIN m_sa3_code a USING (sa3_code) LEFT JOIN m_sa4_code b USING (sa4_code) LEFT JOIN m_state_code c USING (state_code)"""


_SPARSE = "CASE WHEN balance > 6000 AND nation <> 'NATION_3' THEN balance END"
_LEVELS = ["sa3_code", "sa4_code", "state_code"]


@query("impute_median_ladder", "2.6-07", sql=_ladder_sql("median(x)", _SPARSE))
def _(t):
    a = areas(t).withColumn("x", F.expr(_SPARSE))
    return I.fill_ladder_median(a, ["x"], _LEVELS).select("area_id", r(F.col("x"), 6).alias("filled"))


_COARSE = "CASE WHEN balance > 6000 AND nation <> 'NATION_3' THEN floor(balance / 1000) END"


@query("impute_mode_ladder", "2.6-08", sql=with_sql(AREAS, f"v AS (SELECT *, {_COARSE} AS x FROM areas)", *[
    f"""m_{lv} AS (SELECT {lv}, arg_min(x, row(-k, x)) AS m FROM (SELECT {lv}, x, count(*) AS k FROM v WHERE x IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"""
    for lv in _LEVELS], "m_all AS (SELECT arg_min(x, row(-k, x)) AS m FROM (SELECT x, count(*) AS k FROM v WHERE x IS NOT NULL GROUP BY 1))") + """
SELECT area_id, coalesce(x, a.m, b.m, c.m, (SELECT m FROM m_all), 0) AS filled, coalesce(x, a.m, 0) AS first_level_only FROM v
LEFT JOIN m_sa3_code a USING (sa3_code) LEFT JOIN m_sa4_code b USING (sa4_code) LEFT JOIN m_state_code c USING (state_code)""")
def _(t):
    a = areas(t).withColumn("filled", F.expr(_COARSE).cast("double")).withColumn("first_level_only", F.col("filled"))
    d = I.fill_ladder_mode(a, ["filled"], _LEVELS)
    return I.fill_ladder_mode(d, ["first_level_only"], _LEVELS, empty_group_is_zero=True).select("area_id", "filled", "first_level_only")


@query("impute_state_median", "2.6-09", sql=with_sql(AREAS) + """
SELECT area_id, round(coalesce(score, median(score) OVER (PARTITION BY state_code), (SELECT median(score) FROM areas)), 6) AS filled FROM areas""")
def _(t):
    d = I.fill_ladder_median(areas(t), ["score"], ["state_code"], last_resort=None)
    return d.select("area_id", r(F.col("score"), 6).alias("filled"))


def _wm_sql(lv):
    part = f"PARTITION BY {lv}" if lv else ""
    sel = f"{lv}, " if lv else ""
    return f"""(SELECT {sel}coalesce(min(x) FILTER (WHERE cum > tot / 2), max(x)) AS m FROM (SELECT {sel}x,
  sum(w) OVER ({part} ORDER BY x, area_id) AS cum, sum(w) OVER ({part}) AS tot FROM v WHERE x IS NOT NULL) {'GROUP BY 1' if lv else ''})"""


@query("impute_weighted_median_ladder", "2.6-10", sql=with_sql(
    AREAS, LABOUR, f"""v AS (SELECT a.*, {_SPARSE} AS x, CASE WHEN coalesce(labour_force_pop, 0) = 0 THEN 1 ELSE labour_force_pop END AS w
  FROM areas a LEFT JOIN labour l ON a.area_id = l.area_id)""", *[f"m_{lv} AS {_wm_sql(lv)}" for lv in _LEVELS], f"m_all AS {_wm_sql('')}") + """
SELECT area_id, round(coalesce(x, a.m, b.m, c.m, (SELECT m FROM m_all), 0), 6) AS filled FROM v
LEFT JOIN m_sa3_code a USING (sa3_code) LEFT JOIN m_sa4_code b USING (sa4_code) LEFT JOIN m_state_code c USING (state_code)""")
def _(t):
    a = areas(t).withColumn("x", F.expr(_SPARSE)).join(labour(t).select("area_id", "labour_force_pop"), "area_id", "left")
    return I.fill_ladder_weighted_median(a, ["x"], "labour_force_pop", _LEVELS).select("area_id", r(F.col("x"), 6).alias("filled"))


_YEARLY = "y AS (SELECT o_custkey AS area, year(o_orderdate)::INTEGER AS yr, count(*) AS pop, sum(o_totalprice) AS price FROM orders GROUP BY 1, 2)"


def yearly(t):
    return t.orders.groupBy(F.col("o_custkey").alias("area"), F.year("o_orderdate").alias("yr")).agg(
        F.count(F.lit(1)).alias("pop"), F.sum("o_totalprice").alias("price"))


@query("yearly_change", "2.6-11", sql=with_sql(_YEARLY, "p AS (SELECT *, lag(pop) OVER w AS pp, lag(yr) OVER w AS py FROM y WINDOW w AS (PARTITION BY area ORDER BY yr))") + """
SELECT area, yr, pop, round((pop - pp) / pp::DOUBLE / (yr - py), 8) AS annual_change, coalesce(abs((pop - pp) / pp::DOUBLE / (yr - py)) > 0.15, false) AS unreasonable FROM p""")
def _(t):
    d = R.yearly_change(yearly(t).drop("price"), "area", "yr", "pop")
    return d.withColumn("annual_change", r(F.col("annual_change")))


@query("nearest_year_rows", "2.6-12", sql="""
SELECT o_orderkey, year(o_orderdate)::INTEGER AS yr, (2003 - year(o_orderdate))::INTEGER AS _temporal_adjustment, 2021 AS snapped FROM orders
WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def _(t):
    d = R.align_to_year(t.orders.select("o_orderkey", F.year("o_orderdate").alias("yr")), "yr", 2003)
    return d.withColumn("snapped", R.snap_to_index_year(F.lit(2020)))


@query("surrogate_keys", "2.6-13", sql="SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) + 19999 AS area_sk FROM customer")
def _(t):
    return R.surrogate_keys(t.customer.select("c_custkey", "c_name"), ["c_name", "c_custkey"], "area_sk", 20000).select("c_custkey", "area_sk")


@query("operation_trend", "2.6-15", sql="""
WITH e AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events),
s AS (SELECT event_type, corr(value, i) AS c, regr_slope(value, i) AS b, count(*) AS points FROM e GROUP BY 1)
SELECT event_type, round(c, 8) AS corr, round(b, 8) AS slope, points, CASE WHEN abs(c) < 0.3 THEN 'stable' WHEN b > 0 THEN 'increasing' ELSE 'decreasing' END AS direction
FROM s WHERE points >= 5""")
def _(t):
    from zonalis.operators.ordering import positions
    p = positions(t.events.select("event_type", "ts", "event_id", "value"), ["ts", "event_id"], ["event_type"])
    d = R.entity_trend(p, "event_type", "_rn", "value")
    return d.withColumns({"corr": r(F.col("corr")), "slope": r(F.col("slope"))})


@query("mortality_trend", "2.6-16", sql=with_sql(_YEARLY, "p AS (SELECT *, lag(price) OVER (PARTITION BY area ORDER BY yr) AS pp FROM y)") + """
SELECT area, min(yr) AS start_year, max(yr) AS end_year, round(avg((price - pp) / pp * 100), 5) AS annual_change_pct, round(regr_slope(price, yr), 4) AS slope,
  round(regr_r2(price, yr), 6) AS r_squared, count(DISTINCT yr) = max(yr) - min(yr) + 1 AS covers_period,
  CASE WHEN count(*) < 2 THEN 'stable' WHEN regr_slope(price, yr) > 0 THEN 'increasing' WHEN regr_slope(price, yr) < 0 THEN 'decreasing' ELSE 'stable' END AS direction FROM p GROUP BY 1""")
def _(t):
    d = R.mortality_trend(yearly(t), "area", "yr", "price")
    return d.withColumns({"annual_change_pct": r(F.col("annual_change_pct"), 5), "slope": r(F.col("slope"), 4), "r_squared": r(F.col("r_squared"), 6)})


@query("two_year_comparison", "2.6-17", sql=with_sql(_YEARLY) + """
SELECT a.area, round(b.price - a.price, 4) AS score_difference, b.pop - a.pop AS decile_change,
  CASE WHEN b.price = a.price THEN 'No Change' WHEN b.price > a.price THEN 'Improvement' ELSE 'Decline' END AS direction
FROM y a JOIN y b ON a.area = b.area WHERE a.yr = 1996 AND b.yr = 2000""")
def _(t):
    d = R.compare_years(yearly(t), ["area"], "yr", "price", "pop", 1996, 2000)
    return d.withColumn("score_difference", r(F.col("score_difference"), 4))


@query("recent_score_trend", "2.6-18", sql="""
WITH k AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events)
SELECT user_id, arg_min(value, event_id) AS first, arg_max(value, event_id) AS latest, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance,
  CASE WHEN arg_max(value, event_id) > arg_min(value, event_id) THEN 'improving' WHEN arg_max(value, event_id) < arg_min(value, event_id) THEN 'declining' ELSE 'stable' END AS trend
FROM k WHERE n <= 5 GROUP BY 1""")
def _(t):
    d = R.recent_score_trend(t.events, "user_id", "event_id", "value")
    return d.withColumns({"mean": r(F.col("mean"), 6), "variance": r(F.col("variance"), 6)})


# --- top lists and sets ------------------------------------------------------


@query("top_and_bottom_areas", "2.7-01", sql="""
(SELECT c_custkey, c_acctbal, 'top' AS side FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10) UNION ALL
(SELECT c_custkey, c_acctbal, 'bottom' FROM customer ORDER BY c_acctbal, c_custkey LIMIT 10)""")
def _(t):
    return S.top_and_bottom(t.customer, "c_custkey", "c_acctbal", 10)


@query("riskiest_in_one_state", "2.7-02", sql=with_sql(AREAS) + """
SELECT area_id, balance FROM areas WHERE state_code = '1' ORDER BY balance, area_id LIMIT 5""")
def _(t):
    return areas(t).filter("state_code = '1'").orderBy("balance", "area_id").limit(5).select("area_id", "balance")


@query("multi_key_sort", "2.7-04", sql="""
SELECT p_type, p_size, p_partkey, row_number() OVER (ORDER BY p_type, p_size DESC, p_partkey) AS place FROM part""")
def _(t):
    from zonalis.operators.ordering import positions
    p = positions(t.part.select("p_type", "p_size", "p_partkey"), ["p_type", F.desc("p_size"), "p_partkey"])
    return p.orderBy("p_type", F.desc("p_size"), "p_partkey").select("p_type", "p_size", "p_partkey", F.col("_rn").alias("place"))


@query("top_values_per_column", "2.7-05", "2.5-12", sql="""
WITH c AS (SELECT 'p_brand' AS "column", p_brand AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY 2
  UNION ALL SELECT 'p_size', p_size::VARCHAR, count(*) FROM part GROUP BY 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value)::INTEGER AS place FROM c) WHERE place <= 5""")
def _(t):
    return A.top_values(t.part, ["p_brand", "p_type", "p_size"], 5)


@query("union_all_rows", "2.8-01", sql="""
SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, NULL FROM supplier""")
def _(t):
    return S.stack(t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
                   t.supplier.select(F.col("s_suppkey").alias("id")))


@query("missing_official_codes", "2.8-02", "2.4-14", "2.4-15", sql="""
SELECT p_partkey AS code FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45""")
def _(t):
    return S.missing_keys(t.part.select(F.col("p_partkey").alias("code")),
                          t.lineitem.filter("l_quantity > 45").select(F.col("l_partkey").alias("code")), "code")


@query("all_area_keys", "2.8-03", sql="SELECT o_custkey AS k FROM orders UNION SELECT l_suppkey FROM lineitem UNION SELECT user_id FROM events")
def _(t):
    return S.all_keys("k", t.orders.select(F.col("o_custkey").alias("k")), t.lineitem.select(F.col("l_suppkey").alias("k")),
                      t.events.select(F.col("user_id").alias("k")))


@query("column_set_check", "2.8-04", sql="SELECT count(*) AS rows, true AS same, false AS narrowed_same FROM supplier")
def _(t):
    back = t.supplier.select("s_acctbal", "s_name", "s_suppkey", "s_nationkey")
    return t.supplier.agg(F.count(F.lit(1)).alias("rows")).withColumns({
        "same": F.lit(S.same_columns(t.supplier, back)), "narrowed_same": F.lit(S.same_columns(t.supplier, back.drop("s_name")))})


@query("equal_width_risk_bins", "2.10-11", sql="""
WITH m AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
SELECT c_custkey, greatest(1, least(5, ceil((c_acctbal - lo) / ((hi - lo) / 5))))::INTEGER AS bin FROM customer, m""")
def _(t):
    return A.equal_width_bins(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 5).select("c_custkey", "bin")
