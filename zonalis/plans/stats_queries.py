"""Outliers, tests, trends, clusters, samples and the usage stream."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from zonalis.operators import spatial as P
from zonalis.operators import stats as X
from zonalis.operators.forest import forest_outliers
from zonalis.plans.frames import AREAS, LABOUR, areas, labour, r, with_sql
from zonalis.plans.join_queries import BOXES, boxes
from zonalis.plans.registry import query
from zonalis.session import scratch_path
from zonalis.streaming import usage


@query("outliers_iqr", "2.15-01", sql="""
WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b FROM orders),
 e AS (SELECT o_totalprice AS v, row_number() OVER (ORDER BY o_totalprice) AS rn, count(*) OVER () AS n FROM orders),
 p AS (SELECT max(v) FILTER (WHERE rn = floor((n + 1) * 0.25)) AS l1, max(v) FILTER (WHERE rn = ceil((n + 1) * 0.25)) AS h1, any_value((n + 1) * 0.25 - floor((n + 1) * 0.25)) AS f1,
   max(v) FILTER (WHERE rn = floor((n + 1) * 0.75)) AS l3, max(v) FILTER (WHERE rn = ceil((n + 1) * 0.75)) AS h3, any_value((n + 1) * 0.75 - floor((n + 1) * 0.75)) AS f3 FROM e),
 x AS (SELECT l1 + (h1 - l1) * f1 AS a2, l3 + (h3 - l3) * f3 AS b2 FROM p)
SELECT o_orderkey, NOT o_totalprice BETWEEN a - 0.5 * (b - a) AND b + 0.5 * (b - a) AS iqr_outlier, NOT o_totalprice BETWEEN a2 - 0.4 * (b2 - a2) AND b2 + 0.4 * (b2 - a2) AS exclusive_outlier FROM orders, q, x""")
def _(t):
    d = X.iqr_flags(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 0.5)
    return X.iqr_flags(d, "o_totalprice", 0.4, exclusive=True, out="exclusive_outlier").drop("o_totalprice")


@query("outliers_zscore", "2.15-02", sql="""
SELECT o_orderkey, abs(o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_pop(o_totalprice) FROM orders) > 1.5 AS z_outlier,
  abs(o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_samp(o_totalprice) FROM orders) > 1.7 AS sample_outlier FROM orders""")
def _(t):
    d = X.zscore_flags(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 1.5)
    return X.zscore_flags(d, "o_totalprice", 1.7, sample=True, out="sample_outlier").drop("o_totalprice")


@query("outliers_modified_zscore", "2.15-03", sql="""
WITH m AS (SELECT median(value) AS m FROM events), d AS (SELECT median(abs(value - m)) AS mad FROM events, m)
SELECT event_id, 0.6745 * abs(value - m) / mad > 3.5 AS mod_z_outlier FROM events, m, d""")
def _(t):
    return X.modified_zscore_flags(t.events.select("event_id", "value"), "value").drop("value")


@query("outliers_consensus", "2.15-04", sql="""
WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, avg(value) AS m, stddev_pop(value) AS s FROM events)
SELECT event_id, CASE WHEN value > 100 THEN 'ERROR' WHEN abs(value - m) / s > 5 THEN 'WARNING' ELSE 'INFO' END AS severity FROM events, q
WHERE NOT value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a) AND abs(value - m) / s > 3""")
def _(t):
    return X.consensus_outliers(t.events.select("event_id", "value"), "value", None, 100.0).drop("value")


@query("outliers_multivariate", "2.15-05", sql="""
WITH s AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my, stddev_pop(l_quantity) AS sx, stddev_pop(l_extendedprice) AS sy, corr(l_quantity, l_extendedprice) AS c FROM lineitem),
 d AS (SELECT l_orderkey, l_linenumber, (pow((l_quantity - mx) / sx, 2) - 2 * c * (l_quantity - mx) / sx * (l_extendedprice - my) / sy + pow((l_extendedprice - my) / sy, 2)) / (1 - c * c) AS d2 FROM lineitem, s)
SELECT l_orderkey, l_linenumber, round(d2, 5) AS distance2, d2 > (SELECT quantile_cont(d2, 0.95) FROM d) AS outlier FROM d""")
def _(t):
    d = X.multivariate_outliers(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    return d.select("l_orderkey", "l_linenumber", r(F.col("distance2"), 5).alias("distance2"), "outlier")


@query("outliers_forest", "2.15-05")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    return forest_outliers(rows, ["l_quantity", "l_extendedprice", "l_discount"]).select("l_orderkey", "l_linenumber", "isolation", "outlier")


@query("unexpected_correlations", "2.15-06", sql=with_sql(LABOUR, "x AS (SELECT corr(people, managers) AS a, corr(people, unemployed) AS b, count(*) AS n FROM labour)") + """
SELECT 'smoking_rate' AS first, 'mortality_rate_all_causes' AS second, round(a, 8) AS corr, n AS pairs, true AS significant, CASE WHEN a < 0 THEN 'ERROR' ELSE 'WARNING' END AS severity FROM x WHERE abs(a - 0.3) > 0.2
UNION ALL SELECT 'life_expectancy_male', 'life_expectancy_female', round(b, 8), n, true, 'WARNING' FROM x WHERE abs(b) < 0.7""")
def _(t):
    d = labour(t).select(F.col("people").alias("smoking_rate"), F.col("managers").alias("mortality_rate_all_causes"), F.col("people").alias("life_expectancy_male"),
                         F.col("unemployed").alias("life_expectancy_female"))
    return X.correlation_checks(d).withColumn("corr", r(F.col("corr")))


def _tcrit(n):
    z = 1.959963984540054
    g = [(z ** 3 + z) / 4, (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96, (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384]
    return f"(CASE WHEN {n} = 1 THEN 12.706204736 WHEN {n} = 2 THEN 4.302652730 WHEN {n} = 3 THEN 3.182446305 WHEN {n} = 4 THEN 2.776445105 WHEN {n} = 5 THEN 2.570581836 WHEN {n} = 6 THEN 2.446911851 ELSE {z} + {g[0]} / {n} + {g[1]} / pow({n}, 2) + {g[2]} / pow({n}, 3) END)"


@query("linear_trends", "2.15-07", sql=f"""
WITH y AS (SELECT o_custkey AS area, year(o_orderdate)::INTEGER AS yr, sum(o_totalprice) AS price FROM orders GROUP BY 1, 2),
 g AS (SELECT area, regr_slope(price, yr) AS slope, regr_r2(price, yr) AS r2, count(*)::DOUBLE AS n FROM y GROUP BY 1 HAVING count(*) >= 3)
SELECT area, round(slope, 6) AS slope, round(r2, 6) AS r_squared, n::BIGINT AS points, CASE WHEN sqrt(r2 * (n - 2) / (1 - r2)) > {_tcrit('(n - 2)')} THEN CASE WHEN slope > 0 THEN 'increasing' ELSE 'decreasing' END ELSE 'stable' END AS trend FROM g""")
def _(t):
    y = t.orders.groupBy(F.col("o_custkey").alias("area"), F.year("o_orderdate").alias("yr")).agg(F.sum("o_totalprice").alias("price"))
    return X.linear_trends(y, "area", "yr", "price").withColumns({"slope": r(F.col("slope"), 6), "r_squared": r(F.col("r_squared"), 6)})


@query("t_test", "2.15-08", sql=f"""
WITH s AS (SELECT count(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS n1, count(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS n2, avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS m1,
  avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS m2, var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS v1, var_samp(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS v2 FROM orders),
 t AS (SELECT *, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) AS t, n1 + n2 - 2 AS df FROM s)
SELECT n1, n2, round(m1, 4) AS m1, round(m2, 4) AS m2, round(t, 7) AS t, df, abs(t) > {_tcrit('df')} AS significant FROM t""")
def _(t):
    d = X.t_test(t.orders, "o_orderstatus", "o_totalprice", "F", "O")
    return d.withColumns({"m1": r(F.col("m1"), 4), "m2": r(F.col("m2"), 4), "t": r(F.col("t"), 7)})


@query("chi_square", "2.15-09", sql="""
WITH c AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*)::DOUBLE AS o FROM orders GROUP BY 1, 2), r AS (SELECT a, sum(o) AS r FROM c GROUP BY 1), k AS (SELECT b, sum(o) AS c FROM c GROUP BY 1),
 n AS (SELECT sum(o) AS n FROM c), e AS (SELECT r.a, k.b, r * k.c / n AS e, coalesce(o, 0) AS o FROM r CROSS JOIN k CROSS JOIN n LEFT JOIN c ON c.a = r.a AND c.b = k.b)
SELECT round(sum(pow(o - e, 2) / e), 6) AS chi2, 8::BIGINT AS df, sum(o)::BIGINT AS n, sum(pow(o - e, 2) / e) > 15.507 AS significant FROM e""")
def _(t):
    return X.chi_square(t.orders, "o_orderstatus", "o_orderpriority").withColumn("chi2", r(F.col("chi2"), 6))


@query("chi_square_two_by_two", "2.15-09", sql="""
WITH c AS (SELECT quality AS a, toxic AS b, count(*)::DOUBLE AS o FROM labels GROUP BY 1, 2), r AS (SELECT a, sum(o) AS r FROM c GROUP BY 1), k AS (SELECT b, sum(o) AS c FROM c GROUP BY 1),
 n AS (SELECT sum(o) AS n FROM c), e AS (SELECT r.a, k.b, r * k.c / n AS e, coalesce(o, 0) AS o FROM r CROSS JOIN k CROSS JOIN n LEFT JOIN c ON c.a = r.a AND c.b = k.b)
SELECT round(sum(pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e), 7) AS chi2, 1::BIGINT AS df, sum(o)::BIGINT AS n, sum(pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e) > 3.841 AS significant FROM e""")
def _(t):
    return X.chi_square(t.labels, "quality", "toxic").withColumn("chi2", r(F.col("chi2"), 7))


@query("anova", "2.15-10", sql="""
WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders GROUP BY 1), t AS (SELECT avg(o_totalprice) AS gm, count(*) AS nn FROM orders)
SELECT round(sum(n * pow(m - gm, 2)) / (count(*) - 1) / (sum(n * v) / (any_value(nn) - count(*))), 6) AS f, count(*) - 1 AS df_between, any_value(nn) - count(*) AS df_within FROM g, t""")
def _(t):
    return X.anova(t.orders, "o_orderpriority", "o_totalprice").withColumn("f", r(F.col("f"), 6))


def _tail(z):
    coef = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    t = f"(1 / (1 + 0.5 * abs({z}) / sqrt(2)))"
    poly = str(coef[-1])
    for c in reversed(coef[:-1]):
        poly = f"(({poly}) * tt + ({c}))"
    return t, poly


_T, _POLY = _tail("z")


def _normal_sql(column, dev):
    return f"""WITH s AS (SELECT avg({column}) AS m, {dev}({column}) AS s FROM orders), z AS (SELECT ({column} - m) / s AS z FROM orders, s),
 k AS (SELECT z, row_number() OVER (ORDER BY z) AS rn, count(*) OVER () AS n, {_T} AS tt FROM z),
 u AS (SELECT *, tt * exp(-z * z / 2 + {_POLY}) / 2 AS h FROM k), p AS (SELECT *, CASE WHEN z >= 0 THEN h ELSE 1 - h END AS up, CASE WHEN z >= 0 THEN 1 - h ELSE h END AS low FROM u)"""


@query("normality_ks", "2.15-11", sql=_normal_sql("o_totalprice", "stddev_pop") + """
SELECT round(max(greatest(rn / n::DOUBLE - low, low - (rn - 1) / n::DOUBLE)), 7) AS statistic, max(n) AS n, max(greatest(rn / n::DOUBLE - low, low - (rn - 1) / n::DOUBLE)) <= 1.358 / sqrt(max(n)) AS is_normal FROM p""")
def _(t):
    return X.ks_normality(t.orders, "o_totalprice").withColumn("statistic", r(F.col("statistic"), 7))


@query("normality_anderson_darling", "2.15-12", sql=_normal_sql("o_totalprice", "stddev_samp") + """
SELECT round(-max(n) - sum((2 * rn - 1) * ln(low) + (2 * n + 1 - 2 * rn) * ln(up)) / max(n), 4) AS statistic, max(n) AS n, round(0.787 / (1 + 4.0 / max(n) - 25.0 / pow(max(n), 2)), 3) AS critical,
  -max(n) - sum((2 * rn - 1) * ln(low) + (2 * n + 1 - 2 * rn) * ln(up)) / max(n) <= 0.787 AS is_normal FROM p""")
def _(t):
    return X.anderson_darling(t.orders, "o_totalprice").withColumn("statistic", r(F.col("statistic"), 4))


@query("cluster_scan", "2.15-13")
def _(t):
    whole = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull())
    d = t.embeddings.filter(whole).select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    return X.cluster_scan(d, ["v"]).select("vec_id", "cluster", "cluster_size", "anomalous")


@query("stratified_sample", "2.15-14", sql=with_sql(AREAS, """
h AS (SELECT area_id, state_code, row_number() OVER (PARTITION BY state_code ORDER BY md5(area_id || '|42'), area_id) AS rn, count(*) OVER (PARTITION BY state_code) AS n, count(*) OVER () AS a FROM areas)""") + """
SELECT area_id, state_code FROM h WHERE rn <= greatest(1, floor(least(200, a) * n / a::DOUBLE))""")
def _(t):
    return X.stratified_sample(areas(t).select("area_id", "state_code"), "state_code", "area_id", 200)


@query("distribution_checks", "2.15-15", sql=with_sql(LABOUR) + """
SELECT area_id, NOT employed_full_time / people::DOUBLE BETWEEN 0.45 AND 0.55 AS sex_imbalance, abs(managers * 20.0 + professionals * 20.0 + labourers * 20.0 - 100) > 1 AS age_sum_off,
  NOT people * 9 BETWEEN 0 AND 100 AS people_pct_invalid FROM labour""")
def _(t):
    d = labour(t).withColumns({"a": F.col("managers") * 20.0, "b": F.col("professionals") * 20.0, "c": F.col("labourers") * 20.0, "people_pct": F.col("people") * 9})
    flags = X.distribution_flags("employed_full_time", "people", ["a", "b", "c"], ["people_pct"])
    return d.select("area_id", *[c.alias(n) for n, c in flags.items()])


@query("expected_spread", "2.15-16", sql="""
SELECT 'smoking_rate' AS "column", round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS deviation, count(*) AS n, avg(l_quantity) BETWEEN 10 AND 20 AS mean_ok, stddev_pop(l_quantity) BETWEEN 2 AND 8 AS deviation_ok FROM lineitem""")
def _(t):
    d = X.spread_checks(t.lineitem.select(F.col("l_quantity").alias("smoking_rate")))
    return d.withColumns({"mean": r(F.col("mean"), 6), "deviation": r(F.col("deviation"), 6)})


@query("variance_and_uniformity", "2.15-17", sql=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", round(stddev_pop({c}) / abs(avg({c})), 6) AS cv, round(max(k) / sum(k)::DOUBLE, 8) AS top_share, stddev_pop({c}) / abs(avg({c})) > 2 AS high_variance, max(k) / sum(k)::DOUBLE > 0.8 AS uniform
FROM (SELECT {c}, count(*) OVER (PARTITION BY {c}) AS kk, 1 AS one FROM {t}) x JOIN (SELECT {c} AS v, count(*) AS k FROM {t} GROUP BY 1) y ON v = {c}""".replace("sum(k)", "count(*)") for c, t in (("l_quantity", "lineitem"), ("l_tax", "lineitem"))))
def _(t):
    u = X.uniformity(t.lineitem, ["l_quantity", "l_tax"])
    return u.withColumns({"cv": r(F.col("cv"), 6), "top_share": r(F.col("top_share"))})


@query("morans_i", "2.15-18", sql=with_sql(BOXES, """
p AS (SELECT a.people AS x, b.people AS y FROM boxes a JOIN boxes b ON a.box_id <> b.box_id AND NOT (a.x1 < b.x0 OR a.x0 > b.x1 OR a.y1 < b.y0 OR a.y0 > b.y1)), s AS (SELECT avg(people) AS m, count(*) AS n, sum(pow(people, 2)) - count(*) * pow(avg(people), 2) AS ss FROM boxes)""") + """
SELECT round(any_value(n) / count(*) * sum((x - m) * (y - m)) / any_value(ss), 7) AS morans_i, (SELECT n FROM s) AS n, count(*)::DOUBLE AS weights FROM p, s""")
def _(t):
    b = boxes(t)
    cols = ["x0", "x1", "y0", "y1"]
    o = b.select(F.col("box_id").alias("other"), *[F.col(c).alias(f"o_{c}") for c in cols])
    pairs = P.boxes_meeting(b, o, a_id="box_id", b_id="other", a_box=cols, b_box=[f"o_{c}" for c in cols]).filter("box_id <> other").select(F.col("box_id").alias("a"), F.col("other").alias("b"))
    return X.morans_i(b, pairs, "box_id", "people", "a", "b").withColumn("morans_i", r(F.col("morans_i"), 7))


@query("yearly_means", "2.15-19", sql=with_sql(AREAS, "f AS (SELECT year(o_orderdate)::INTEGER AS year, state, round(o_totalprice * 100)::BIGINT AS v FROM orders JOIN areas ON o_custkey = area_id)") + """
SELECT year, state, round(sum(v)::DOUBLE / count(*), 5) AS mean FROM f GROUP BY 1, 2 UNION ALL SELECT year, 'ALL', round(sum(v)::DOUBLE / count(*), 5) FROM f GROUP BY 1""")
def _(t):
    f = t.orders.join(areas(t).select("area_id", "state"), F.col("o_custkey") == F.col("area_id")).withColumn("v", F.round(F.col("o_totalprice") * 100).cast("long"))
    return X.yearly_means(f, F.year("o_orderdate"), "state", "v").withColumn("mean", r(F.col("mean"), 5))


@query("usage_by_day", "2.16-01", sql="SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS kind, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2")
def _(t):
    return usage.daily_usage(t.events, "ts", "event_type", "value").withColumn("mean", r(F.col("mean"), 6))


@query("usage_stream", "2.16-01", sql="SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS kind, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2")
def _(t):
    """The same counts kept by a stream over the event files."""
    # A pattern, so that the table may be one file or a folder of files.
    stream = t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/event[s].parquet")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    base = scratch_path(t.spark, "usage")
    q = usage.upsert_daily_usage(stream, f"{base}/out", f"{base}/state", ts="ts", kind="event_type", value="value")
    q.awaitTermination()
    kept = t.spark.read.parquet(f"{base}/out")
    return usage.latest_usage(kept).withColumn("mean", r(F.col("mean"), 6))


@query("lookback_stream", "2.16-01", sql="""
WITH d AS (SELECT ts::DATE AS day, event_type AS kind, count(*) AS n, count(value) AS known, sum(value) AS total FROM events GROUP BY 1, 2)
SELECT strftime(day, '%Y-%m-%d') AS day, kind, (sum(n) OVER w)::BIGINT AS n, round(sum(total) OVER w / sum(known) OVER w, 6) AS mean FROM d
WINDOW w AS (PARTITION BY kind ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")
def _(t):
    base = scratch_path(t.spark, "lookback")
    # Four files in no order of time, read one by one.
    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp")).select("ts", "event_type", "value", "event_id")
    rows.repartition(4, "event_id").drop("event_id").write.parquet(f"{base}/in")
    stream = t.spark.readStream.schema(rows.drop("event_id").schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    usage.upsert_lookback(stream, f"{base}/out", f"{base}/state", ts="ts", kind="event_type", value="value", days=7, late="400 days").awaitTermination()
    report = usage.read_lookback(t.spark, f"{base}/out")
    return report.withColumns({"day": F.date_format("day", "yyyy-MM-dd"), "mean": r(F.col("mean"), 6)})
