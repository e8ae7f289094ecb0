"""Outliers, tests, trends and clusters as aggregates and ranked scans.

Without a solver for p-values, tests give the statistic, its degrees of freedom
and a comparison with the 5 % critical value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.operators.common import attach_row
from zonalis.operators.ordering import exact_quantiles, positions, value_runs
from zonalis.session import materialise


def _known(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))


# --- critical values -----------------------------------------------------------------


# Two-sided 5 % points of Student's t for few degrees of freedom.
SMALL_T = {1: 12.706204736, 2: 4.302652730, 3: 3.182446305, 4: 2.776445105, 5: 2.570581836, 6: 2.446911851}


def critical_t(df: Column) -> Column:
    """Two-sided 5 % point of Student's t: tabled up to 6, then the published series in 1/df."""
    z = 1.959963984540054
    terms = [(z ** 3 + z) / 4, (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96, (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384]
    n = df.cast("double")
    series = F.lit(z)
    for i, g in enumerate(terms, 1):
        series = series + g / F.pow(n, F.lit(i))
    out = F.when(n < 1, None)
    for d, t in SMALL_T.items():
        out = out.when(n == d, t)
    return out.otherwise(series)


def critical_chi2(df: Column) -> Column:
    """5 % point of chi-square by the cube-root normal approximation."""
    a = F.lit(2.0) / (9.0 * df)
    return df * F.pow(1 - a + 1.6448536269514722 * F.sqrt(a), F.lit(3))


def normal_tail(z: Column) -> Column:
    """P(Z > z), relative error below 1.2e-7, by the published Chebyshev fit of erfc."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + 0.5 * x)
    # Coefficients of the fit.
    coef = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    poly = F.lit(coef[-1])
    for c in reversed(coef[:-1]):
        poly = poly * t + c
    upper = t * F.exp(-x * x + poly) / 2
    return F.when(z >= 0, upper).otherwise(1 - upper)


# --- outliers ---------------------------------------------------------------------------


def iqr_flags(df: DataFrame, column: str, k: float = 1.5, *, exclusive: bool = False, out: str = "iqr_outlier", **kw) -> DataFrame:
    """Outside k interquartile ranges of the quartiles, from four values up."""
    q = exact_quantiles(df, column, {"_q1": 0.25, "_q3": 0.75}, exclusive=exclusive, **kw)
    d = attach_row(df, q)
    spread = F.col("_q3") - F.col("_q1")
    bad = ~F.col(column).between(F.col("_q1") - k * spread, F.col("_q3") + k * spread) & (F.col("_n") >= 4)
    return d.withColumn(out, F.coalesce(bad, F.lit(False))).select(*df.columns, out)


def zscore_flags(df: DataFrame, column: str, limit: float = 3.0, *, sample: bool = False, out: str = "z_outlier") -> DataFrame:
    """|x − mean| over the limit in deviations, from three values up; no spread, no outlier."""
    d = _known(df, column)
    s = d.agg(F.avg(column).alias("_m"), (F.stddev_samp if sample else F.stddev_pop)(column).alias("_s"), F.count(column).alias("_c"))
    j = attach_row(df, s)
    bad = (F.abs(F.col(column) - F.col("_m")) / F.when(F.col("_s") > 0, F.col("_s")) > limit) & (F.col("_c") >= 3)
    return j.withColumn(out, F.coalesce(bad, F.lit(False))).select(*df.columns, out)


def modified_zscore_flags(df: DataFrame, column: str, limit: float = 3.5, *, out: str = "mod_z_outlier", **kw) -> DataFrame:
    """0.6745·|x − median| / MAD over the limit."""
    med = exact_quantiles(df, column, {"_med": 0.5}, **kw).select("_med")
    d = attach_row(df, med).withColumn("_dev", F.abs(F.col(column) - F.col("_med")))
    mad = exact_quantiles(d.select("_dev"), "_dev", {"_mad": 0.5}, **kw).select("_mad")
    bad = 0.6745 * F.col("_dev") / F.when(F.col("_mad") > 0, F.col("_mad")) > limit
    return attach_row(d, mad).withColumn(out, F.coalesce(bad, F.lit(False))).select(*df.columns, out)


def consensus_outliers(df: DataFrame, column: str, low: float | None = None, high: float | None = None, **kw) -> DataFrame:
    """Rows both the IQR and a z-score method flag (the modified one below 30 values),
    with severity: beyond the absolute bounds, beyond five deviations, or neither."""
    d = iqr_flags(df, column, **kw)
    d = zscore_flags(d, column)
    d = modified_zscore_flags(d, column, **kw)
    s = _known(df, column).agg(F.avg(column).alias("_m"), F.stddev_pop(column).alias("_s"), F.count(column).alias("_c"))
    d = attach_row(d, s)
    second = F.when(F.col("_c") >= 30, F.col("z_outlier")).otherwise(F.col("mod_z_outlier"))
    beyond = F.lit(False)
    if low is not None:
        beyond = beyond | (F.col(column) < low)
    if high is not None:
        beyond = beyond | (F.col(column) > high)
    z = F.abs(F.col(column) - F.col("_m")) / F.when(F.col("_s") > 0, F.col("_s"))
    hit = F.col("iqr_outlier") & second & (F.col("_c") >= 10)
    return d.filter(hit).withColumn("severity", F.when(beyond, "ERROR").when(z > 5, "WARNING").otherwise("INFO")).select(*df.columns, "severity")


def multivariate_outliers(df: DataFrame, columns: Sequence[str], share: float = 0.05, **kw) -> DataFrame:
    """Squared Mahalanobis distance and a flag on the farthest share of complete rows.

    For a bulk of one ellipse; `forest.forest_outliers` takes any shape.
    Means and covariances are one aggregate; only that small matrix is inverted here.
    """
    d = df.na.drop(subset=list(columns))
    n = len(columns)
    aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]
    aggs += [F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i in range(n) for j in range(i, n)]
    row = d.agg(*aggs).first()
    if row["m0"] is None:
        return d.withColumns({"distance2": F.lit(None).cast("double"), "outlier": F.lit(False)})
    cov = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)])
    inv = np.linalg.pinv(cov)
    dev = [F.col(c) - row[f"m{i}"] for i, c in enumerate(columns)]
    dist = sum((dev[i] * dev[j] * float(inv[i, j]) for i in range(n) for j in range(n)), F.lit(0.0))
    d = d.withColumn("distance2", dist)
    cut = exact_quantiles(d, "distance2", {"_cut": 1 - share}, **kw).select("_cut")
    return attach_row(d, cut).withColumn("outlier", F.col("distance2") > F.col("_cut")).drop("_cut")


# --- correlation and trend ----------------------------------------------------------------


# Fixed values: (first, second, expected, tolerance) and (first, second, least, most).
EXPECTED_CORRELATIONS = [
    ("seifa_index_disadvantage", "life_expectancy_at_birth", 0.4, 0.2), ("smoking_rate", "mortality_rate_all_causes", 0.3, 0.2),
    ("obesity_rate", "diabetes_prevalence", 0.5, 0.2), ("population_density", "gp_per_1000_population", -0.2, 0.3),
    ("median_age", "hospital_beds_per_1000", 0.3, 0.2),
]
CORRELATION_LIMITS = [("population_total", "median_age", None, 0.3), ("life_expectancy_male", "life_expectancy_female", 0.7, None)]


def correlation_checks(df: DataFrame, expected: Sequence[tuple] = EXPECTED_CORRELATIONS, limits: Sequence[tuple] = CORRELATION_LIMITS,
                       least_pairs: int = 30) -> DataFrame:
    """Pairs whose correlation strays: (first, second, corr, pairs, significant, severity)."""
    have = set(df.columns)
    both = {(a, b) for a, b, *_ in [*expected, *limits] if {a, b} <= have}
    named = sorted(both)
    aggs = []
    for i, (a, b) in enumerate(named):
        aggs += [F.corr(a, b).alias(f"r{i}"), F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias(f"n{i}")]
    one, cells = df.agg(*aggs), []
    for i, (a, b) in enumerate(named):
        r, n = F.col(f"r{i}"), F.col(f"n{i}")
        t = F.abs(r) * F.sqrt((n - 2) / F.when(1 - r * r > 0, 1 - r * r))
        base = [F.lit(a).alias("first"), F.lit(b).alias("second"), r.alias("corr"), n.alias("pairs"),
                F.coalesce(t > critical_t(n - 2), F.lit(False)).alias("significant")]
        for x, y, want, tol in expected:
            if (x, y) == (a, b):
                wrong = (F.signum(r) * np.sign(want)) < 0
                sev = F.when(F.abs(r - want) > tol, F.when(wrong, "ERROR").otherwise("WARNING"))
                cells.append(F.struct(*base, F.when(n >= least_pairs, sev).alias("severity")))
        for x, y, least, most in limits:
            if (x, y) == (a, b):
                off = F.lit(False)
                if most is not None:
                    off = off | (F.abs(r) > most)
                if least is not None:
                    off = off | (F.abs(r) < least)
                cells.append(F.struct(*base, F.when((n >= least_pairs) & off, "WARNING").alias("severity")))
    return one.select(F.inline(F.array(*cells))).filter("severity IS NOT NULL")


def linear_trends(df: DataFrame, entity: str, x: str, y: str, least: int = 3) -> DataFrame:
    """Slope, r² and direction per entity; stable unless |t| passes the 5 % point."""
    g = df.groupBy(entity).agg(F.regr_slope(y, x).alias("slope"), F.regr_r2(y, x).alias("r_squared"),
                               F.regr_count(y, x).alias("points")).filter(F.col("points") >= least)
    left = 1 - F.col("r_squared")
    t = F.sqrt(F.col("r_squared") * (F.col("points") - 2) / F.when(left > 0, left))
    sure = F.when(left <= 0, F.col("slope") != 0).otherwise(t > critical_t(F.col("points") - 2))
    return g.withColumn("trend", F.when(~F.coalesce(sure, F.lit(False)), "stable").when(F.col("slope") > 0, "increasing").otherwise("decreasing"))


# --- tests -----------------------------------------------------------------------------------


def t_test(df: DataFrame, group: str, value: str, a: str, b: str, least: int = 3) -> DataFrame:
    """Pooled two-sample t."""
    def of(g):
        return F.when(F.col(group) == g, F.col(value))
    s = df.agg(*[f.alias(f"{n}{i}") for i, g in ((1, a), (2, b)) for n, f in (("n", F.count(of(g))), ("m", F.avg(of(g))), ("v", F.var_samp(of(g))))])
    n1, n2 = F.col("n1"), F.col("n2")
    pooled = ((n1 - 1) * F.col("v1") + (n2 - 1) * F.col("v2")) / (n1 + n2 - 2)
    t = (F.col("m1") - F.col("m2")) / F.sqrt(pooled * (1 / n1 + 1 / n2))
    s = s.filter((n1 >= least) & (n2 >= least)).withColumns({"t": t, "df": n1 + n2 - 2})
    return s.select("n1", "n2", "m1", "m2", "t", "df", (F.abs("t") > critical_t(F.col("df"))).alias("significant"))


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency statistic; the continuity correction applies with one degree of freedom."""
    cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("_o"))
    rows = cells.groupBy(a).agg(F.sum("_o").alias("_r"))
    cols = cells.groupBy(b).agg(F.sum("_o").alias("_c"))
    j = cells.join(rows, a).join(cols, b)
    s = j.agg(F.sum("_o").alias("n"), F.sum(F.col("_o") * F.col("_o") / (F.col("_r") * F.col("_c"))).alias("q"),
              F.min_by(F.struct("_o", "_r", "_c"), F.struct(a, b)).alias("corner"))
    s = attach_row(s, rows.agg(F.count(F.lit(1)).alias("k"), F.product(1 / F.col("_r").cast("double")).alias("pr")))
    s = attach_row(s, cols.agg(F.count(F.lit(1)).alias("m"), F.product(1 / F.col("_c").cast("double")).alias("pc")))
    dof = (F.col("k") - 1) * (F.col("m") - 1)
    n = F.col("n").cast("double")
    away = F.abs(F.col("corner._o") - F.col("corner._r") * F.col("corner._c") / n)
    yates = F.pow(away - F.least(F.lit(0.5), away), F.lit(2)) * F.pow(n, F.lit(3)) * F.col("pr") * F.col("pc")
    stat = F.when(dof == 1, yates).otherwise(n * (F.col("q") - 1))
    return s.select(stat.alias("chi2"), dof.alias("df"), "n").withColumn("significant", F.col("chi2") > critical_chi2(F.col("df")))


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """F over groups from their counts, means and variances."""
    g = _known(df, value).filter(F.col(group).isNotNull()).groupBy(group).agg(F.count(value).alias("_n"), F.avg(value).alias("_m"), F.var_pop(value).alias("_v"))
    s = g.agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("k"), F.sum(F.col("_n") * F.col("_m")).alias("s"),
              F.sum(F.col("_n") * F.col("_v")).alias("within"), F.sum(F.col("_n") * F.col("_m") * F.col("_m")).alias("sq"))
    between = F.col("sq") - F.col("s") * F.col("s") / F.col("_n")
    d1, d2 = F.col("k") - 1, F.col("_n") - F.col("k")
    return s.select((between / d1 / (F.col("within") / d2)).alias("f"), d1.alias("df_between"), d2.alias("df_within"))


def _standardised(df: DataFrame, column: str, sample: bool, **kw) -> DataFrame:
    d = _known(df, column).select(F.col(column).cast("double").alias("_x"))
    s = d.agg(F.avg("_x").alias("_m"), (F.stddev_samp if sample else F.stddev_pop)("_x").alias("_s"))
    z = attach_row(d, s).select(((F.col("_x") - F.col("_m")) / F.when(F.col("_s") > 0, F.col("_s"))).alias("_z"))
    return value_runs(z, "_z", **kw)


def ks_normality(df: DataFrame, column: str, **kw) -> DataFrame:
    """Greatest distance between the standardised sample and the normal curve."""
    p = _standardised(df, column, False, **kw)
    below = 1 - normal_tail(F.col("_z"))
    d = F.greatest(F.col("_cum") / F.col("_total") - below, below - (F.col("_cum") - F.col("_c")) / F.col("_total"))
    s = p.agg(F.max(d).alias("statistic"), F.max("_total").cast("long").alias("n"))
    return s.withColumn("is_normal", F.col("statistic") <= 1.358 / F.sqrt("n"))


def anderson_darling(df: DataFrame, column: str, **kw) -> DataFrame:
    """A² of the standardised sample against its 5 % critical value."""
    p = _standardised(df, column, True, **kw)
    up = normal_tail(F.col("_z"))
    low = normal_tail(-F.col("_z"))
    # Σ(2i−1) over a run of c equal values that ends at position _cum.
    c, n = F.col("_c"), F.col("_total")
    odd = c * (2 * F.col("_cum") - c)
    s = p.agg(F.sum(odd * F.ln(low) + (2 * n * c - odd) * F.ln(up)).alias("s"), F.max("_total").cast("long").alias("n"))
    crit = F.round(0.787 / (1 + 4.0 / F.col("n") - 25.0 / (F.col("n") * F.col("n"))), 3)
    a2 = -F.col("n") - F.col("s") / F.col("n")
    return s.select(a2.alias("statistic"), "n", crit.alias("critical"), (a2 <= crit).alias("is_normal"))


# --- clusters, samples, distributions ------------------------------------------------------------


def cluster_scan(df: DataFrame, columns: Sequence[str], k_range: tuple[int, int] = (3, 8), small: float = 0.05, seed: int = 42) -> DataFrame:
    """Rows with their k-means cluster and a flag on clusters below the given share.

    k follows the largest drop in cost between neighbouring k.  The standardised
    features are written once and read by every fit.
    """
    d = df.na.drop(subset=list(columns))
    vec = VectorAssembler(inputCols=list(columns), outputCol="_raw").transform(d)
    scaled = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True).fit(vec).transform(vec).drop("_raw")
    scaled = materialise(scaled, "features")
    models: list[KMeansModel] = [KMeans(k=k, seed=seed).fit(scaled) for k in range(k_range[0], k_range[1] + 1)]
    costs = [m.summary.trainingCost for m in models]
    drops = [costs[i] - costs[i + 1] for i in range(len(costs) - 1)]
    out = models[int(np.argmax(drops)) if drops else 0].transform(scaled).drop("features").withColumnRenamed("prediction", "cluster")
    sizes = out.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"))
    total = sizes.agg(F.sum("cluster_size").alias("_all"))
    flagged = attach_row(sizes, total).select("cluster", "cluster_size", (F.col("cluster_size") < F.col("_all") * small).alias("anomalous"))
    return out.join(F.broadcast(flagged), "cluster")


def stratified_sample(df: DataFrame, stratum: str, key: str, size: int, seed: int = 42, **kw) -> DataFrame:
    """Per stratum its share of `size`, at least one row, in order of a seeded digest of the key.

    Only rows whose digest lies under a cut somewhat above the stratum's quota are kept
    and ordered, not the whole table; strata that chance left short are ordered whole.
    """
    d = df.withColumn("_h", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))))
    counts = df.groupBy(F.col(stratum).alias("_stratum")).agg(F.count(F.lit(1)).alias("_rows"))
    quotas = attach_row(counts, df.agg(F.count(F.lit(1)).alias("_all"))).select(
        "_stratum", "_rows", F.greatest(F.lit(1), F.floor(F.least(F.lit(size), F.col("_all")) * F.col("_rows") / F.col("_all"))).alias("_quota"))
    rows = d.join(quotas, d[stratum].eqNullSafe(quotas["_stratum"])).drop("_stratum")
    wanted = F.col("_quota") + 6 * F.sqrt("_quota") + 20
    # The first 13 hex digits of the digest as a number in [0, 1).
    place = F.conv(F.substring("_h", 1, 13), 16, 10).cast("double") / float(16 ** 13)
    kept = materialise(rows.filter(place <= wanted / F.col("_rows")), "sample")
    enough = kept.groupBy(F.col(stratum).alias("_stratum")).agg(F.count(F.lit(1)).alias("_k"), F.max("_quota").alias("_q")).filter("_k >= _q").select("_stratum")
    enough = materialise(enough, "strata")  # few rows, and both joins below must agree on them
    filled = kept.join(enough, kept[stratum].eqNullSafe(enough["_stratum"]), "left_semi")
    rows = filled.unionByName(rows.join(enough, rows[stratum].eqNullSafe(enough["_stratum"]), "left_anti"))
    p = positions(rows, ["_h", key], [stratum], **kw)
    return p.filter(F.col("_rn") <= F.col("_quota")).select(*df.columns)


def distribution_flags(males: str, total: str, ages_pct: Sequence[str], percentages: Sequence[str], tolerance: float = 0.05) -> dict[str, Column]:
    """Sex balance within tolerance of one half, age shares summing to 100±1, percentages in 0-100."""
    share = F.col(males) / F.when(F.col(total) > 0, F.col(total))
    out = {"sex_imbalance": F.coalesce(~share.between(0.5 - tolerance, 0.5 + tolerance), F.lit(False))}
    if ages_pct:
        s = F.col(ages_pct[0])
        for c in ages_pct[1:]:
            s = s + F.col(c)
        out["age_sum_off"] = F.coalesce(F.abs(s - 100) > 1, F.lit(False))
    for c in percentages:
        out[f"{c}_invalid"] = F.coalesce(~F.col(c).between(0, 100), F.lit(False))
    return out


# Expected (mean low, mean high, deviation low, deviation high).
EXPECTED_SPREAD = {"life_expectancy_at_birth": (78, 85, 1, 5), "smoking_rate": (10, 20, 2, 8)}


def spread_checks(df: DataFrame, expected: Mapping[str, tuple] = EXPECTED_SPREAD, least: int = 30) -> DataFrame:
    """(column, mean, deviation, mean_ok, deviation_ok) from 30 values up."""
    cols = [c for c in expected if c in df.columns]
    one = df.agg(*[f.alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg(c)), ("s", F.stddev_pop(c)), ("n", F.count(c)))])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("deviation"), F.col(f"n_{c}").alias("n"),
                      F.col(f"m_{c}").between(*expected[c][:2]).alias("mean_ok"), F.col(f"s_{c}").between(*expected[c][2:]).alias("deviation_ok")) for c in cols]
    return one.select(F.inline(F.array(*cells))).filter(F.col("n") >= least)


def uniformity(df: DataFrame, columns: Sequence[str], cv_limit: float = 2.0, share_limit: float = 0.8) -> DataFrame:
    """(column, cv, top_share, high_variance, uniform) per numeric column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    counts = df.select(F.inline(cells)).filter("v IS NOT NULL").groupBy("column", "v").agg(F.count(F.lit(1)).alias("k"))
    n, s, q = F.sum("k"), F.sum(F.col("k") * F.col("v")), F.sum(F.col("k") * F.col("v") * F.col("v"))
    g = counts.groupBy("column").agg((F.max("k") / n).alias("top_share"), (s / n).alias("mean"), (q / n - (s / n) * (s / n)).alias("var"))
    cv = F.sqrt(F.greatest(F.col("var"), F.lit(0.0))) / F.abs(F.when(F.col("mean") != 0, F.col("mean")))
    return g.select("column", cv.alias("cv"), "top_share", (cv > cv_limit).alias("high_variance"), (F.col("top_share") > share_limit).alias("uniform"))


def morans_i(values: DataFrame, pairs: DataFrame, key: str, value: str, a: str, b: str, weight: str | None = None) -> DataFrame:
    """Spatial autocorrelation of a value over weighted neighbour pairs."""
    known = _known(values.select(key, value), value)
    s = known.agg(F.avg(value).alias("_m"), F.count(value).alias("n"), (F.var_pop(value) * F.count(value)).alias("ss"))
    dev = attach_row(known, s.select("_m")).select(key, (F.col(value) - F.col("_m")).alias("z"))
    w = F.col(weight) if weight else F.lit(1.0)
    j = (pairs.join(dev.select(F.col(key).alias(a), F.col("z").alias("za")), a).join(dev.select(F.col(key).alias(b), F.col("z").alias("zb")), b))
    t = j.agg(F.sum(w * F.col("za") * F.col("zb")).alias("top"), F.coalesce(F.sum(w), F.lit(0.0)).alias("w"))
    return attach_row(t, s.select("n", "ss")).select((F.col("n") / F.when(F.col("w") != 0, F.col("w")) * F.col("top") / F.col("ss")).alias("morans_i"), "n", F.col("w").alias("weights"))


def yearly_means(df: DataFrame, year: Column, state: str, value: str) -> DataFrame:
    """Mean per year and state, and per year for the nation (state null)."""
    base = df.groupBy(year.alias("year"), F.col(state).alias("state")).agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    nation = base.groupBy("year").agg((F.sum("_s") / F.sum("_c")).alias("mean")).withColumn("state", F.lit("ALL"))
    return base.select("year", "state", (F.col("_s") / F.col("_c")).alias("mean")).unionByName(nation)
