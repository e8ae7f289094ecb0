"""Summaries: grouped statistics, pivots, profiles, reports over event tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.functions.ratios import row_sum
from zonalis.operators.impute import long_form
from zonalis.operators.common import attach_row
from zonalis.operators.ordering import exact_quantiles, value_runs

N = "n"


def count_rows() -> Column:
    return F.count(F.lit(1))


STATS = {
    "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "count": F.count, "sum": F.sum,
}


def grouped_stats(df: DataFrame, by: Sequence[str], stats: Mapping[str, Sequence[str]], places: int | None = None) -> DataFrame:
    """<column>_<stat> per group; `by` may be empty."""
    out = []
    for c, names in stats.items():
        for s in names:
            e = STATS[s](c)
            out.append((F.round(e, places) if places is not None and s != "count" else e).alias(f"{c}_{s}"))
    return df.groupBy(*by).agg(*out)


def pivot_mean(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, value: str) -> DataFrame:
    return df.groupBy(*rows).pivot(column, list(values)).agg(F.avg(value))


def pivot_count(df: DataFrame, rows: Sequence[str], column: str, values: Sequence) -> DataFrame:
    return df.groupBy(*rows).pivot(column, list(values)).agg(count_rows()).na.fill(0)


def describe(df: DataFrame, columns: Sequence[str], **kw) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column."""
    cells = long_form(df, columns).withColumnsRenamed({"_field": "column", "_value": "value"})
    base = cells.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(cells, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["column"], **kw).drop("_n")
    return base.join(q, "column")


def area_aggregate(df: DataFrame, area: str, methods: Mapping[str, str], weight: str | None = None, *,
                   ignore_nulls: bool = False, **kw) -> DataFrame:
    """One value per indicator by its method; unknown methods mean the mean.

    A weighted mean keeps the weights of null values in the denominator unless
    `ignore_nulls`.
    """
    aggs, medians = [], []
    for c, how in methods.items():
        if how == "median":
            medians.append(c)
        elif how == "weighted_mean":
            w = F.when(F.col(c).isNotNull(), F.col(weight)) if ignore_nulls else F.col(weight)
            total = F.sum(w)
            aggs.append(F.when(total != 0, F.sum(F.col(c) * F.col(weight)) / total).alias(c))
        else:
            aggs.append({"max": F.max, "min": F.min, "sum": F.sum}.get(how, F.avg)(c).alias(c))
    out = df.groupBy(area).agg(*(aggs or [count_rows().alias("_rows")]))
    for c in medians:
        q = exact_quantiles(df, c, {f"{c}_": 0.5}, [area], **kw).select(area, F.col(f"{c}_").alias(c))
        out = out.join(q, area, "left")
    return out.select(area, *methods)


def correlations(df: DataFrame, pairs: Mapping[str, tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[F.corr(a, b).alias(n) for n, (a, b) in pairs.items()])


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_a, column_b, corr, n) over rows where both are present, in one scan."""
    aggs = []
    for a, b in combinations(columns, 2):
        aggs.append(F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.corr(a, b).alias("corr"),
                             F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias("pairs")))
    return df.agg(F.array(*aggs).alias("m")).select(F.inline("m"))


def value_range(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[f.alias(f"_{n}_{c}") for c in columns for n, f in (("lo", F.min(c)), ("hi", F.max(c)))])


def _bin(c: str, bins: int) -> Column:
    """0-based equal-width bin; the top value belongs to the last bin."""
    lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
    width = (hi - lo) / bins
    at = F.floor((F.col(c) - lo) / F.when(width > 0, width))
    return F.greatest(F.lit(0), F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    rng = value_range(df, column)
    binned = attach_row(df.filter(F.col(column).isNotNull()), rng)
    return binned.groupBy(*by, _bin(column, bins).alias("bin")).agg(count_rows().alias(N))


def heat_map(df: DataFrame, x: str, y: str, z: str, x_bins: int = 10, y_bins: int = 10) -> DataFrame:
    rng = value_range(df, x, y)
    d = attach_row(df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()), rng)
    return d.groupBy(_bin(x, x_bins).alias("x_bin"), _bin(y, y_bins).alias("y_bin")).agg(
        F.sum(z).alias("z_sum"), count_rows().alias(N))


def equal_width_bins(df: DataFrame, column: str, bins: int = 5, out: str = "bin") -> DataFrame:
    """1-based right-closed bins over the column's range, lowest value included."""
    rng = value_range(df, column)
    lo, hi = F.col(f"_lo_{column}"), F.col(f"_hi_{column}")
    width = (hi - lo) / bins
    at = F.greatest(F.lit(1), F.ceil((F.col(column) - lo) / F.when(width > 0, width)))
    return attach_row(df, rng).withColumn(
        out, F.when(F.col(column).isNotNull(), F.least(F.coalesce(at, F.lit(1)), F.lit(bins)).cast("int"))).select(
        *df.columns, out)


def box_stats(df: DataFrame, value: str, by: Sequence[str], k: float = 1.5, **kw) -> DataFrame:
    """Quartiles per group and the whiskers inside k interquartile ranges."""
    q = exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, **kw).drop("_n")
    spread = F.col("q3") - F.col("q1")
    inside = F.col(value).between(F.col("q1") - k * spread, F.col("q3") + k * spread)
    d = df.select(*by, value).join(q, list(by))
    whiskers = d.groupBy(*by).agg(
        F.min(F.when(inside, F.col(value))).alias("low_whisker"), F.max(F.when(inside, F.col(value))).alias("high_whisker"),
        F.count(F.when(~inside, 1)).alias("outliers"))
    return q.join(whiskers, list(by))


def column_profile(df: DataFrame, columns: Sequence[str], **kw) -> DataFrame:
    """count, filled, completeness, distinct, uniqueness and numeric statistics per column."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "float", "double", "short")}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.when(F.col(c).cast("string") != "", F.col(c).cast("string"))
                               .alias("text")) for c in columns])
    long = df.select(F.inline(cells))
    counts = long.groupBy("column", "text").agg(count_rows().alias("k"))
    filled = F.sum(F.when(F.col("text").isNotNull(), F.col("k")))
    base = counts.groupBy("column").agg(
        F.sum("k").alias("rows"), F.coalesce(filled, F.lit(0)).alias("filled"),
        F.count("text").alias("distinct_values"))
    base = base.withColumn("completeness", F.col("filled") / F.col("rows")).withColumn(
        "uniqueness", F.coalesce(F.try_divide(F.col("distinct_values"), F.col("filled")), F.lit(0.0)))
    nums = [c for c in columns if c in numeric]
    if not nums:
        return base
    d = describe(df, nums, **kw).select("column", "min", "max", "mean", "median", "std")
    return base.join(d, "column", "left")


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The k most common values of each column, ties by value."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.inline(cells)).filter("value IS NOT NULL").groupBy("column", "value").agg(count_rows().alias(N))
    w = Window.partitionBy("column").orderBy(F.desc(N), "value")
    return counts.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def completeness(df: DataFrame, domains: Mapping[str, Sequence[str]], threshold: float = 0.85) -> DataFrame:
    """Non-null share per domain, and whether the mean over domains passes."""
    shares = {d: row_sum([F.avg(F.col(c).isNotNull().cast("int")) for c in cs]) / len(cs) for d, cs in domains.items()}
    one = df.agg(*[e.alias(d) for d, e in shares.items()])
    overall = row_sum([F.col(d) for d in domains]) / len(domains)
    return one.withColumn("overall", overall).withColumn("passed", F.col("overall") >= threshold)


def value_share(df: DataFrame, column: str, limit: float = 0.8) -> DataFrame:
    """The commonest value, its share, and whether it exceeds the limit."""
    c = df.filter(F.col(column).isNotNull()).groupBy(column).agg(count_rows().alias("_k"))
    top = c.agg(F.max_by(column, F.struct("_k", column)).alias("value"), F.max("_k").alias("_k"), F.sum("_k").alias("_total"))
    share = F.col("_k") / F.col("_total")
    return top.select(F.col("value").cast("string").alias("value"), share.alias("share"), (share > limit).alias("dominant"))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(count_rows().alias(N))


def usage_report(events: DataFrame, ts: str, kind: str, fmt: Column, value: str, start, end) -> DataFrame:
    """Counts in a time range by kind and by format, mean metric, feedback count
    and mean, as (section, item, n, mean) rows from one grouped scan."""
    inside = events.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))
    base = inside.groupBy(F.col(kind).alias("kind"), fmt.alias("format")).agg(
        count_rows().alias("k"), F.sum(value).alias("s"), F.count(value).alias("c"))

    def section(name, item, rows):
        return rows.groupBy(item.alias("item")).agg(F.sum("k").alias(N), (F.sum("s") / F.sum("c")).alias("mean")).select(
            F.lit(name).alias("section"), "item", N, "mean")

    return (section("total", F.lit("all"), base).unionByName(section("kind", F.col("kind"), base))
            .unionByName(section("format", F.col("format"), base)))


def operation_stats(df: DataFrame, name: str, ok: Column, duration: str, ts: str, since, until) -> DataFrame:
    hours = (F.unix_timestamp(F.lit(until).cast("timestamp")) - F.unix_timestamp(F.lit(since).cast("timestamp"))) / 3600
    d = df.filter((F.col(ts) >= F.lit(since)) & (F.col(ts) < F.lit(until)))
    return d.groupBy(name).agg(
        count_rows().alias(N), F.avg(ok.cast("int")).alias("success_rate"), F.avg(duration).alias("avg_duration"),
        F.min(duration).alias("min_duration"), F.max(duration).alias("max_duration"), F.sum(duration).alias("total_duration"),
        (count_rows() / hours).alias("per_hour"))


def duration_percentiles(df: DataFrame, name: str, duration: str, **kw) -> DataFrame:
    """p50-p99, share outside 1.5 interquartile ranges, and CV % per operation."""
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    q = exact_quantiles(df, duration, probs, [name], **kw)
    spread = F.col("p75") - F.col("p25")
    out = ~F.col(duration).between(F.col("p25") - 1.5 * spread, F.col("p75") + 1.5 * spread)
    d = df.select(name, duration).join(q.select(name, "p25", "p75"), name)
    extra = d.groupBy(name).agg(F.avg(out.cast("int")).alias("outlier_share"),
                                (F.stddev_pop(duration) / F.avg(duration) * 100).alias("cv_pct"))
    return q.select(name, "p50", "p75", "p90", "p95", "p99").join(extra, name)


def regression_check(df: DataFrame, name: str, ts: str, duration: str, ok: Column, split, *,
                     slower: float = 0.2, drop: float = 0.05) -> DataFrame:
    """Recent window against baseline: >20 % slower or >5 points fewer successes."""
    recent = F.col(ts) >= F.lit(split)
    s = df.groupBy(name).agg(
        F.avg(F.when(~recent, F.col(duration))).alias("base_avg"), F.avg(F.when(recent, F.col(duration))).alias("recent_avg"),
        F.avg(F.when(~recent, ok.cast("int"))).alias("base_ok"), F.avg(F.when(recent, ok.cast("int"))).alias("recent_ok"))
    return s.withColumn("slower", F.col("recent_avg") > F.col("base_avg") * (1 + slower)).withColumn(
        "less_successful", F.col("recent_ok") < F.col("base_ok") - drop)


def query_patterns(df: DataFrame, text: str, duration: str) -> DataFrame:
    """Statements grouped by shape: quoted and numeric literals become '?'."""
    shape = F.regexp_replace(F.regexp_replace(text, r"'[^']*'", "?"), r"\b\d+\b", "?")
    verb = F.upper(F.regexp_extract(F.col(text), r"^\s*(\w+)", 1))
    kind = F.when(verb.isin("SELECT", "INSERT", "UPDATE", "DELETE"), verb).otherwise("OTHER")
    return df.groupBy(shape.alias("pattern"), kind.alias("kind")).agg(
        count_rows().alias(N), F.avg(duration).alias("avg_duration"), F.max(duration).alias("max_duration"),
        F.sum(duration).alias("total_duration"))


def coverage_totals(df: DataFrame, area: str, state: str, population: str, states: DataFrame, *,
                    expected_population: float, expected_areas: int, covered: Column | None = None) -> DataFrame:
    """Population within 10 %, area count within 5 %, and number of states without rows
    (with `covered`, without rows for which it holds); the totals are those of all rows."""
    t = df.agg(F.sum(population).alias("population"), F.count_distinct(area).alias("areas"))
    there = df if covered is None else df.filter(covered)
    missing = states.join(there.select(state).distinct(), state, "left_anti").agg(count_rows().alias("missing_states"))
    t = attach_row(t, missing)
    return t.withColumn("population_ok", F.abs(F.col("population") / expected_population - 1) <= 0.10).withColumn(
        "areas_ok", F.abs(F.col("areas") / expected_areas - 1) <= 0.05)


def group_code_check(df: DataFrame, kind: str, code: str, expected: Mapping[str, int]) -> DataFrame:
    """Rows, distinct and repeated codes per area type, against the expected count."""
    per = df.groupBy(kind, code).agg(count_rows().alias("_k"))
    want = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])
    return per.groupBy(kind).agg(F.sum("_k").alias("rows"), count_rows().alias("codes"),
                                 F.count_if(F.col("_k") > 1).alias("repeated")).withColumn(
        "count_ok", F.coalesce(F.col("codes") == F.try_element_at(want, F.col(kind)), F.lit(False)))


def climate_stats(df: DataFrame, by: Sequence[str], t_max: str, t_min: str, rain: str, wind: str, **kw) -> DataFrame:
    """Temperature, rain and wind statistics per area and month."""
    d = df.groupBy(*by).agg(
        F.avg(t_max).alias("mean_max"), F.max(t_max).alias("highest"), F.min(t_min).alias("lowest"),
        F.count_if(F.col(t_max) > 35).alias("days_over_35"), F.count_if(F.col(t_max) > 40).alias("days_over_40"),
        F.count_if(F.col(t_min) < 0).alias("days_below_0"), F.count_if(F.col(t_min) < -5).alias("days_below_minus_5"),
        F.avg(rain).alias("mean_rain"), F.count_if(F.col(rain) > 1).alias("rain_days_1"),
        F.count_if(F.col(rain) > 10).alias("rain_days_10"), F.count_if(F.col(rain) > 25).alias("rain_days_25"),
        (F.avg(F.col(t_max).isNotNull().cast("int")) * 100).alias("completeness_pct"))
    q = exact_quantiles(df, rain, {"median_rain": 0.5, "p10_rain": 0.1, "p90_rain": 0.9}, by, **kw).drop("_n")
    winds = df.filter(F.col(wind).isNotNull()).groupBy(*by, wind).agg(count_rows().alias("_k"))
    usual = winds.groupBy(*by).agg(F.min_by(wind, F.struct((-F.col("_k")).alias("k"), F.col(wind))).alias("prevailing_wind"))
    return d.join(q, list(by), "left").join(usual, list(by), "left")


def mortality_stats(df: DataFrame, by: Sequence[str], deaths: str, sex: str, band: str, cause: str,
                    bands: Sequence[str], causes: Sequence[str], population: str, *, life_years: float = 75.0,
                    age: str | None = None) -> DataFrame:
    """Deaths by sex, age band and cause group, crude rate per 100,000 and years of life lost."""
    d = F.col(deaths)
    aggs = [F.sum(d).alias("total_deaths")]
    aggs += [F.coalesce(F.sum(F.when(F.col(sex) == s, d)), F.lit(0)).alias(f"deaths_{s.lower()}") for s in ("Male", "Female")]
    aggs += [F.coalesce(F.sum(F.when(F.col(band) == b, d)), F.lit(0)).alias(f"deaths_{b.replace('-', '_').replace('+', '_plus')}") for b in bands]
    aggs += [F.coalesce(F.sum(F.when(F.col(cause) == c, d)), F.lit(0)).alias(f"cause_{c.lower()}") for c in causes]
    aggs.append(F.max(population).alias("population"))
    if age:
        aggs.append(F.sum(d * F.greatest(F.lit(life_years) - F.col(age), F.lit(0.0))).alias("years_of_life_lost"))
    s = df.groupBy(*by).agg(*aggs)
    return s.withColumn("crude_rate", F.when(F.col("population") > 0, F.col("total_deaths") / F.col("population") * 100000)
                        .otherwise(0.0))


def gini(df: DataFrame, value: str, by: Sequence[str] = (), **kw) -> DataFrame:
    """Gini coefficient per group: Σ(2i−n−1)x / (n·Σx) over ascending positions."""
    runs = value_runs(df.select(*by, value), value, by, **kw)
    c, n = F.col("_c"), F.col("_total")
    # Σ(2i−n−1) over a run of equal values that ends at position _cum.
    top = F.sum(F.col(value) * c * (2 * F.col("_cum") - c - n))
    low = F.max(n) * F.sum(F.col(value) * c)
    return runs.groupBy(*by).agg(F.when(low != 0, top / low).alias("gini"))


def index_aggregate(df: DataFrame, by: Sequence[str], score: str, decile: str, population: str, **kw) -> DataFrame:
    """Count, population, spread, median, Gini and decile/quintile counts of scores per group."""
    d = df.filter(F.col(score).isNotNull())
    deciles = [F.count_if(F.col(decile) == i).alias(f"decile_{i}") for i in range(1, 11)]
    quintiles = [F.count_if(F.ceil(F.col(decile) / 2) == i).alias(f"quintile_{i}") for i in range(1, 6)]
    base = d.groupBy(*by).agg(
        count_rows().alias("areas"), F.sum(population).alias("population"), F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("sd"), F.min(score).alias("min"), F.max(score).alias("max"), *deciles, *quintiles)
    med = exact_quantiles(d, score, {"median": 0.5}, by, **kw).drop("_n")
    return base.join(med, list(by)).join(gini(d, score, by, **kw), list(by))


def indicator_summary(df: DataFrame, area: str, parent: str, kind: str, value: str) -> DataFrame:
    """Per area: rows and mean by indicator kind, against its parent's and the national mean."""
    sums = df.groupBy(parent, area, kind).agg(count_rows().alias(N), F.sum(value).alias("_s"), F.count(value).alias("_c"))
    up = sums.groupBy(parent, kind).agg((F.sum("_s") / F.sum("_c")).alias("_parent_mean"))
    nation = sums.groupBy(kind).agg((F.sum("_s") / F.sum("_c")).alias("_national_mean"))
    out = sums.withColumn("mean", F.col("_s") / F.col("_c")).join(up, [parent, kind]).join(nation, kind)
    return out.select(parent, area, kind, N, "mean", (F.col("mean") - F.col("_parent_mean")).alias("vs_parent"),
                      (F.col("mean") - F.col("_national_mean")).alias("vs_nation"))


def top_causes(df: DataFrame, by: Sequence[str], cause: str, k: int = 3) -> DataFrame:
    """The k most frequent causes per group as one ordered list."""
    c = df.groupBy(*by, cause).agg(count_rows().alias(N))
    w = Window.partitionBy(*by).orderBy(F.desc(N), cause)
    top = c.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= k)
    return top.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", cause))),
                                                         lambda s: s[cause]), ",").alias("top_causes"))


def row_completeness(columns: Sequence[str]) -> tuple[Column, Column]:
    """(share of the columns that are filled in %, names of the others)."""
    share = row_sum([F.col(c).isNotNull().cast("int") for c in columns]) / len(columns) * 100
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in columns]))
    return share, missing
