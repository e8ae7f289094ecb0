"""Ranks, deciles, standard scores, surrogate keys and changes over years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.operators.common import attach_row
from zonalis.operators.ordering import exact_quantiles, positions


def _ranked(df: DataFrame, score: str, key: str, within: Sequence[str], prefix: str, bins: Column, **kw) -> DataFrame:
    """Ranks inside `within`; rows without a score get nulls.  Only group, score and key are sorted
    and written; the places come back to the rows by these.  Rows alike in all three share the first
    of their places."""
    names = list(dict.fromkeys([*within, score, key]))
    scored = df.select(*names).filter(F.col(score).isNotNull())
    p = positions(scored, [score, key], within, ties=[score], **kw)
    places = p.groupBy(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(names)]).agg(
        F.min("_rn").alias("_rn"), F.min("_rank").alias("_rank"), F.min("_n").alias("_n"))
    same = None
    for i, c in enumerate(names):
        equal = F.col(c) == F.col(f"_of_{i}") if c == score else F.col(c).eqNullSafe(F.col(f"_of_{i}"))
        same = equal if same is None else same & equal
    joined = df.join(places, same, "left")
    step = F.col("_n") - 1
    ceil = F.when(step > 0, F.floor((bins * (F.col("_rn") - 1) + step - 1) / F.when(step > 0, step)))
    return joined.select(
        *df.columns, F.col("_rank").alias(f"{prefix}_rank"),
        F.when(F.col("_n").isNotNull(), F.greatest(F.lit(1), F.coalesce(ceil, F.lit(1))).cast("int")).alias(f"{prefix}_decile"))


def rank_scores(df: DataFrame, score: str, key: str, *, within: Sequence[str] = (), prefix: str | None = None,
                bins: int = 10, **kw) -> DataFrame:
    """<prefix>_rank: 1 + number of lower scores; <prefix>_decile: bin of the
    first-rank order, max(1, ceil(bins·(r−1)/(n−1))), ties in key order."""
    return _ranked(df, score, key, within, prefix or score, F.lit(bins), **kw)


def rank_within_state(df: DataFrame, score: str, key: str, state: str, *, prefix: str | None = None, **kw) -> DataFrame:
    """Rank and decile inside a state; a state with fewer than ten scores has as many bins."""
    return _ranked(df, score, key, [state], prefix or f"{score}_state", F.least(F.lit(10), F.col("_n")), **kw)


def percent_rank_decile(pct_rank: Column) -> Column:
    """Fallback decile of a share: ten times it, within 1-10, half to even."""
    return F.bround(F.greatest(F.lit(1.0), F.least(pct_rank * 10, F.lit(10.0))), 0).cast("int")


# Quintile labels from the lowest score up.
QUINTILES = ["Most Disadvantaged", "Disadvantaged", "Average", "Advantaged", "Most Advantaged"]


def quintile_labels(df: DataFrame, score: str, labels: Sequence[str] = QUINTILES, out: str = "quintile", **kw) -> DataFrame:
    """Label by exact quantile edges, right-closed; equal scores share a label."""
    k = len(labels)
    edges = exact_quantiles(df, score, {f"_e{i}": i / k for i in range(1, k)}, **kw)
    label = F.when(F.col(score).isNull(), None)
    for i in range(1, k):
        label = label.when(F.col(score) <= F.col(f"_e{i}"), labels[i - 1])
    joined = attach_row(df, edges)
    return joined.withColumn(out, label.otherwise(labels[-1])).select(*df.columns, out)


def z_scores(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """<column>_zscore by population deviation; null with fewer than two values."""
    stats = df.agg(*[f.alias(f"_{n}_{c}") for c in columns
                     for n, f in (("m", F.avg(c)), ("s", F.stddev_pop(c)), ("n", F.count(c)))])
    out = attach_row(df, stats)
    return out.withColumns({
        f"{c}_zscore": F.when((F.col(f"_n_{c}") > 1) & (F.col(f"_s_{c}") > 0),
                              (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")) for c in columns
    }).select(*df.columns, *[f"{c}_zscore" for c in columns])


def surrogate_keys(df: DataFrame, order: Sequence[str], out: str, start: int = 10000, **kw) -> DataFrame:
    return positions(df, order, **kw).withColumn(out, F.col("_rn") + start - 1).drop("_rn", "_n")


def yearly_change(df: DataFrame, area: str, year: str, value: str, threshold: float = 0.15) -> DataFrame:
    """Change per year against the previous year present; one row per (area, year) in."""
    w = Window.partitionBy(area).orderBy(year)
    prev, prev_year = F.lag(value).over(w), F.lag(year).over(w)
    change = F.when(prev > 0, (F.col(value) - prev) / prev / (F.col(year) - prev_year))
    return df.withColumn("annual_change", change).withColumn(
        "unreasonable", F.coalesce(F.abs(change) > threshold, F.lit(False)))


def align_to_year(df: DataFrame, year: str, primary: int) -> DataFrame:
    """Rows of the primary year, or of the nearest year present (the earlier on a tie)."""
    years = df.groupBy(year).agg(F.count(F.lit(1)).alias("_c"))
    chosen = years.agg(F.min_by(year, F.struct(F.abs(F.col(year) - primary), F.col(year))).alias("_chosen"))
    out = attach_row(df, chosen).filter(F.col(year) == F.col("_chosen"))
    return out.withColumn("_temporal_adjustment", F.abs(F.col(year) - F.lit(primary))).drop("_chosen")


# Years an index release is snapped to.
INDEX_YEARS = (2011, 2016, 2021, 2026)


def snap_to_index_year(c: Column, years: Sequence[int] = INDEX_YEARS) -> Column:
    gaps = F.array(*[F.struct(F.abs(c - y).alias("gap"), F.lit(y).alias("year")) for y in years])
    return F.array_min(gaps)["year"]


def entity_trend(df: DataFrame, entity: str, x: str, y: str, *, min_points: int = 5, flat: float = 0.3) -> DataFrame:
    """Correlation, slope and direction per entity; x is the entity's ordered index."""
    s = df.groupBy(entity).agg(F.corr(x, y).alias("corr"), F.regr_slope(y, x).alias("slope"),
                               F.count(F.lit(1)).alias("points"))
    s = s.filter(F.col("points") >= min_points)
    c = F.coalesce(F.when(~F.isnan("corr"), F.col("corr")), F.lit(0.0))
    return s.withColumn("direction", F.when(F.abs(c) < flat, "stable").when(F.col("slope") > 0, "increasing")
                        .otherwise("decreasing"))


def mortality_trend(df: DataFrame, area: str, year: str, rate: str) -> DataFrame:
    """Period, direction, mean yearly change %, fit and coverage; one row per (area, year) in."""
    w = Window.partitionBy(area).orderBy(year)
    prev = F.lag(rate).over(w)
    y = df.withColumn("_chg", F.when(prev > 0, (F.col(rate) - prev) / prev * 100))
    return y.groupBy(area).agg(
        F.min(year).alias("start_year"), F.max(year).alias("end_year"), F.avg("_chg").alias("annual_change_pct"),
        F.regr_slope(rate, year).alias("slope"), F.regr_r2(rate, year).alias("r_squared"),
        (F.count_distinct(year) == F.max(year) - F.min(year) + 1).alias("covers_period"),
    ).withColumn("direction", F.when(F.col("slope") > 0, "increasing").when(F.col("slope") < 0, "decreasing")
                 .otherwise("stable"))


def compare_years(df: DataFrame, key: Sequence[str], year: str, score: str, decile: str, first: int, second: int) -> DataFrame:
    """Score and decile change between two years and its label."""
    a = df.filter(F.col(year) == first).select(*key, F.col(score).alias("score_1"), F.col(decile).alias("decile_1"))
    b = df.filter(F.col(year) == second).select(*key, F.col(score).alias("score_2"), F.col(decile).alias("decile_2"))
    d = F.col("score_2") - F.col("score_1")
    return a.join(b, list(key)).select(
        *key, d.alias("score_difference"), (F.col("decile_2") - F.col("decile_1")).alias("decile_change"),
        F.when(d == 0, "No Change").when(d > 0, "Improvement").otherwise("Decline").alias("direction"))


def recent_score_trend(df: DataFrame, entity: str, order: str, score: str, last: int = 5) -> DataFrame:
    """Direction, mean and variance of the last few scores; the row_number filter
    keeps only those few before any shuffle."""
    w = Window.partitionBy(entity).orderBy(F.col(order).desc())
    recent = df.select(entity, order, score).withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= last)
    s = recent.groupBy(entity).agg(F.min_by(score, order).alias("first"), F.max_by(score, order).alias("latest"),
                                   F.avg(score).alias("mean"), F.var_pop(score).alias("variance"))
    return s.withColumn("trend", F.when(F.col("latest") > F.col("first"), "improving")
                        .when(F.col("latest") < F.col("first"), "declining").otherwise("stable"))
