"""Filling missing values from columns, neighbours and geographic ladders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.operators.common import attach_row
from zonalis.operators.ordering import carried_value, exact_quantiles, neighbours, value_runs
from zonalis.session import materialise

_KEY = "_field"


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def fill_constant(df: DataFrame, values: Mapping[str, object] | float = 0.0) -> DataFrame:
    return df.na.fill(dict(values) if isinstance(values, Mapping) else values)


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., field, value) without nulls; one scan for any number of columns."""
    cells = F.array(*[F.struct(F.lit(c).alias(_KEY), F.col(c).cast("double").alias("_value")) for c in columns])
    return df.select(*keep, F.inline(cells)).filter("_value IS NOT NULL")


def _rolled_up(cells: DataFrame, levels: Sequence[str | None], count: Column) -> DataFrame:
    """(_field, _level, levels..., _value, _c): the values counted once at the finest level and
    added up for every level i of the ladder; of the levels' columns only the i-th is filled."""
    named = [c for c in levels if c]
    fine = cells.groupBy(_KEY, *named, "_value").agg(count.alias("_c"))
    masks = F.array(*[
        F.struct(F.lit(i).alias("_level"), *[(F.col(c) if c == level else F.lit(None).cast(fine.schema[c].dataType)).alias(f"_at_{c}") for c in named])
        for i, level in enumerate(levels)])
    each = fine.select(_KEY, "_value", "_c", F.inline(masks))
    at = [f"_at_{c}" for c in named]
    # Rows without an area at a level take nothing from it.
    here = [F.lit(True) if level is None else (F.col("_level") != i) | F.col(f"_at_{level}").isNotNull() for i, level in enumerate(levels)]
    keep = here[0]
    for h in here[1:]:
        keep = keep & h
    return each.filter(keep).groupBy(_KEY, "_level", *at, "_value").agg(F.sum("_c").alias("_c"))


def _at(levels: Sequence[str | None]) -> list[str]:
    return [_KEY, "_level", *[f"_at_{c}" for c in levels if c]]


def median_stats(df: DataFrame, columns: Sequence[str], levels: Sequence[str | None], **kw) -> DataFrame:
    """Medians of all levels from one sort of the counted values."""
    rolled = _rolled_up(long_form(df, columns, [c for c in levels if c]), levels, F.count(F.lit(1)))
    return exact_quantiles(rolled, "_value", {"_stat": 0.5}, _at(levels), count="_c", **kw)


def mode_stats(df: DataFrame, columns: Sequence[str], levels: Sequence[str | None]) -> DataFrame:
    """Smallest most frequent value; counts first, so no buffer of distinct values."""
    rolled = _rolled_up(long_form(df, columns, [c for c in levels if c]), levels, F.count(F.lit(1)))
    return rolled.groupBy(*_at(levels)).agg(F.min_by("_value", F.struct((-F.col("_c")).alias("n"), F.col("_value"))).alias("_stat"))


def _weighted_cells(df: DataFrame, columns: Sequence[str], weight: str, group: Sequence[str]) -> DataFrame:
    """Values with their weights `_w`; zero weights count as one."""
    base = df.withColumn("_w", F.when(F.coalesce(F.col(weight), F.lit(0)) == 0, 1.0)
                         .otherwise(F.col(weight).cast("double")))
    return long_form(base, columns, [*group, "_w"])


def _past_half(runs: DataFrame, by: Sequence[str]) -> DataFrame:
    """First value whose running weight passes half of the total."""
    past_half = F.col("_cum") > F.col("_total") / 2
    return runs.groupBy(*by).agg(F.coalesce(F.min(F.when(past_half, F.col("_value"))), F.max("_value")).alias("_stat"))


def weighted_median_stats(df: DataFrame, columns: Sequence[str], weight: str, levels: Sequence[str | None], **kw) -> DataFrame:
    """Weighted medians of all levels from one sort of the added weights."""
    rolled = _rolled_up(_weighted_cells(df, columns, weight, [c for c in levels if c]), levels, F.sum("_w"))
    return _past_half(value_runs(rolled, "_value", _at(levels), weight="_c", **kw), _at(levels))


def weighted_median_table(df: DataFrame, columns: Sequence[str], weight: str, group: Sequence[str], suffix: str, **kw) -> DataFrame:
    """A column per weighted median and a row per group."""
    by = [_KEY, *group]
    stat = _past_half(value_runs(_weighted_cells(df, columns, weight, group), "_value", by, weight="_w", **kw), by)
    return stat.groupBy(*group).agg(*[F.max(F.when(F.col(_KEY) == c, F.col("_stat"))).alias(f"{c}{suffix}") for c in columns])


def _ladder(df, columns, levels, stats, last_resort):
    """Nulls filled from the first level that has a statistic; stats(df, columns, levels)
    gives those of all levels, a row per field and area, which are written once."""
    found = materialise(stats(df, columns, levels), "ladder")
    out = df
    fills: dict[str, list] = {c: [F.col(c).cast("double")] for c in columns}
    for i, level in enumerate(levels):
        picks = [F.max(F.when(F.col(_KEY) == c, F.col("_stat"))).alias(f"{c}_l{i}") for c in columns]
        mine = found.filter(F.col("_level") == i)
        if level:
            out = out.join(mine.groupBy(F.col(f"_at_{level}").alias(level)).agg(*picks), level, "left")
        else:
            out = attach_row(out, mine.agg(*picks))
        for c in columns:
            fills[c].append(F.col(f"{c}_l{i}"))
    if last_resort is not None:
        for c in columns:
            fills[c].append(F.lit(float(last_resort)))
    out = out.withColumns({c: F.coalesce(*fs) for c, fs in fills.items()})
    return out.select(*df.columns)


def fill_statistic(df: DataFrame, columns: Sequence[str], how: str, **kw) -> DataFrame:
    """Column mean, median or mode for nulls.  The joined side is one aggregate row."""
    if how == "mean":
        stat = df.agg(*[F.avg(c).alias(f"{c}_l0") for c in columns])
        filled = attach_row(df, stat)
        return filled.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"{c}_l0")) for c in columns}).select(
            *df.columns)
    if how == "median":
        return _ladder(df, columns, [None], lambda *a: median_stats(*a, **kw), None)
    if how == "mode":
        return _ladder(df, columns, [None], mode_stats, None)
    raise ValueError(f"unknown fill {how}")


def fill_ladder_median(df: DataFrame, columns: Sequence[str], levels: Sequence[str], *,
                       last_resort: float | None = 0.0, **kw) -> DataFrame:
    """Median of the nearest level that has one, then the whole table's, then the last resort."""
    return _ladder(df, columns, [*levels, None], lambda *a: median_stats(*a, **kw), last_resort)


def fill_ladder_mode(df: DataFrame, columns: Sequence[str], levels: Sequence[str], *,
                     empty_group_is_zero: bool = False) -> DataFrame:
    """Mode of the nearest level.  With `empty_group_is_zero`, a first level without
    any value gives 0 and the ladder stops there."""
    if empty_group_is_zero:
        return _ladder(df, columns, [levels[0]], mode_stats, 0.0)
    return _ladder(df, columns, [*levels, None], mode_stats, 0.0)


def fill_ladder_weighted_median(df: DataFrame, columns: Sequence[str], weight: str, levels: Sequence[str],
                                **kw) -> DataFrame:
    return _ladder(df, columns, [*levels, None],
                   lambda d, cs, ls: weighted_median_stats(d, cs, weight, ls, **kw), 0.0)


def fill_forward(df: DataFrame, column: str, order: Sequence[str], group: Sequence[str] = (), **kw) -> DataFrame:
    return carried_value(df, column, order, group, **kw)


def fill_backward(df: DataFrame, column: str, order: Sequence[str], group: Sequence[str] = (), **kw) -> DataFrame:
    return carried_value(df, column, order, group, backward=True, **kw)


def fill_interpolated(df: DataFrame, column: str, order: Sequence[str], group: Sequence[str] = (), **kw) -> DataFrame:
    """Linear in row order between the known neighbours; open ends stay null."""
    p = neighbours(df, column, order, group, **kw)
    gap = F.col("_next.p") - F.col("_prev.p")
    between = F.col("_prev.v") + (F.col("_next.v") - F.col("_prev.v")) * (F.col("_rn") - F.col("_prev.p")) / gap
    return p.withColumn(column, F.coalesce(F.col(column).cast("double"), F.when(gap > 0, between))).select(*df.columns)


# Fills of indicators an integrated record may lack.
DEFAULT_FILLS = {
    "gp_services_per_1000": 1.5, "bulk_billing_rate": 85.0, "smoking_prevalence": 15.0,
    "obesity_prevalence": 25.0, "median_age": 38.0, "population_density_per_sq_km": 100.0,
}


def fill_defaults(df: DataFrame, defaults: Mapping[str, float] = DEFAULT_FILLS) -> DataFrame:
    """Constant where null, and a flag beside each filled column."""
    have = [c for c in defaults if c in df.columns]
    flags = {f"{c}_interpolated": F.col(c).isNull() for c in have}
    return df.withColumns(flags).withColumns({c: F.coalesce(F.col(c), F.lit(defaults[c])) for c in have})


# Name parts that choose a fill.
CARRIED_NAMES = ("census_year",)
MODE_NAMES = ("geographic_id", "geographic_level")
MEDIAN_PARTS = ("population", "age_", "male", "female")
ZERO_PARTS = ("total_", "count_", "number_")


def fill_by_keyword(df: DataFrame, order: Sequence[str], **kw) -> DataFrame:
    """Years carry forward, area ids take the mode, people counts the median and
    remaining totals zero, chosen by column name."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "float", "double")}

    def named(parts):
        return [c for c in df.columns if c in numeric and c not in order and any(p in c.lower() for p in parts)]

    out = df
    for c in (c for c in CARRIED_NAMES if c in df.columns):
        out = fill_forward(out, c, order, **kw)
    for c in (c for c in MODE_NAMES if c in df.columns):
        counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        top = counts.agg(F.min_by(c, F.struct((-F.col("n")).alias("n"), F.col(c))).alias("_m"))
        out = attach_row(out, top).withColumn(c, F.coalesce(F.col(c), F.col("_m"))).drop("_m")
    people = named(MEDIAN_PARTS)
    if people:
        out = fill_statistic(out, people, "median", **kw)
    totals = named(ZERO_PARTS)
    return (out.na.fill(0, subset=totals) if totals else out).select(*df.columns)
