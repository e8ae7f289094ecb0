"""Aligning dated values to one reference date.

Input rows are (key, field, ts, value, quality); each strategy is an aggregate of
constant size per (key, field).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions.codes import literal_map

# Month factors of the seasonal patterns, January to December.
SEASONAL = {
    "mortality_winter_peak": [1.15, 1.12, 1.08, 1.02, 0.95, 0.90, 0.88, 0.90, 0.95, 1.00, 1.05, 1.10],
    "respiratory_winter_peak": [1.30, 1.25, 1.15, 1.00, 0.85, 0.75, 0.70, 0.75, 0.85, 0.95, 1.10, 1.25],
    "air_quality_seasonal": [1.20, 1.15, 1.05, 0.95, 0.90, 0.85, 0.85, 0.90, 0.95, 1.00, 1.10, 1.15],
    "mental_health_seasonal": [0.95, 0.95, 1.00, 1.05, 1.10, 1.15, 1.15, 1.10, 1.00, 0.95, 0.95, 1.00],
}


def alignment_strategy(field: Column, default: str = "nearest_available", own: Mapping[str, str] | None = None) -> Column:
    by_name = (F.when(field.rlike("population|count"), "interpolation")
               .when(field.rlike("rate|percentage"), "seasonal_adjustment").otherwise(default))
    return F.coalesce(F.try_element_at(literal_map(own), field), by_name) if own else by_name


def align_to_date(df: DataFrame, key: Sequence[str], *, ts: str = "ts", value: str = "value", quality: str = "quality",
                  reference, tolerance_days: int = 365, strategy: Column, pattern: Column | None = None) -> DataFrame:
    """(key, value, confidence, method) per key.

    `strategy` and `pattern` (name of a seasonal pattern, or null) are expressions
    over the key columns.
    """
    ref = F.lit(reference).cast("timestamp")
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    days = F.floor((F.unix_micros(ts) - F.unix_micros(ref)) / 86_400_000_000)
    gap = F.abs(days)
    row = F.struct(F.col(value).alias("v"), F.col(quality).alias("q"), F.col(ts).alias("t"), days.alias("d"))
    past = F.col(ts) <= ref

    def first_when(cond, order):
        return F.min_by(row, F.when(cond, order))

    g = df.groupBy(*key).agg(
        first_when(gap < 1, F.struct(F.col(ts).alias("t"))).alias("_exact"),
        first_when(gap <= tolerance_days, F.struct(gap.alias("g"), F.col(ts).alias("t"))).alias("_near"),
        F.max_by(row, F.when(past, F.struct(F.col(ts).alias("t")))).alias("_before"),
        first_when(~past, F.struct(F.col(ts).alias("t"))).alias("_after"))

    tol2 = tolerance_days * 2.0

    def faded(s):
        return F.col(f"{s}.q") * (1 - F.abs(F.col(f"{s}.d")) / tol2)

    near = F.struct(F.col("_near.v").alias("value"), F.coalesce(faded("_near"), F.lit(0.0)).alias("confidence"),
                    F.when(F.col("_near").isNotNull(), "nearest_available").otherwise("no_data_within_tolerance").alias("method"))
    span = F.floor((F.unix_micros("_after.t") - F.unix_micros("_before.t")) / 86_400_000_000)
    w = -F.col("_before.d") / F.when(span > 0, span)
    between = F.struct(
        (F.col("_before.v") * (1 - w) + F.col("_after.v") * w).alias("value"),
        ((F.col("_before.q") + F.col("_after.q")) / 2 * (1 - F.least(span / 730.0, F.lit(0.5)))).alias("confidence"),
        F.lit("interpolated").alias("method"))
    can = F.coalesce((span > 0) & F.col("_before.v").isNotNull() & F.col("_after.v").isNotNull(), F.lit(False))
    interpolated = F.when(can, between).otherwise(near)

    def side(s, name, none):
        ok = F.coalesce(F.abs(F.col(f"{s}.d")) <= tolerance_days, F.lit(False))
        return F.struct(F.when(ok, F.col(f"{s}.v")).alias("value"), F.when(ok, faded(s)).otherwise(0.0).alias("confidence"),
                        F.when(ok, name).otherwise(none).alias("method"))

    exact = F.struct(F.col("_exact.v").alias("value"), F.coalesce(F.col("_exact.q"), F.lit(0.0)).alias("confidence"),
                     F.when(F.col("_exact").isNotNull(), "exact_match").otherwise("no_exact_match").alias("method"))
    seasonal = interpolated
    if pattern is not None:
        factors = F.create_map(*[x for k, v in SEASONAL.items() for x in (F.lit(k), F.array(*[F.lit(f) for f in v]))])
        months = F.try_element_at(factors, pattern)
        change = F.get(months, F.month(ref) - 1) / F.get(months, F.month("_near.t") - 1)
        adjusted = F.struct((F.col("_near.v") * change).alias("value"), (faded("_near") * 0.9).alias("confidence"),
                            F.lit("seasonal_adjusted").alias("method"))
        seasonal = F.when(months.isNull(), interpolated).when(F.col("_near.v").isNull(), near).otherwise(adjusted)
    chosen = (
        F.when(strategy == "exact_match", exact).when(strategy == "interpolation", interpolated)
        .when(strategy == "forward_fill", side("_before", "forward_fill", "no_past_data"))
        .when(strategy == "backward_fill", side("_after", "backward_fill", "no_future_data"))
        .when(strategy == "seasonal_adjustment", seasonal).otherwise(near)
    )
    return g.select(*key, chosen.alias("_c")).select(*key, "_c.*")
