"""Set operations on rows, keys and columns, and bounded top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stack(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def missing_keys(official: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return official.select(key).distinct().join(present.select(key), key, "left_anti")


def all_keys(key: str, *frames: DataFrame) -> DataFrame:
    return stack(*[f.select(key) for f in frames]).distinct()


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    return set(a.columns) == set(b.columns)


def top_and_bottom(df: DataFrame, key: str, metric: str, n: int = 10) -> DataFrame:
    """n highest and n lowest by the metric, ties by key."""
    rows = df.select(key, metric).filter(F.col(metric).isNotNull())
    top = rows.orderBy(F.desc(metric), key).limit(n).withColumn("side", F.lit("top"))
    low = rows.orderBy(F.asc(metric), key).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(low)


def top_per_group(df: DataFrame, group: Sequence[str], order, k: int, out: str = "place") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)
