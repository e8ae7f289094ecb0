"""Small building blocks shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a one-row DataFrame to every row as a scalar subquery;
    Spark itself refuses more than one row."""
    one = row.select(F.struct(*row.columns).alias("_row")).scalar()
    return df.withColumn("_row", one).select(*df.columns, *[F.col("_row")[c].alias(c) for c in row.columns])


HOT_ROWS = 1_000_000


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], *,
                how: str = "inner", hot_rows: int | None = None) -> DataFrame:
    """Equi-join that splits hot left keys.

    A key with more than hot_rows left rows is cut into as many salts as it holds
    that many; its right rows are repeated once per salt.  `spread` are left
    columns whose hash picks the salt.  The table of hot keys has at most
    rows / hot_rows entries; it is part of the plan, and without any Spark drops its joins.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can split the left side")
    spark = left.sparkSession
    hot_rows = hot_rows or int(spark.conf.get("zonalis.hotRows", str(HOT_ROWS)))
    hot = (
        left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > hot_rows)
        .select(*keys, F.ceil(F.col("_c") / hot_rows).cast("int").alias("_salts"))
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    one = left.join(F.broadcast(hot), keys, "left")
    one = one.withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")).drop("_salts")
    many = right.join(F.broadcast(hot), keys, "left")
    many = many.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return one.join(many, [*keys, "_salt"], how).drop("_salt")
