"""The roles the given tables play, as DataFrames and as the same SQL text.

A customer stands for an area, its region for the state, its nation for the
upper area levels; orders are the area's people, line items a part's dwellings
and residents.  Negative balances are unknown scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed_values as V
from zonalis.plans.registry import Tables

AGE_COLUMNS = list(V.AGE_MIDPOINTS)

AREAS = """areas AS (
  SELECT c_custkey AS area_id, c_name AS sa2_name, c_mktsegment AS segment, c_acctbal AS balance,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS score,
         (n_regionkey + 1)::VARCHAR || printf('%02d', c_nationkey) || printf('%02d', c_custkey % 10)
           || printf('%04d', c_custkey // 10 % 10000) AS sa2_code,
         (n_regionkey + 1)::VARCHAR || printf('%02d', c_nationkey) || printf('%02d', c_custkey % 10) AS sa3_code,
         (n_regionkey + 1)::VARCHAR || printf('%02d', c_nationkey) AS sa4_code,
         (n_regionkey + 1)::VARCHAR AS state_code, r_name AS state, n_name AS nation,
         round(-10.0 - 33.0 * ((c_acctbal + 1000.0) / 11000.0), 6) AS lat,
         round(113.0 + ((c_custkey * 7919) % 10007) * 0.004, 6) AS lon
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def areas(t: Tables) -> DataFrame:
    sa4 = F.concat((F.col("n_regionkey") + 1).cast("string"), F.format_string("%02d", "c_nationkey"))
    sa3 = F.concat(sa4, F.format_string("%02d", F.col("c_custkey") % 10))
    tail = F.format_string("%04d", F.floor(F.col("c_custkey") / 10) % 10000)
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("area_id"), F.col("c_name").alias("sa2_name"),
            F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("score"),
            F.concat(sa3, tail).alias("sa2_code"), sa3.alias("sa3_code"), sa4.alias("sa4_code"),
            (F.col("n_regionkey") + 1).cast("string").alias("state_code"),
            F.col("r_name").alias("state"), F.col("n_name").alias("nation"),
            F.round(-10.0 - 33.0 * ((F.col("c_acctbal") + 1000.0) / 11000.0), 6).alias("lat"),
            F.round(113.0 + ((F.col("c_custkey") * 7919) % 10007) * 0.004, 6).alias("lon"),
        )
    )


_LABOUR = {
    "employed_full_time": "o_orderstatus = 'F'",
    "employed_part_time": "o_orderstatus = 'O'",
    "unemployed": "o_orderstatus = 'P'",
    "not_in_labour_force": "o_totalprice < 100000",
    "managers": "o_orderpriority = '1-URGENT'",
    "professionals": "o_orderpriority = '2-HIGH'",
    "technicians_trades": "o_orderpriority = '3-MEDIUM'",
    "clerical_administrative": "o_orderpriority = '4-NOT SPECIFIED'",
    "labourers": "o_orderpriority = '5-LOW'",
    "bachelor_degree": "o_totalprice > 350000",
    "postgraduate_degree": "o_totalprice > 450000",
    "certificate_iii_iv": "o_totalprice BETWEEN 100000 AND 250000",
    "year_8_or_below": "o_totalprice < 50000",
}
LABOUR = ("labour AS (SELECT o_custkey AS area_id, "
          + ", ".join(f"count(*) FILTER (WHERE {p}) AS {c}" for c, p in _LABOUR.items())
          + ", count(*) AS people, count(*) + count(*) FILTER (WHERE o_totalprice < 100000) AS labour_force_pop"
          + " FROM orders GROUP BY o_custkey)")


def labour(t: Tables) -> DataFrame:
    """Counts of an area's people by labour force, occupation and schooling."""
    return t.orders.groupBy(F.col("o_custkey").alias("area_id")).agg(
        *[F.count_if(F.expr(p)).alias(c) for c, p in _LABOUR.items()],
        F.count(F.lit(1)).alias("people"),
        (F.count(F.lit(1)) + F.count_if(F.col("o_totalprice") < 100000)).alias("labour_force_pop"),
    )


_HOUSING = {
    "separate_house": "l_returnflag = 'A'", "semi_detached": "l_returnflag = 'N'",
    "flat_apartment": "l_returnflag = 'R' AND l_linestatus = 'F'",
    "other_dwelling": "l_returnflag = 'R' AND l_linestatus = 'O'",
    "owned_outright": "l_quantity < 10", "owned_with_mortgage": "l_quantity BETWEEN 10 AND 24",
    "rented": "l_quantity BETWEEN 25 AND 44", "other_tenure": "l_quantity > 44",
    "private_landlord": "l_quantity BETWEEN 25 AND 34", "real_estate_agent": "l_quantity BETWEEN 35 AND 44",
    "internet_connection": "l_discount < 0.07", "no_internet": "l_discount BETWEEN 0.07 AND 0.09",
    "internet_not_stated": "l_discount > 0.09",
    "no_motor_vehicles": "l_linenumber = 1", "one_motor_vehicle": "l_linenumber = 2",
    "two_motor_vehicles": "l_linenumber IN (3, 4)", "three_plus_vehicles": "l_linenumber IN (5, 6)",
    "vehicles_not_stated": "l_linenumber > 6",
    "males": "l_linestatus = 'F'", "females": "l_linestatus = 'O'",
}
HOUSING = ("housing AS (SELECT l_partkey AS area_id, "
           + ", ".join(f"count(*) FILTER (WHERE {p}) AS {c}" for c, p in _HOUSING.items())
           + ", count(*) AS dwellings, max(l_extendedprice) / 20 AS median_mortgage_monthly"
           + ", min(l_extendedprice) / 40 AS median_rent_weekly FROM lineitem GROUP BY l_partkey)")


def housing(t: Tables) -> DataFrame:
    """Counts of a part's line items by dwelling, tenure, internet and vehicles."""
    return t.lineitem.groupBy(F.col("l_partkey").alias("area_id")).agg(
        *[F.count_if(F.expr(p)).alias(c) for c, p in _HOUSING.items()],
        F.count(F.lit(1)).alias("dwellings"),
        (F.max("l_extendedprice") / 20).alias("median_mortgage_monthly"),
        (F.min("l_extendedprice") / 40).alias("median_rent_weekly"),
    )


_BANDS = {c: (f"floor(l_quantity * 1.8 / 5) = {i}" if i < 17 else "floor(l_quantity * 1.8 / 5) >= 17")
          for i, c in enumerate(AGE_COLUMNS)}
AGES = ("ages AS (SELECT l_partkey AS area_id, "
        + ", ".join(f"count(*) FILTER (WHERE {p}) AS {c}" for c, p in _BANDS.items())
        + ", count(*) AS total_population, count(*) FILTER (WHERE l_linestatus = 'F') AS males"
        + ", count(*) FILTER (WHERE l_linestatus = 'O') AS females"
        + ", count(*) FILTER (WHERE l_returnflag = 'A') AS indigenous"
        + ", count(*) FILTER (WHERE l_returnflag = 'N') AS non_indigenous"
        + ", count(*) FILTER (WHERE l_returnflag = 'R') AS indigenous_not_stated"
        + " FROM lineitem GROUP BY l_partkey)")


def ages(t: Tables) -> DataFrame:
    """Counts of a part's residents by five-year age, sex and status."""
    return t.lineitem.groupBy(F.col("l_partkey").alias("area_id")).agg(
        *[F.count_if(F.expr(p)).alias(c) for c, p in _BANDS.items()],
        F.count(F.lit(1)).alias("total_population"),
        F.count_if(F.col("l_linestatus") == "F").alias("males"),
        F.count_if(F.col("l_linestatus") == "O").alias("females"),
        F.count_if(F.col("l_returnflag") == "A").alias("indigenous"),
        F.count_if(F.col("l_returnflag") == "N").alias("non_indigenous"),
        F.count_if(F.col("l_returnflag") == "R").alias("indigenous_not_stated"),
    )


def r(c: Column, places: int = 8) -> Column:
    """Rounded for comparison; an exact zero never carries a sign."""
    return F.round(c, places) + F.lit(0.0)


def with_sql(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


__all__ = ["AGES", "AGE_COLUMNS", "AREAS", "HOUSING", "LABOUR", "ages", "areas", "housing",
           "labour", "r", "with_sql"]
