"""Staging projections, profiles and marts as one lazy plan.

Inputs are the raw tables by name, as DataFrames; only a caller's write stores anything.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.operators.joins import left_chain

# Staged columns by raw table; a pair renames.
STAGING = {
    "raw_abs_census": ["sa2_code", "total_population", "male_population", "female_population", "median_age",
                       "median_household_income", "unemployment_rate", "indigenous_population"],
    "raw_abs_seifa": ["sa2_code", "seifa_irsad_score", "seifa_irsd_decile", "seifa_ier_score", "seifa_ier_decile",
                      "seifa_ieo_score", "seifa_ieo_decile", "seifa_ersad_score", "seifa_ersad_decile"],
    "raw_abs_geographic": [("geographic_id", "sa2_code"), "geographic_level", ("geographic_name", "sa2_name"),
                           "area_square_km", "coordinate_system", "boundary_geometry", "geographic_hierarchy",
                           "urbanisation", "remoteness_category"],
    "raw_aihw_mortality": [("geographic_id", "sa2_code"), "indicator_name", "indicator_code", ("value", "mortality_rate"),
                           "unit", "reference_year", "age_group", "sex", "cause_of_death", "icd10_code", "deaths_count"],
    "raw_medicare_utilisation": [("geographic_id", "sa2_code"), "indicator_name", "indicator_code", ("value", "utilisation"),
                                 "unit", "reference_year", "reference_quarter", "service_type", "service_category",
                                 "visits_count", "utilisation_rate", "bulk_billed_percentage", "total_benefits_paid",
                                 "unique_patients", "data_suppressed"],
    "raw_bom_climate": ["station_id", "station_name", "measurement_date", "latitude", "longitude",
                        "temperature_max_celsius", "temperature_min_celsius", "rainfall_mm",
                        "relative_humidity_9am_percent", "relative_humidity_3pm_percent", "wind_speed_kmh",
                        "solar_exposure_mj_per_m2", "heat_stress_indicator"],
}
MEDICARE_MEASURES = ["utilisation_rate", "bulk_billed_percentage"]
CLIMATE_MEASURES = ["temperature_max_celsius", "rainfall_mm"]
PROFILE_COLUMNS = ["sa2_code", "total_population", "median_age", "median_household_income", "unemployment_rate",
                   "seifa_irsad_score", "seifa_irsd_decile", "area_square_km", "remoteness_category"]


def stage(raw: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Picked and renamed columns of one raw table; absent ones are left out."""
    df, out = raw[name], []
    for c in STAGING[name]:
        source, target = c if isinstance(c, tuple) else (c, c)
        if source in df.columns:
            out.append(F.col(source).alias(target))
    return df.select(*out)


def health_profile(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Facts joined as they are, with climate on station code = area code."""
    m = stage(raw, "raw_aihw_mortality").select("sa2_code", "mortality_rate")
    u = stage(raw, "raw_medicare_utilisation").select("sa2_code", *MEDICARE_MEASURES)
    c = stage(raw, "raw_bom_climate").select(F.col("station_id").alias("sa2_code"), *CLIMATE_MEASURES)
    return left_chain(m, "sa2_code", u, c)


def health_profile_by_area(raw: Mapping[str, DataFrame], nearest: DataFrame | None = None) -> DataFrame:
    """One row per area: each fact table is averaged first, so the joins cannot fan
    out.  `nearest` (sa2_code, station_id) replaces the code = station match."""
    m = stage(raw, "raw_aihw_mortality").groupBy("sa2_code").agg(F.avg("mortality_rate").alias("mortality_rate"))
    u = stage(raw, "raw_medicare_utilisation").groupBy("sa2_code").agg(*[F.avg(c).alias(c) for c in MEDICARE_MEASURES])
    c = stage(raw, "raw_bom_climate").groupBy("station_id").agg(*[F.avg(c).alias(c) for c in CLIMATE_MEASURES])
    if nearest is None:
        c = c.withColumnRenamed("station_id", "sa2_code")
    else:
        c = nearest.select("sa2_code", "station_id").join(c, "station_id").drop("station_id")
    return left_chain(m, "sa2_code", u, c)


def socioeconomic_profile(raw: Mapping[str, DataFrame]) -> DataFrame:
    return left_chain(
        stage(raw, "raw_abs_census"), "sa2_code", stage(raw, "raw_abs_seifa"), stage(raw, "raw_abs_geographic")
    ).select(*PROFILE_COLUMNS)


def master_health_record(health: DataFrame, socioeconomic: DataFrame) -> DataFrame:
    """Areas present in both profiles, with the state digit the dashboards filter on."""
    return health.join(socioeconomic, "sa2_code").withColumn("state_code", F.substring("sa2_code", 1, 1))


# Weights of the composite index.
COMPOSITE_WEIGHTS = {"mortality_rate": 0.5, "utilisation_rate": 0.3, "bulk_billed_percentage": 0.2}


def derived_health_indicators(master: DataFrame, weights: Mapping[str, float] = COMPOSITE_WEIGHTS) -> DataFrame:
    total = None
    for c, w in weights.items():
        total = F.col(c) * w if total is None else total + F.col(c) * w
    return master.withColumn("composite_health_index", total)


def health_summary(derived: DataFrame) -> DataFrame:
    return derived.agg(
        F.count_distinct("sa2_code").alias("total_sa2"), F.avg("mortality_rate").alias("avg_mortality_rate"),
        F.avg("utilisation_rate").alias("avg_utilisation_rate"), F.sum("total_population").alias("total_population"),
        F.avg("composite_health_index").alias("avg_composite_index"))
