"""Source records in their target form: checked codes, typed values, derived fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.functions import codes, geo, ratios
from zonalis.functions import fixed_values as V
from zonalis.operators.mapping import first_usable

# Source spellings of census fields.
CENSUS_FIELDS = {
    "sa2_code": ["SA2_CODE_2021", "SA2_MAINCODE_2021", "SA2_CODE"],
    "total_population": ["Tot_P_P", "Total_Population_Persons", "P_Tot_Tot"],
    "male_population": ["Tot_P_M", "Total_Population_Males", "P_Tot_M"],
    "female_population": ["Tot_P_F", "Total_Population_Females", "P_Tot_F"],
    "median_age": ["Median_age_persons", "Median_Age_P", "Age_psns_med_yr"],
    "median_household_income": ["Median_tot_hhd_inc_weekly", "Tot_hhd_inc_NS_agg_incl_NI_med_dollarspw"],
    "unemployment_rate": ["Unemployment_rate_P", "P_UnemplymtR"],
    "indigenous_population": ["P_Tot_Aboriginal_Torres_Strait_Islander", "P_Aboriginal_Torres_Strait_Islander_Persons"],
}
CENSUS_COUNTS = ("total_population", "male_population", "female_population", "indigenous_population")
CENSUS_BLANKS = ("", "null", "NA")
CLIMATE_BLANKS = ("", "NA", "-")


def _has(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None)


def parsed(df: DataFrame, names: Sequence[str], blanks: Sequence[str]) -> Column:
    """First candidate that is not blank and reads as a number."""
    present = [n for n in names if n in df.columns]
    cells = [F.when(~F.trim(F.col(n).cast("string")).isin(*blanks), F.trim(F.col(n).cast("string"))).try_cast("double")
             for n in present]
    return F.coalesce(*cells) if cells else F.lit(None).cast("double")


def census_records(df: DataFrame, census_year: int, fields: Mapping[str, Sequence[str]] = CENSUS_FIELDS) -> DataFrame:
    """Nine-digit areas only; counts truncated with 0 for absent ones."""
    code = first_usable(df, fields["sa2_code"], CENSUS_BLANKS)
    out = [code.alias("geographic_id"), F.lit("SA2").alias("geographic_level"), F.lit(census_year).alias("census_year")]
    for name, candidates in fields.items():
        if name == "sa2_code":
            continue
        number = parsed(df, candidates, CENSUS_BLANKS)
        if name in CENSUS_COUNTS:
            target = "indigenous_population_count" if name == "indigenous_population" else name
            out.append(F.coalesce(number.cast("long"), F.lit(0).cast("long")).alias(target))
        else:
            out.append(number.alias(name))
    out += [F.lit(f"ABS_CENSUS_{census_year}").alias("data_source_id"),
            F.lit(f"ABS Census {census_year} DataPack").alias("data_source_name")]
    return df.select(*out).filter(F.col("geographic_id").rlike(r"^\d{9}$"))


def geographic_records(df: DataFrame, level: str = "SA2", crs: str = "EPSG:7844") -> DataFrame:
    """Rows with a well-formed code: area from the record or its geometry's box,
    hierarchy struct, urbanisation and remoteness."""
    low = level.lower()
    code, name = F.trim(F.col(f"{low}_code").cast("string")), F.coalesce(_has(df, f"{low}_name").cast("string"), F.lit(""))
    area = _has(df, "area_sq_km").try_cast("double")
    if "geometry" in df.columns:
        area = F.coalesce(area, geo.bbox_area_km2(geo.ring_bbox(F.col("geometry.coordinates")[0])))
    out = [code.alias("geographic_id"), F.lit(level).alias("geographic_level"), name.alias("geographic_name"),
           area.alias("area_square_km"), F.lit(crs).alias("coordinate_system")]
    if "geometry" in df.columns:
        out.append(F.col("geometry").alias("boundary_geometry"))
    if level == "SA2":
        up = ("sa3_code", "sa3_name", "sa4_code", "sa4_name", "state_code", "state_name")
        out.append(F.struct(*[F.coalesce(_has(df, c).cast("string"), F.lit("")).alias(c) for c in up]).alias("geographic_hierarchy"))
        out.append(codes.urbanisation_by_name(name).alias("urbanisation"))
        out.append(codes.remoteness_by_state(F.coalesce(_has(df, "state_code").cast("string"), F.lit(""))).alias("remoteness_category"))
    return df.filter(F.coalesce(code.rlike(rf"^\d{{{V.CODE_DIGITS[level]}}}$"), F.lit(False))).select(*out)


def mortality_records(df: DataFrame) -> DataFrame:
    """Rows with area, cause and year: standard age and sex, value = rate else deaths."""
    code, cause = F.trim(F.col("sa2_code").cast("string")), F.col("cause_of_death")
    rate, deaths = _has(df, "mortality_rate").try_cast("double"), _has(df, "deaths_count").try_cast("double")
    has_rate = F.lit("mortality_rate" in df.columns) & _has(df, "mortality_rate").isNotNull()
    return df.filter(code.rlike(r"^\d{9}$") & cause.isNotNull() & F.col("year").isNotNull()).select(
        code.alias("geographic_id"), F.lit("SA2").alias("geographic_level"),
        F.concat(cause, F.lit(" Mortality")).alias("indicator_name"), codes.indicator_code("MORT", cause).alias("indicator_code"),
        F.lit("mortality").alias("indicator_type"), F.when(has_rate, rate).otherwise(F.coalesce(deaths, F.lit(0.0))).alias("value"),
        F.when(has_rate, "per 100,000").otherwise("count").alias("unit"),
        F.col("year").try_cast("double").cast("int").alias("reference_year"),
        codes.standard_age_group(_has(df, "age_group").cast("string")).alias("age_group"),
        codes.standard_sex(_has(df, "sex").cast("string")).alias("sex"), cause.alias("cause_of_death"),
        _has(df, "icd10_code").cast("string").alias("icd10_code"), deaths.cast("long").alias("deaths_count"))


CLIMATE_MEASURES = {
    "latitude": "latitude", "longitude": "longitude", "temperature_max": "temperature_max_celsius",
    "temperature_min": "temperature_min_celsius", "rainfall": "rainfall_mm",
    "humidity_9am": "relative_humidity_9am_percent", "humidity_3pm": "relative_humidity_3pm_percent",
    "wind_speed": "wind_speed_kmh", "solar_exposure": "solar_exposure_mj_per_m2",
}


def climate_records(df: DataFrame) -> DataFrame:
    """Rows with a station and a date in either format; numbers or null; heat stress."""
    day = codes.parse_date(F.col("date").cast("string"))
    measures = [_has(df, s).try_cast("double").alias(t) for s, t in CLIMATE_MEASURES.items()]
    hot = F.col("temperature_max_celsius")
    return df.filter(F.col("station_id").isNotNull() & day.isNotNull()).select(
        "station_id", F.coalesce(_has(df, "station_name").cast("string"), F.lit("")).alias("station_name"),
        F.date_format(day, "yyyy-MM-dd").alias("measurement_date"), *measures,
    ).withColumn("heat_stress_indicator", F.when(hot > 35, "high").when(hot > 30, "moderate").when(hot.isNotNull(), "low"))


def medicare_records(df: DataFrame) -> DataFrame:
    """Nine-digit areas: services unless suppressed, rate per patient, bulk-billed %."""
    code = F.trim(F.col("sa2_code").cast("string"))
    text = F.col("services_count").cast("string")
    hidden = F.coalesce(text.startswith("<"), F.lit(False))
    services = F.when(~hidden, text.try_cast("long"))
    patients = _has(df, "patient_count").try_cast("long")
    rate = F.when((services != 0) & (patients > 0), services / patients)
    bulk = F.when(services != 0, _has(df, "bulk_billed_services").try_cast("long") / services * 100)
    kind = _has(df, "service_type").cast("string")
    some_rate = F.when(rate != 0, rate)
    return df.filter(F.coalesce(code.rlike(r"^\d{9}$"), F.lit(False))).select(
        code.alias("geographic_id"), F.lit("SA2").alias("geographic_level"),
        F.concat(F.coalesce(kind, F.lit("Medicare")), F.lit(" Utilisation")).alias("indicator_name"),
        codes.indicator_code("MEDICARE", F.coalesce(kind, F.lit("ALL"))).alias("indicator_code"),
        F.coalesce(some_rate, services.cast("double"), F.lit(0.0)).alias("value"),
        F.when(some_rate.isNotNull(), "services per patient").otherwise("count").alias("unit"),
        _has(df, "year").try_cast("int").alias("reference_year"), _has(df, "quarter").cast("string").alias("reference_quarter"),
        F.coalesce(kind, F.lit("Medicare Services")).alias("service_type"), F.lit("primary_care").alias("service_category"),
        services.alias("visits_count"), rate.alias("utilisation_rate"), bulk.alias("bulk_billed_percentage"),
        _has(df, "benefits_paid").cast("string").alias("total_benefits_paid"), patients.alias("unique_patients"),
        hidden.alias("data_suppressed"))


PRESCRIPTIONS = T.StructType([
    T.StructField("geographic_id", T.StringType()), T.StructField("drug_category", T.StringType()),
    T.StructField("reference_year", T.IntegerType()), T.StructField("prescription_count", T.LongType()),
    T.StructField("unique_patients", T.LongType()), T.StructField("total_cost", T.DoubleType()),
])
SERVICES = T.StructType([
    T.StructField("geographic_id", T.StringType()), T.StructField("service_type", T.StringType()),
    T.StructField("service_name", T.StringType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("capacity", T.LongType()),
])


def prescription_records(df: DataFrame) -> DataFrame:
    """Prescriptions per patient and cost per prescription by area and drug category."""
    per_patient = ratios.pct("prescription_count", "unique_patients", 1.0)
    return df.select(
        "geographic_id", F.concat("drug_category", F.lit(" Prescriptions")).alias("indicator_name"),
        codes.indicator_code("PBS", F.col("drug_category")).alias("indicator_code"), per_patient.alias("value"),
        F.lit("prescriptions per patient").alias("unit"), "reference_year", "prescription_count", "unique_patients",
        "total_cost", ratios.pct("total_cost", "prescription_count", 1.0).alias("average_cost_per_prescription"))
