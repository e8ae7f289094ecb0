"""Census domains: each function takes mapped counts and adds its indicators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions import codes, ratios
from zonalis.functions import fixed_values as V
from zonalis.functions.ratios import pct, row_sum
from zonalis.operators import impute, indicators, joins, mapping, ranking
from zonalis.operators.integrate import largest_base

# Column groups of the census classifications.
WORKING_AGES = ["age_15_19", "age_20_24", "age_25_29", "age_30_34", "age_35_39", "age_40_44", "age_45_49",
                "age_50_54", "age_55_59", "age_60_64"]
YOUNG_AGES = ["age_0_4", "age_5_9", "age_10_14"]
OLD_AGES = ["age_65_69", "age_70_74", "age_75_79", "age_80_84", "age_85_plus"]
INDIGENOUS = ["indigenous", "non_indigenous", "indigenous_not_stated"]
DWELLINGS = ["total_private_dwellings", "occupied_private_dwellings", "unoccupied_private_dwellings", "total_families"]
LABOUR_FORCE = ["employed_full_time", "employed_part_time", "unemployed", "not_in_labour_force", "labour_force_not_stated"]
OCCUPATIONS = ["managers", "professionals", "technicians_trades", "community_personal_service", "clerical_administrative",
               "sales_workers", "machinery_operators", "labourers", "occupation_not_stated"]
SKILL_LEVELS = {"skill_level_1_2": ["managers", "professionals"],
                "skill_level_3": ["technicians_trades", "community_personal_service", "clerical_administrative"],
                "skill_level_4_5": ["sales_workers", "machinery_operators", "labourers"]}
INDUSTRIES = ["agriculture_forestry_fishing", "mining", "manufacturing", "electricity_gas_water", "construction",
              "wholesale_trade", "retail_trade", "accommodation_food", "transport_postal", "information_media",
              "financial_insurance", "rental_real_estate", "professional_services", "administrative_support",
              "public_administration", "education_training", "health_social_assistance", "arts_recreation", "other_services"]
PRIMARY = ["agriculture_forestry_fishing", "mining"]
SECONDARY = ["manufacturing", "construction"]
PUBLIC = ["public_administration", "education_training", "health_social_assistance"]
QUALIFICATIONS = ["bachelor_degree", "postgraduate_degree", "graduate_diploma", "advanced_diploma", "certificate_iii_iv",
                  "certificate_i_ii", "no_qualification"]
STRUCTURES = ["separate_house", "semi_detached", "flat_apartment", "other_dwelling"]
TENURES = ["owned_outright", "owned_with_mortgage", "rented", "other_tenure"]
LANDLORDS = ["state_territory_housing", "private_landlord", "real_estate_agent", "other_landlord"]
VEHICLES = ["no_motor_vehicles", "one_motor_vehicle", "two_motor_vehicles", "three_plus_vehicles"]


def ages_from_sexes(df: DataFrame) -> DataFrame:
    """age_* = age_*_male + age_*_female, 0 where neither exists."""
    out = {}
    for a in V.AGE_MIDPOINTS:
        parts = [c for c in (f"{a}_male", f"{a}_female") if c in df.columns]
        if parts or a not in df.columns:
            out[a] = row_sum(parts).cast("long")
    return df.withColumns(out)


def demographics(df: DataFrame) -> DataFrame:
    """Ratios to two decimals, density, mean-age deviation and diversity."""
    d = mapping.ensure_counts(ages_from_sexes(df), INDIGENOUS + DWELLINGS)
    work, young, old = row_sum(WORKING_AGES), row_sum(YOUNG_AGES), row_sum(OLD_AGES)
    area = F.col("area_sq_km") if "area_sq_km" in df.columns else F.lit(0.0)
    return d.withColumns({
        "dependency_ratio": F.bround(pct(young + old, work), 2), "sex_ratio": F.bround(pct("males", "females"), 2),
        "child_ratio": F.bround(pct(young, work), 2), "elderly_ratio": F.bround(pct(old, work), 2),
        "population_density": F.bround(pct("total_population", area, 1.0), 2),
        "median_age_deviation": F.bround(ratios.mean_age_deviation(d.columns), 2),
        "diversity_index": F.bround(ratios.simpson(INDIGENOUS), 4),
    })


def labour_force(df: DataFrame) -> DataFrame:
    d = mapping.ensure_counts(df, LABOUR_FORCE)
    d = d.withColumn("total_employed", F.col("employed_full_time") + F.col("employed_part_time"))
    d = d.withColumn("total_labour_force", F.col("total_employed") + F.col("unemployed"))
    return d.withColumns({
        "unemployment_rate": pct("unemployed", "total_labour_force"),
        "participation_rate": pct("total_labour_force", "labour_force_pop"),
        "employment_population_ratio": pct("total_employed", "labour_force_pop"),
        "full_time_employment_ratio": pct("employed_full_time", "total_employed"),
        "employment_self_sufficiency": pct("total_employed", "labour_force_pop"),
        "part_time_ratio": pct("employed_part_time", "total_employed"),
    })


def occupations(df: DataFrame) -> DataFrame:
    """Skill levels, their shares and imbalance."""
    d = mapping.ensure_counts(df, OCCUPATIONS).withColumns({k: row_sum(cs) for k, cs in SKILL_LEVELS.items()})
    d = d.withColumn("total_employed_classified", row_sum(list(SKILL_LEVELS)))
    out = {f"{k}_pct": pct(k, "total_employed_classified") for k in SKILL_LEVELS}
    out["skills_mismatch_index"] = ratios.skill_imbalance(list(SKILL_LEVELS))
    if "total_employed" in df.columns:
        out["high_skill_employment_ratio"] = pct("skill_level_1_2", "total_employed")
    return d.withColumns(out)


def industries(df: DataFrame) -> DataFrame:
    """Sector totals and shares, public/private split, normalised diversity."""
    d = mapping.ensure_counts(df, INDUSTRIES + ["industry_not_stated"])
    service = [c for c in INDUSTRIES if c not in PRIMARY + SECONDARY]
    d = d.withColumns({
        "primary_industries": row_sum(PRIMARY), "secondary_industries": row_sum(SECONDARY), "tertiary_industries": row_sum(service),
        "public_sector": row_sum(PUBLIC), "private_sector": row_sum([c for c in INDUSTRIES if c not in PUBLIC]),
        "total_industry_employment": row_sum(INDUSTRIES), "industry_diversity_index": ratios.shannon(INDUSTRIES)})
    out = {f"{s}_sector_pct": pct(f"{s}_industries", "total_industry_employment") for s in ("primary", "secondary", "tertiary")}
    if "total_employed" in df.columns:
        out["public_sector_ratio"] = pct("public_sector", "total_employed")
    out["economic_complexity"] = F.col("industry_diversity_index") * 100
    return d.withColumns(out)


def education_alignment(df: DataFrame) -> DataFrame:
    """How qualifications meet occupations."""
    d = mapping.ensure_counts(df, QUALIFICATIONS + ["qualification_not_stated"])
    d = d.withColumns({"university_qualified": row_sum(QUALIFICATIONS[:3]), "vet_qualified": row_sum(QUALIFICATIONS[3:6])})
    uni, trade = F.col("university_qualified"), F.col("certificate_iii_iv")
    high = F.col("professionals") + F.col("managers")
    zero = F.lit(0)
    d = d.withColumns({
        "qualification_utilisation_rate": pct("professionals", uni), "trade_utilisation_rate": pct("technicians_trades", trade),
        "over_qualification_rate": pct(F.greatest(uni - high, zero), uni),
        "under_qualification_rate": pct(F.greatest(high - uni, zero), high),
        "education_diversity_index": ratios.shannon(QUALIFICATIONS)})
    blend = F.col("qualification_utilisation_rate") * uni + F.col("trade_utilisation_rate") * trade
    return d.withColumn("skill_match_index", pct(blend, uni + trade, 1.0))


def housing(df: DataFrame) -> DataFrame:
    """Structure, tenure, landlord, internet, vehicle and payment indicators."""
    d = mapping.ensure_counts(df, STRUCTURES + ["dwelling_structure_not_stated"] + TENURES + ["tenure_not_stated"] + LANDLORDS
                              + ["internet_connection", "no_internet", "internet_not_stated"] + VEHICLES + ["vehicles_not_stated"])
    known = {"structure": row_sum(STRUCTURES), "tenure": row_sum(TENURES), "vehicles": row_sum(VEHICLES),
             "internet": row_sum(["internet_connection", "no_internet"])}
    out = {f"{c}_pct": pct(c, known["structure"]) for c in STRUCTURES}
    out |= {f"{c}_pct": pct(c, known["tenure"]) for c in TENURES} | {f"{c}_pct": pct(c, "rented") for c in LANDLORDS}
    out |= {f"{c}_pct": pct(c, known["vehicles"]) for c in VEHICLES}
    owned = F.col("owned_outright") + F.col("owned_with_mortgage")
    out |= {
        "home_ownership_rate": pct(owned, known["tenure"]), "rental_rate": pct("rented", known["tenure"]),
        "internet_penetration_rate": pct("internet_connection", known["internet"]),
        "estimated_avg_vehicles": ratios.average_vehicles("one_motor_vehicle", "two_motor_vehicles", "three_plus_vehicles", known["vehicles"]),
        "no_vehicle_rate": pct("no_motor_vehicles", known["vehicles"]),
        "multi_vehicle_rate": pct(F.col("two_motor_vehicles") + F.col("three_plus_vehicles"), known["vehicles"]),
        "total_dwellings": row_sum(STRUCTURES + ["dwelling_structure_not_stated"]),
        "total_occupied_dwellings": row_sum(TENURES + ["tenure_not_stated"]), "total_landlord_classified": row_sum(LANDLORDS),
    }
    d = d.withColumns(out)
    for c in ("median_mortgage_monthly", "median_rent_weekly"):
        raw = F.col(c).try_cast("double") if c in df.columns else F.lit(None).cast("double")
        d = d.withColumn(c, ratios.positive_or_null(raw))
    ratio = ratios.monthly_rent(F.col("median_rent_weekly")) / F.col("median_mortgage_monthly")
    return d.withColumns({
        "rent_to_mortgage_ratio": ratio, "housing_affordability_indicator": ratios.affordability(ratio),
        "mortgage_range": ratios.right_closed_bin(F.col("median_mortgage_monthly"), ratios.MORTGAGE_RANGES),
        "rent_range": ratios.right_closed_bin(F.col("median_rent_weekly"), ratios.RENT_RANGES)})


INDEX_SCORES = ["irsad_score", "irsd_score", "ier_score", "ieo_score"]


def index_scores(df: DataFrame, key: str = "geographic_id", *, state: str | None = "state_territory", **kw) -> DataFrame:
    """Z-scores, national and state ranks and deciles, composite score and severity."""
    have = [c for c in INDEX_SCORES if c in df.columns]
    d = ranking.z_scores(df, have)
    for c in have:
        d = ranking.rank_scores(d, c, key, prefix=c.removesuffix("_score"), **kw)
    for c in ("irsad_score", "irsd_score"):
        if state and c in have:
            d = ranking.rank_within_state(d, c, key, state, prefix=c.removesuffix("_score") + "_state", **kw)
    if {"irsad_score", "ier_score", "ieo_score"} <= set(have):
        d = d.withColumn("overall_advantage_score", indicators.overall_advantage(F.col("irsad_score"), F.col("ier_score"), F.col("ieo_score")))
    if "irsd_score" in have:
        d = d.withColumn("disadvantage_severity", indicators.disadvantage(F.col("irsd_decile"), "severity"))
    return d


def employment(df: DataFrame, *, impute_first: bool = False, levels: Sequence[str] = ("sa3_code", "sa4_code", "state_territory")) -> DataFrame:
    """The employment domain.  Counts become 0 unless `impute_first` fills them from
    labour-force-weighted medians of the area's levels."""
    d = df
    if impute_first:
        gaps = [c for c in LABOUR_FORCE + OCCUPATIONS + INDUSTRIES if c in df.columns]
        d = impute.fill_ladder_weighted_median(d, gaps, "labour_force_pop", [x for x in levels if x in df.columns])
    return education_alignment(industries(occupations(labour_force(d))))


def with_levels(df: DataFrame, code: str = "geographic_id") -> DataFrame:
    c = F.col(code)
    return df.withColumns({"sa3_code": codes.parent_code(c, "SA3"), "sa4_code": codes.parent_code(c, "SA4"),
                           "state_territory": codes.state_of_code(c)})


def integrate(base: DataFrame, domains: Mapping[str, DataFrame], keys: Sequence[str], *, as_coded: bool = False) -> DataFrame:
    """One wide row per area and year: suffixed domains, population bases reconciled,
    rates to one decimal and composite scores."""
    d = joins.domain_joins(base, domains, keys)

    def c(name):
        return F.col(name).cast("double") if name in d.columns else F.lit(None).cast("double")

    owned = c("owned_outright_housing") + c("owned_with_mortgage_housing")
    uni = c("postgraduate_degree_education") + c("bachelor_degree_education")
    employed = c("labour_force_pop_employment") - F.coalesce(c("unemployed_employment"), F.lit(0.0))
    s = indicators.share_1
    d = d.withColumns({
        "working_age_population": largest_base(d.columns, ["labour_force_pop_employment", "education_pop_base_education"]),
        "sex_ratio": s(c("males"), c("females")), "indigenous_percentage": s(c("indigenous"), c("total_population")),
        "home_ownership_rate": s(owned, owned + c("rented_housing")),
        "average_household_size": F.bround(c("total_population") / F.when(c("occupied_private_dwellings") != 0, c("occupied_private_dwellings")), 1),
        "professional_employment_rate": s(c("professionals_employment"), employed),
        "university_qualification_rate": s(uni, c("education_pop_base_education")),
        "vocational_qualification_rate": s(c("certificate_iii_iv_education"), c("education_pop_base_education")),
        "year12_completion_rate": s(c("year_12_or_equivalent_education"), c("education_pop_base_education")),
        "unemployment_rate": c("unemployment_rate_employment"), "participation_rate": c("participation_rate_employment"),
        "industry_diversity_index": c("industry_diversity_index_employment"),
        "median_rent_weekly": c("median_rent_weekly_housing"), "median_mortgage_monthly": c("median_mortgage_monthly_housing"),
    })
    # Fixed value: income taken where no source has any.
    income = c("median_personal_income") if "median_personal_income" in d.columns else F.lit(65000.0)
    return d.withColumns({
        "socioeconomic_profile": indicators.socioeconomic_profile(
            c("university_qualification_rate"), F.col("unemployment_rate"), F.col("home_ownership_rate"), c("irsad_score_seifa"), as_coded=as_coded),
        "livability_index": indicators.livability(
            F.col("median_rent_weekly"), F.col("unemployment_rate"), F.col("university_qualification_rate"), c("irsad_decile_seifa"), as_coded=as_coded),
        "economic_opportunity": indicators.economic_opportunity(F.col("participation_rate"), income, F.col("industry_diversity_index")),
        "housing_pressure": indicators.housing_pressure(F.col("median_rent_weekly"), F.col("home_ownership_rate"), as_coded=as_coded),
        "social_cohesion": F.lit(indicators.SOCIAL_COHESION),
    })
