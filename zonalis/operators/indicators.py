"""Composite indices over one row per area.  Absent parts never count as zero
unless a docstring says so."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed_values as V
from zonalis.functions.codes import label_by_lower, label_by_upper
from zonalis.functions.ratios import mean_of_available, normalise, row_sum, weighted_of_available

# Reference levels of the indices.
LIFE_EXPECTANCY = 83.0
GP_TARGET = 2.0
SPECIALIST_TARGET = 0.5
NATIONAL_HEALTH = 75.0
NATIONAL_SES = 1000.0


def _nz(c: Column) -> Column:
    return F.when(c != 0, c)


def _capped(c: Column) -> Column:
    return F.when(c.isNotNull(), F.least(F.lit(100.0), c))


def risk_score(smoking: Column, obesity: Column, inactivity: Column) -> Column:
    """Mean of 100 − prevalence over the factors present."""
    return mean_of_available([100 - smoking, 100 - obesity, 100 - inactivity])


def composite_health_index(life: Column, mortality: Column, gp: Column, risk: Column) -> Column:
    """Weighted mean of the parts present, a quarter each."""
    parts = [
        (_capped(_nz(life) / LIFE_EXPECTANCY * 100), 0.25),
        (F.when(mortality != 0, F.greatest(F.lit(0.0), 100 - mortality / 10)), 0.25),
        (_capped(_nz(gp) / GP_TARGET * 100), 0.25),
        (risk, 0.25),
    ]
    return weighted_of_available(parts)


def prevention_index(gp: Column) -> Column:
    return F.least(F.lit(100.0), F.coalesce(gp, F.lit(0.0)) / GP_TARGET * 100)


def social_score(irsad: Column) -> Column:
    return (_nz(irsad) - 500) / 500 * 100


def wellbeing_index(health: Column, irsad: Column, environment: Column) -> Column:
    return mean_of_available([health, social_score(irsad), environment], default=50.0)


def health_inequality(health: Column, national: Column | float = NATIONAL_HEALTH) -> Column:
    n = F.lit(national) if isinstance(national, float) else national
    return F.abs(health - n) / n


def ses_gradient(irsd: Column, health: Column) -> Column:
    ses = (irsd - NATIONAL_SES) / NATIONAL_SES
    hd = (health - NATIONAL_HEALTH) / NATIONAL_HEALTH
    return F.when((irsd != 0) & (health != 0), F.when(ses != 0, hd / ses).otherwise(0.0))


def access_inequality(gp: Column, density: Column) -> Column:
    return F.abs(1.0 - gp / F.greatest(F.lit(1.0), density / 500.0))


def accessibility(gp: Column, specialists: Column) -> Column:
    parts = [F.when(gp > 0, F.least(F.lit(100.0), gp / GP_TARGET * 100)),
             F.when(specialists > 0, F.least(F.lit(100.0), specialists / SPECIALIST_TARGET * 100))]
    return mean_of_available(parts)


def density_factor(population: Column, area: Column) -> Column:
    return F.when((area > 0) & (population > 0), F.least(F.lit(1.0), population / area / 1000.0))


def environment_index(air: Column, green: Column) -> Column:
    return mean_of_available([F.when(air.isNotNull(), F.greatest(F.lit(0.0), 100 - air)), green])


def quality_of_life(distress: Column, irsad: Column, health: Column) -> Column:
    calm = F.when(distress.isNotNull(), F.greatest(F.lit(0.0), 100 - distress))
    return mean_of_available([calm, social_score(irsad), health])


def overall_advantage(irsad: Column, ier: Column, ieo: Column) -> Column:
    """Weighted mean of three scores; a null score counts as 0."""
    parts = [(irsad, 0.4), (ier, 0.3), (ieo, 0.2)]
    return row_sum([c * w for c, w in parts]) / sum(w for _, w in parts)


def disadvantage(decile: Column, scheme: str = "record", unknown: str | None = None) -> Column:
    """Label of a decile under one of the named cut-point schemes."""
    label = label_by_upper(decile, V.DISADVANTAGE[scheme])
    return F.coalesce(label, F.lit(unknown)) if unknown else label


def socioeconomic_category(irsad_decile: Column) -> Column:
    return label_by_upper(irsad_decile, [(3, "Low"), (7, "Medium"), (10, "High")])


def socioeconomic_profile(university: Column, unemployment: Column, ownership: Column, irsad: Column, *,
                          as_coded: bool = False) -> Column:
    """Band of four equally weighted normalised scores; 0 belongs to no band."""
    score = (normalise(university, 0, 50) + normalise(unemployment, 10, 0, inverse=True, as_coded=as_coded)
             + normalise(ownership, 40, 80) + normalise(irsad, 800, 1200)) * 0.25
    return (F.when(score <= 0, None).when(score <= 25, "low").when(score <= 50, "medium-low")
            .when(score <= 75, "medium-high").when(score <= 100, "high"))


def livability(rent: Column, unemployment: Column, university: Column, irsad_decile: Column, *, cohesion: float = 70.0,
               as_coded: bool = False) -> Column:
    score = (normalise(rent, 700, 300, inverse=True, as_coded=as_coded) * 0.25
             + normalise(unemployment, 10, 2, inverse=True, as_coded=as_coded) * 0.25
             + normalise(university, 10, 40) * 0.20 + normalise(irsad_decile, 1, 10) * 0.20 + cohesion * 0.10)
    return F.bround(score, 1)


def economic_opportunity(participation: Column, income: Column, diversity: Column) -> Column:
    return F.bround((normalise(participation, 50, 80) + normalise(income, 40000, 90000) + normalise(diversity, 0.5, 0.9)) / 3, 1)


def housing_pressure(rent: Column, ownership: Column, *, as_coded: bool = False) -> Column:
    return F.bround((normalise(rent, 300, 700) + normalise(ownership, 80, 40, inverse=True, as_coded=as_coded)) / 2, 1)


SOCIAL_COHESION = 72.5


def share_1(num: Column, den: Column) -> Column:
    """Percentage to one decimal, half to even; null where the base is zero."""
    return F.bround(F.when(den != 0, num / den) * 100, 1)


def housing_stress(rent: Column, mortgage: Column, income: Column, owned: Column, dwellings: Column, population: Column) -> Column:
    """Worst of rent and mortgage burden, low ownership and crowding."""
    r, m = rent * 52 / F.when(income != 0, income), mortgage * 12 / F.when(income != 0, income)
    own, size = owned / F.when(dwellings != 0, dwellings), population / F.when(dwellings != 0, dwellings)
    return F.greatest(F.when(r > 0.3, r * 50).otherwise(0.0), F.when(m > 0.3, m * 50).otherwise(0.0),
                      F.when(own < 0.6, (1 - own) * 100).otherwise(0.0), F.when(size > 3, (size - 3) * 20).otherwise(0.0))


def area_development(parts: Sequence[tuple[Column, Column]], irsad: Column | None = None) -> Column:
    """Mean of rates in % and the index score scaled from 600-1400 to 0-100."""
    scores = [n / F.when(d != 0, d) * 100 for n, d in parts]
    if irsad is not None:
        scores.append(F.when(irsad.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), (irsad - 600) / 800 * 100))))
    total = scores[0]
    for s in scores[1:]:
        total = total + s
    return total / len(scores)


def demographic_vulnerability(dependants: Column, population: Column, indigenous: Column, low_schooling: Column,
                              schooling_base: Column, unemployed: Column, labour_force: Column) -> Column:
    def rate(n, d):
        return n / F.when(d != 0, d)
    return (rate(dependants, population) * 100 + rate(indigenous, population) * 50 + rate(low_schooling, schooling_base) * 100
            + rate(unemployed, labour_force) * 200) / 4


def equity_metrics(df: DataFrame, quintile: str, rate: str, worst: str, best: str) -> DataFrame:
    """Rate ratio, rate difference and attributable share between quintile means."""
    m = df.groupBy(quintile).agg(F.avg(rate).alias("m"), F.count(rate).alias("n"))
    t = m.agg(F.max(F.when(F.col(quintile) == worst, F.col("m"))).alias("worst_mean"),
              F.max(F.when(F.col(quintile) == best, F.col("m"))).alias("best_mean"),
              (F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias("overall"))
    return t.select("worst_mean", "best_mean", (F.col("worst_mean") / F.col("best_mean")).alias("rate_ratio"),
                    (F.col("worst_mean") - F.col("best_mean")).alias("rate_difference"),
                    ((F.col("overall") - F.col("best_mean")) / F.col("overall") * 100).alias("attributable_pct"))


def composite_risk(score: Column) -> Column:
    return label_by_lower(score, [(80, "Very High"), (60, "High"), (40, "Moderate"), (20, "Low")], "Very Low")


def improvement(difference: Column) -> Column:
    return F.when(difference == 0, "No Change").when(difference > 0, "Improvement").otherwise("Decline")


def all_indices(df: DataFrame) -> DataFrame:
    """Every index whose inputs df has, in dependency order; absent inputs are null."""
    def c(name):
        return F.col(name).cast("double") if name in df.columns else F.lit(None).cast("double")

    out = df.withColumn("risk_factor_score", risk_score(c("smoking_prevalence"), c("obesity_prevalence"), c("physical_inactivity_prevalence")))
    out = out.withColumn("composite_health_index", composite_health_index(
        c("life_expectancy"), c("age_standardised_mortality_rate"), c("gp_services_per_1000"), F.col("risk_factor_score")))
    health = F.col("composite_health_index")
    out = out.withColumns({
        "prevention_index": prevention_index(c("gp_services_per_1000")),
        "environmental_health_index": environment_index(c("air_quality_index"), c("green_space_access")),
        "health_inequality_index": health_inequality(health),
        "socioeconomic_health_gradient": ses_gradient(c("irsd_score"), health),
        "healthcare_access_inequality": access_inequality(c("gp_services_per_1000"), c("population_density_per_sq_km")),
        "healthcare_accessibility_index": accessibility(c("gp_services_per_1000"), c("specialist_services_per_1000")),
        "quality_of_life_index": quality_of_life(c("psychological_distress_high"), c("irsad_score"), health),
    })
    return out.withColumn("wellbeing_index", wellbeing_index(health, c("irsad_score"), F.col("environmental_health_index")))


