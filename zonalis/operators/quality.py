"""Data-quality rules as boolean columns, evaluated together in one pass.

A rule is (id, severity, column, breach, dimension).  `violations` lists breaches
row by row; `rule_counts` only counts them.  Rules over keys or whole columns are
separate aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.functions import codes, geo
from zonalis.functions import fixed_values as V
from zonalis.functions.ratios import mean_of_available, row_sum, weighted_of_available
from zonalis.operators.common import attach_row

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"


@dataclass(frozen=True)
class Rule:
    rule_id: str
    severity: str
    column: str
    breach: Column
    dimension: str = "validity"


def violations(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """(key, rule_id, severity, column, dimension, value) per breach; one scan."""
    hits = [F.when(F.coalesce(r.breach, F.lit(False)), F.struct(
        F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.lit(r.column).alias("column"),
        F.lit(r.dimension).alias("dimension"),
        (F.col(r.column).cast("string") if r.column in df.columns else F.lit(None).cast("string")).alias("value"))) for r in rules]
    return df.select(key, F.explode(F.array_compact(F.array(*hits))).alias("v")).select(key, "v.*")


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule_id, severity, breaches, rows) for every rule, breached or not."""
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(r.breach, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)])
    return one.select("rows", F.inline(F.array(*[F.struct(
        F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), F.col(f"r{i}").alias("breaches")) for i, r in enumerate(rules)])))


# --- rule builders -----------------------------------------------------------------


def outside(column: str, low: float | None, high: float | None, severity: str = ERROR, rule_id: str | None = None) -> Rule:
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return Rule(rule_id or f"{column}_range", severity, column, bad)


def not_matching(column: str, pattern: str, severity: str = ERROR, rule_id: str | None = None) -> Rule:
    return Rule(rule_id or f"{column}_pattern", severity, column, ~F.col(column).cast("string").rlike(pattern))


def empty(column: str, severity: str = ERROR, rule_id: str | None = None) -> Rule:
    return Rule(rule_id or f"{column}_missing", severity, column,
                F.col(column).isNull() | (F.col(column).cast("string") == ""), "completeness")


def not_of_type(column: str, kind: str, severity: str = ERROR) -> Rule:
    c = F.col(column)
    return Rule(f"{column}_type", severity, column, c.isNotNull() & c.cast("string").try_cast(kind).isNull())


# Fixed values: (absolute low, high, typical low, high) of health indicators.
INDICATOR_RANGES = {
    "life_expectancy_at_birth": (60, 95, 70, 90), "life_expectancy_male": (60, 93, 68, 88), "life_expectancy_female": (62, 97, 72, 92),
    "mortality_rate_all_causes": (100, 2000, 300, 1200), "infant_mortality_rate": (0, 50, 2, 10),
    "smoking_rate": (0, 100, 5, 30), "obesity_rate": (0, 100, 15, 40), "diabetes_prevalence": (0, 100, 2, 15),
    "seifa_index_disadvantage": (400, 1400, 600, 1200), "seifa_index_advantage": (400, 1400, 600, 1200),
    "population_total": (0, 100000, 100, 50000), "median_age": (15, 80, 25, 55), "population_density": (0, 50000, 0.1, 5000),
    "gp_per_1000_population": (0, 10, 0.5, 3), "hospital_beds_per_1000": (0, 20, 1, 8),
}

# Business bounds.
BUSINESS_RANGES = {
    "total_population": (100, 50000), "area_sq_km": (0.1, 50000), "mortality_rate": (0, 50), "hospital_separation_rate": (0, 2000),
    "services_per_capita": (0, 100), "benefits_per_capita": (0, 10000), "prescriptions_per_capita": (0, 50),
    "pbs_cost_per_capita": (0, 5000), "seifa_score": (400, 1200), "seifa_decile": (1, 10),
}


def indicator_rules(columns: Sequence[str], ranges: Mapping = INDICATOR_RANGES) -> list[Rule]:
    """Error outside the absolute range, warning outside the typical one."""
    out = []
    for c, (lo, hi, tlo, thi) in ranges.items():
        if c in columns:
            out.append(outside(c, lo, hi, ERROR, f"{c}_absolute"))
            inside = F.col(c).between(lo, hi)
            out.append(Rule(f"{c}_typical", WARNING, c, inside & ~F.col(c).between(tlo, thi)))
    return out


def business_range_rules(columns: Sequence[str]) -> list[Rule]:
    return [outside(c, lo, hi, ERROR, f"{c}_bounds") for c, (lo, hi) in BUSINESS_RANGES.items() if c in columns]


def _gap(parts: Sequence[str], total: str) -> Column:
    t = F.col(total)
    return F.when(t > 0, F.abs(row_sum(parts) - t) / t).otherwise(1.0)


def business_consistency_rules(columns: Sequence[str], age_columns: Sequence[str] = ()) -> list[Rule]:
    """Relations between columns; only those whose columns exist."""
    c, have, out = F.col, set(columns), []

    if {"estimate", "ci_lower", "ci_upper"} <= have:
        out.append(Rule("confidence_interval", ERROR, "estimate", ~c("estimate").between(c("ci_lower"), c("ci_upper")), "consistency"))
    if age_columns and "total_population" in have:
        out.append(Rule("age_group_totals", ERROR, "total_population", _gap(age_columns, "total_population") > 0.02, "consistency"))
    if {"males", "females", "total_population"} <= have:
        out.append(Rule("sex_distribution", ERROR, "total_population", _gap(["males", "females"], "total_population") > 0.01, "consistency"))
    if {"income_q1", "income_median", "income_q3"} <= have:
        out.append(Rule("income_quartiles", ERROR, "income_median",
                        (c("income_q1") > c("income_median")) | (c("income_median") > c("income_q3")), "consistency"))
    if {"sa2_code", "sa3_code"} <= have:
        out.append(Rule("sa2_within_sa3", ERROR, "sa2_code", ~c("sa2_code").startswith(c("sa3_code")), "consistency"))
    if {"median_age", "mortality_rate"} <= have:
        out.append(Rule("young_area_high_mortality", WARNING, "mortality_rate", (c("median_age") < 30) & (c("mortality_rate") > 30), "consistency"))
    if "indigenous_percentage" in have:
        out.append(Rule("indigenous_share", WARNING, "indigenous_percentage", c("indigenous_percentage") > 95))
    if {"total_population", "area_sq_km", "services_per_capita"} <= have:
        density = c("total_population") / F.when(c("area_sq_km") > 0, c("area_sq_km"))
        out.append(Rule("remote_area_services", WARNING, "services_per_capita", (density < 0.5) & (c("services_per_capita") > 150), "consistency"))
    return out


def several_years(df: DataFrame, year: str) -> DataFrame:
    return df.agg(F.count_distinct(year).alias("years")).withColumn("mixed_years", F.col("years") > 1)


def census_warning_counts(df: DataFrame) -> DataFrame:
    """Negative counts, extreme rates and sums that miss their total, in one pass."""
    c, have, rules = F.col, set(df.columns), []
    for name in ("employed_full_time", "employed_part_time", "unemployed", "not_in_labour_force", "separate_house", "rented", "owned_outright"):
        if name in have:
            rules.append(Rule(f"{name}_negative", WARNING, name, c(name) < 0))
    # Least and most of rates that pass without a warning.
    limits = {"unemployment_rate": (None, 25), "participation_rate": (30, 95), "home_ownership_rate": (20, 95),
              "internet_penetration_rate": (50, 99), "separate_house_pct": (None, 98), "no_vehicle_rate": (5, 70), "estimated_avg_vehicles": (None, 3)}
    for name, (lo, hi) in limits.items():
        if name in have:
            rules.append(outside(name, lo, hi, WARNING, f"{name}_extreme"))
    if {"total_labour_force", "not_in_labour_force", "labour_force_pop"} <= have:
        rules.append(Rule("labour_force_sum", WARNING, "labour_force_pop",
                          F.abs(c("total_labour_force") + c("not_in_labour_force") - c("labour_force_pop")) > c("labour_force_pop") * 0.05))
    if {"rented", "total_landlord_classified"} <= have:
        rules.append(Rule("landlord_sum", WARNING, "rented", F.abs(c("rented") - c("total_landlord_classified")) > 5))
    if set(V.AGE_MIDPOINTS) | {"total_population"} <= have:
        rules.append(Rule("age_sum", WARNING, "total_population", F.abs(row_sum(list(V.AGE_MIDPOINTS)) - c("total_population")) > 5))
    return rule_counts(df, rules)


def hierarchy_rules(code: str = "sa2_code", sa3: str = "sa3_code", sa4: str = "sa4_code", state: str = "state_code") -> list[Rule]:
    c = F.col(code)
    return [
        Rule("sa2_format", ERROR, code, ~codes.valid_code(c, "SA2")),
        Rule("sa2_in_sa3", ERROR, sa3, ~c.startswith(F.col(sa3)), "consistency"),
        Rule("sa3_in_sa4", ERROR, sa4, ~F.col(sa3).startswith(F.col(sa4)), "consistency"),
        Rule("sa4_in_state", ERROR, state, ~F.col(sa4).startswith(F.col(state)), "consistency"),
        Rule("chain_incomplete", WARNING, code, F.col(sa3).isNull() | F.col(sa4).isNull() | F.col(state).isNull(), "completeness"),
    ]


def coordinate_rules(lon: str, lat: str, state: str | None = None) -> list[Rule]:
    x, y = F.col(lon), F.col(lat)
    out = [
        Rule("coordinate_missing", ERROR, lat, x.isNull() | y.isNull(), "completeness"),
        Rule("latitude_range", ERROR, lat, ~y.between(-90, 90)), Rule("longitude_range", ERROR, lon, ~x.between(-180, 180)),
        Rule("outside_australia", WARNING, lon, ~geo.in_bounds(x, y, V.BOUNDS["all_territories"])),
        Rule("null_island", ERROR, lon, (x == 0) & (y == 0)),
        Rule("low_precision", INFO, lat, (codes.decimal_places(x) < 4) | (codes.decimal_places(y) < 4), "accuracy"),
    ]
    if state:
        inside = F.lit(None).cast("boolean")
        for s, box in V.STATE_BOUNDS.items():
            inside = F.when(F.col(state) == s, geo.in_bounds(x, y, box)).otherwise(inside)
        out.append(Rule("state_mismatch", WARNING, state, ~inside, "consistency"))
    return out


def duplicate_coordinates(df: DataFrame, lon: str, lat: str, places: int = 6) -> DataFrame:
    """Rounded locations that more than one row shares."""
    g = df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()).groupBy(F.round(lon, places).alias("lon"), F.round(lat, places).alias("lat"))
    return g.agg(F.count(F.lit(1)).alias("areas")).filter("areas > 1")


# Box of any centroid, and the four coastal lines of the near-coast guess.
CENTROID_BOX = (72.246, 167.998, -54.777, -9.142)
COAST = {"lat": (-43.7, -10.7), "lon": (113.2, 153.6)}


def plausibility_rules(area: str, population: str, lon: str, lat: str, coastal: str | None = None) -> list[Rule]:
    """Area, density, centroid and, given a coastal flag, its agreement with the coordinates."""
    a, p, x, y = F.col(area), F.col(population), F.col(lon), F.col(lat)
    density = p / F.when(a > 0, a)
    out = [
        Rule("area_below_minimum", ERROR, area, a < 0.001), Rule("area_above_maximum", WARNING, area, a > 100000),
        Rule("density_zero_area", ERROR, area, a <= 0), Rule("density_extreme", WARNING, population, density > 50000),
        Rule("centroid_outside", ERROR, lon, ~geo.in_bounds(x, y, CENTROID_BOX)),
    ]
    if coastal:
        near = F.lit(False)
        for line in COAST["lat"]:
            near = near | (F.abs(y - line) < 0.5)
        for line in COAST["lon"]:
            near = near | (F.abs(x - line) < 0.5)
        out.append(Rule("coastal_mismatch", INFO, coastal, F.col(coastal) != near, "consistency"))
    return out


def boundary_rules(kind: str, code: str, parent: str, rings: str, area: str) -> list[Rule]:
    """Ring rules, parent present, code digits of the level, area within the level's range."""
    digits = F.create_map(*[F.lit(x) for kv in V.CODE_DIGITS.items() for x in kv])
    # Least and greatest area in km2 by level.
    low = codes.literal_map({"SA1": 0.1, "SA2": 1.0, "SA3": 10.0, "SA4": 100.0})
    high = codes.literal_map({"SA1": 50.0, "SA2": 500.0, "SA3": 5000.0, "SA4": 50000.0})
    k = F.col(kind)
    return [
        Rule("ring_invalid", ERROR, code, F.exists(rings, lambda r: F.size(geo.ring_problems(r)) > 0)),
        Rule("parent_missing", WARNING, parent, (k != "STATE") & (F.col(parent).isNull() | (F.col(parent) == "")), "completeness"),
        Rule("code_digits", ERROR, code, (F.length(code) != F.try_element_at(digits, k)) | ~F.col(code).rlike(r"^\d+$")),
        Rule("area_range", WARNING, area, (F.col(area) < F.try_element_at(low, k)) | (F.col(area) > F.try_element_at(high, k))),
    ]


def schema_integrity_rules(kind: str, columns: Sequence[str]) -> list[Rule]:
    """Relations each entity's records must keep."""
    c, have = F.col, set(columns)
    sets: dict[str, list[tuple[set, Rule]]] = {
        "census": [({"males", "females", "total_population"}, lambda: Rule("sex_total", ERROR, "total_population",
                    F.abs(c("males") + c("females") - c("total_population")) > 3, "consistency")),
                   ({"unoccupied_private_dwellings", "occupied_private_dwellings", "total_private_dwellings"}, lambda: Rule(
                       "dwelling_total", ERROR, "total_private_dwellings",
                       c("unoccupied_private_dwellings") + c("occupied_private_dwellings") > c("total_private_dwellings"), "consistency"))],
        "health": [({"value", "confidence_lower", "confidence_upper"}, lambda: Rule(
                       "interval_holds_value", ERROR, "value", ~c("value").between(c("confidence_lower"), c("confidence_upper")), "consistency")),
                   ({"deaths", "population"}, lambda: Rule("deaths_in_population", ERROR, "deaths", c("deaths") > c("population"), "consistency"))],
        "weather": [({"min_temperature", "max_temperature"}, lambda: Rule("temperature_order", ERROR, "max_temperature",
                      c("min_temperature") > c("max_temperature"), "consistency")),
                    ({"sunshine_hours"}, lambda: Rule("sunshine_hours", ERROR, "sunshine_hours", c("sunshine_hours") > 16))],
        "seifa": [({"score", "decile"}, lambda: Rule("decile_range", ERROR, "decile", ~c("decile").between(1, 10))),
                  ({"score"}, lambda: Rule("score_range", ERROR, "score", ~c("score").between(1, 2000)))],
        "sa2": [({"sa2_code", "sa3_code"}, lambda: Rule("sa2_prefix", ERROR, "sa2_code", ~c("sa2_code").startswith(c("sa3_code")), "consistency"))],
        "mortality": [({"age_at_death"}, lambda: Rule("age_at_death", WARNING, "age_at_death", c("age_at_death") > 120)),
                      ({"death_year", "registration_year"}, lambda: Rule("registration_gap", WARNING, "registration_year",
                        F.abs(c("death_year") - c("registration_year")) > 3, "consistency"))],
    }
    return [make() for needs, make in sets[kind] if needs <= have]


def demographic_stage_rules(age_columns: Sequence[str]) -> list[Rule]:
    c = F.col
    total = c("total_population")
    off = F.abs(c("males") + c("females") - total)
    return [
        Rule("population_mismatch", WARNING, "total_population", off > F.greatest(F.lit(10.0), total * 0.01), "consistency"),
        outside("total_population", 0, 100000, ERROR, "population_bounds"),
        Rule("age_mismatch", WARNING, "total_population", F.abs(row_sum(age_columns) - total) > total * 0.05, "consistency"),
    ]


# --- schema, keys and standards --------------------------------------------------------


def schema_check(df: DataFrame, expected: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """(column, problem, rows): missing, unexpected and ill-typed columns."""
    names = [f.name for f in expected.fields]
    fixed = [(c, "missing_required" if c in required else "missing") for c in names if c not in df.columns]
    fixed += [(c, "unexpected") for c in df.columns if c not in names]
    typed = [f for f in expected.fields if f.name in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).cast("string").try_cast(f.dataType).isNull()).alias(f"t_{f.name}") for f in typed])
    cells = [F.struct(F.lit(c).alias("column"), F.lit(p).alias("problem"), F.col("rows").alias("rows")) for c, p in fixed]
    cells += [F.struct(F.lit(f.name).alias("column"), F.lit("wrong_type").alias("problem"), F.col(f"t_{f.name}").alias("rows")) for f in typed]
    return one.select(F.inline(F.array(*cells))).filter("rows > 0")


def export_limits(df: DataFrame, fmt: str) -> list[str]:
    """What keeps a frame from a format: nested columns in csv, no geometry in geojson."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    if fmt == "csv":
        return [f"nested column {c}" for c in nested]
    if fmt == "geojson" and not any("geometry" in c or c.lower().startswith("lat") for c in df.columns):
        return ["no geometry"]
    return []


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def standard_gaps(df: DataFrame, standards: DataFrame) -> DataFrame:
    """(standard, field, null share, requirement, met) for a table of standards with
    (standard, field, required_share)."""
    one = df.agg(*[F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in df.columns])
    share = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("share")) for c in df.columns])))
    return standards.join(share, "field", "left").select(
        "standard", "field", F.coalesce("share", F.lit(0.0)).alias("share"), "required_share",
        (F.coalesce("share", F.lit(0.0)) >= F.col("required_share")).alias("met"))


def compliance(df: DataFrame, code: str = "sa2_code", life: str = "life_expectancy") -> DataFrame:
    """Share of rows meeting the reporting and the geography standard, and their mean."""
    s = df.agg(F.avg(F.col(life).isNotNull().cast("int")).alias("reporting"),
               F.avg(F.coalesce(F.col(code).rlike(r"^\d{9}$"), F.lit(False)).cast("int")).alias("geography"))
    return s.withColumn("score", (F.col("reporting") + F.col("geography")) / 2 * 100)


# --- scores ------------------------------------------------------------------------------

# Weights and cut points of the scores.
PRIORITY_WEIGHTS = {"critical": 1.0, "high": 0.8, "medium": 0.6, "low": 0.4}
SCORE_WEIGHTS = {"completeness": 0.25, "validity": 0.25, "consistency": 0.20, "accuracy": 0.15, "timeliness": 0.10, "uniqueness": 0.05}


def grade(score: Column) -> Column:
    return codes.label_by_lower(score, [(0.95, "EXCELLENT"), (0.85, "GOOD"), (0.70, "ACCEPTABLE"), (0.50, "POOR")], "CRITICAL")


def quality_score(df: DataFrame, *, completeness: Mapping[str, Sequence[str]], validity: Mapping[str, Column], consistency: Sequence[Column],
                  dated: Column, as_of, max_age_months: int = 24, keys: Sequence[str] = (), accuracy: float = 0.9) -> DataFrame:
    """Six dimension scores, weighted total and grade.

    `validity` maps a column to the condition its non-null values must meet;
    `consistency` conditions must hold on every row.
    """
    aggs, top, low = [], None, 0.0
    for priority, cols in completeness.items():
        w = PRIORITY_WEIGHTS.get(priority, 0.5)
        for c in cols:
            e = F.avg((F.col(c).isNotNull() & (F.col(c).cast("string") != "")).cast("int")) * w
            top, low = e if top is None else top + e, low + w
    aggs.append((top / low).alias("completeness"))
    valid = [F.sum((F.col(c).isNotNull() & F.coalesce(ok, F.lit(False))).cast("int")) / F.when(F.count(c) > 0, F.count(c)) for c, ok in validity.items()]
    aggs.append(mean_of_available(valid, default=1.0).alias("validity"))
    agreed = [F.avg(F.coalesce(ok, F.lit(False)).cast("int")) for ok in consistency]
    aggs.append((row_sum(agreed) / len(agreed) if agreed else F.lit(1.0)).alias("consistency"))
    aggs.append(F.lit(accuracy).alias("accuracy"))
    months = F.datediff(F.lit(as_of).cast("date"), dated) / 30.44
    aggs.append(F.avg(F.coalesce(months <= max_age_months, F.lit(False)).cast("int")).alias("timeliness"))
    aggs.append(F.count(F.lit(1)).alias("rows"))
    s = df.agg(*aggs)
    if keys:
        distinct = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("k")).agg((F.count(F.lit(1)) / F.sum("k")).alias("uniqueness"))
        s = attach_row(s, distinct)
    else:
        s = s.withColumn("uniqueness", F.lit(1.0))
    total = None
    for d, w in SCORE_WEIGHTS.items():
        total = F.col(d) * w if total is None else total + F.col(d) * w
    return s.withColumn("overall", total).withColumn("grade", grade(F.col("overall")))


def summary(found: DataFrame, key: str, rows: int | Column) -> DataFrame:
    """Errors, warnings, infos, affected entities and success rate of a violation list."""
    s = found.agg(F.count(F.lit(1)).alias("validations"), F.count_if(F.col("severity") == ERROR).alias("errors"),
                  F.count_if(F.col("severity") == WARNING).alias("warnings"), F.count_if(F.col("severity") == INFO).alias("infos"),
                  F.count_distinct(key).alias("affected"))
    rate = F.when(F.col("validations") > 0, 1 - F.col("errors") / F.col("validations")).otherwise(1.0)
    return s.withColumns({"success_rate": rate, "rows": F.lit(rows) if isinstance(rows, int) else rows})


# Weights of the reported dimensions.
DIMENSION_WEIGHTS = {"completeness": 0.3, "accuracy": 0.25, "consistency": 0.2, "validity": 0.15, "timeliness": 0.1}


def dimension_scores(found: DataFrame, total_rows: DataFrame) -> DataFrame:
    """max(0, 1 − (2·errors + warnings) / rows) per dimension; total_rows is one row (rows)."""
    d = found.groupBy("dimension").agg(F.count_if(F.col("severity") == ERROR).alias("errors"), F.count_if(F.col("severity") == WARNING).alias("warnings"))
    d = attach_row(d, total_rows.select("rows"))
    return d.withColumn("score", F.greatest(F.lit(0.0), 1 - (2 * F.col("errors") + F.col("warnings")) / F.col("rows")))


def overall_from_dimensions(scores: DataFrame) -> DataFrame:
    w = F.coalesce(F.try_element_at(codes.literal_map(DIMENSION_WEIGHTS), F.col("dimension")), F.lit(0.1))
    s = scores.agg((F.sum(F.col("score") * w) / F.sum(w)).alias("overall"))
    return s.withColumn("grade", grade(F.col("overall")))


def top_rules(found: DataFrame, n: int = 10) -> DataFrame:
    return found.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "rule_id").limit(n)


def counts_per_hour(found: DataFrame, ts: str) -> DataFrame:
    return found.groupBy(F.date_format(F.date_trunc("hour", ts), "yyyy-MM-dd HH:00").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def stage_metrics(df: DataFrame, rules: Sequence[Rule], critical: Sequence[str] = (), *, threshold: float = 95.0, mode: str = "strict") -> DataFrame:
    """Rules passed %, mean column completeness %, and the gate's decision.

    strict: score and critical rules; permissive: critical rules only; selective:
    critical rules, with a low score passing as a warning.
    """
    aggs = [F.count_if(F.coalesce(r.breach, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)]
    one = df.agg(*aggs, F.count(F.lit(1)).alias("rows"), *[F.avg(F.col(c).isNotNull().cast("int")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    passed = row_sum([(F.col(f"r{i}") == 0).cast("int") for i in range(len(rules))])
    failed_critical = F.lit(False)
    for i, r in enumerate(rules):
        if r.rule_id in critical:
            failed_critical = failed_critical | (F.col(f"r{i}") > 0)
    score = passed / len(rules) * 100
    low = score < threshold
    gate = {"strict": F.when(failed_critical | low, "failed").otherwise("passed"),
            "permissive": F.when(failed_critical, "failed").otherwise("passed"),
            "selective": F.when(failed_critical, "failed").when(low, "passed_with_warnings").otherwise("passed")}[mode]
    complete = row_sum([F.col(f"c{i}") for i in range(len(df.columns))]) / len(df.columns) * 100
    return one.select("rows", score.alias("quality_score"), complete.alias("completeness_score"),
                      F.floor(F.col("rows") * score / 100).alias("passed_records"), gate.alias("gate"))


def require(gate: DataFrame) -> None:
    """Stop the job when its gate failed; the frame has one row."""
    row = gate.first()
    if row["gate"] == "failed":
        raise RuntimeError(f"quality gate failed: {row.asDict()}")


def census_quality(df: DataFrame, domains: Sequence[str], *, population: str, working_age: str, university: str | None = None,
                   professional: str | None = None, tolerance: float = 0.05) -> dict[str, Column]:
    """Per row: completeness by domain suffix and their mean (0-1, three decimals), the
    working-age share within 60-80 % less tolerance, and the consistency mean."""
    parts = {}
    for d in domains:
        cols = [c for c in df.columns if c.endswith(f"_{d}")]
        share = row_sum([F.col(c).isNotNull().cast("int") for c in cols]) / len(cols) if cols else F.lit(0.0)
        parts[f"{d}_completeness"] = F.bround(share, 3)
    ratio = F.col(working_age) / F.when(F.col(population) > 0, F.col(population))
    ok = F.coalesce(ratio.between(0.6 * (1 - tolerance), 0.8 * (1 + tolerance)), F.lit(True))
    checks = [ok.cast("double")]
    if university and professional:
        checks.append(1 - F.abs(F.col(university) - F.col(professional)) / 100)
    return {**parts, "data_completeness_score": F.bround(row_sum(list(parts.values())) / len(parts), 3),
            "population_consistency_flag": ok, "consistency_score": F.bround(mean_of_available(checks, default=1.0), 3)}


def census_overall(completeness: Column, join_rate: Column, temporal: Column, validation: Column, conflicts: Column) -> Column:
    """Weighted mean of the parts present less two points per conflict, at most 20."""
    weighted = weighted_of_available([(completeness, 0.3), (join_rate, 0.25), (temporal, 0.2), (validation, 0.25)])
    return F.greatest(F.lit(0.0), weighted - F.least(conflicts * 2, F.lit(20)))


def health_stage(df: DataFrame) -> dict[str, Column]:
    """Completeness % of five health fields, and quality of the indicators present."""
    fields = ["life_expectancy", "mortality_indicators", "chronic_disease_prevalence", "gp_services_per_1000", "bulk_billing_rate"]

    def filled(c):
        if c not in df.columns:
            return F.lit(0)
        ok = F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, T.MapType):
            ok = ok & (F.size(c) > 0)
        return ok.cast("int")

    def share(c, hi):
        if c not in df.columns:
            return F.lit(None).cast("double")
        v = F.map_values(c)
        return F.when(F.size(v) > 0, F.size(F.filter(v, lambda x: x.between(0, hi))) / F.size(v))

    # The plausible life expectancy and what others count; most of an indicator's values above.
    life = F.when(F.col("life_expectancy") != 0, F.when(F.col("life_expectancy").between(70, 90), 1.0).otherwise(0.5))
    overall = mean_of_available([life, share("mortality_indicators", 5000), share("chronic_disease_prevalence", 100)], default=0.0)
    return {"health_data_completeness": row_sum([filled(c) for c in fields]) / len(fields) * 100, "health_overall_quality_score": overall}


def demographic_stage(columns: Sequence[str], age_columns: Sequence[str], indices: Sequence[str]) -> dict[str, Column]:
    """Completeness of population, ages, index scores and place, their mean, and flags."""
    def share(names):
        have = [F.col(c).isNotNull().cast("int") for c in names if c in columns]
        return row_sum(have) / len(names) if have else F.lit(0.0)

    people = ["total_population", "male_population", "female_population"]
    scores = [f"{i}_{k}" for i in indices for k in ("score", "decile")]
    ages = F.least(F.lit(1.0), row_sum([(F.col(c) >= 0).cast("int") for c in age_columns if c in columns]) / 6.0)
    parts = {"population": share(people), "age_distribution": ages, "seifa": share(scores), "geographic": share(["sa2_code", "sa2_name", "boundary_data"])}
    total = F.col("total_population")
    # Five people or 0.5 % apart are close, six age columns are complete.
    close = F.abs(total - (F.col("male_population") + F.col("female_population"))) <= F.greatest(F.lit(5.0), total * 0.005)
    full = F.lit(True)
    for i in indices:
        full = full & (F.col(f"{i}_score").isNotNull() if f"{i}_score" in columns else F.lit(False))
    flags = [F.when(close, "high_quality_population"), F.when(full, "complete_seifa"),
             F.lit("complete_age_distribution") if len([c for c in age_columns if c in columns]) >= 6 else F.lit(None).cast("string"),
             F.lit("indigenous_data_available") if "indigenous_population_percentage" in columns else F.lit(None).cast("string")]
    return {**{f"{k}_completeness": v for k, v in parts.items()}, "demographic_overall_completeness": row_sum(list(parts.values())) / 4,
            "demographic_quality_flags": F.array_compact(F.array(*flags))}


def geographic_stage(code: str, sa3: str, sa4: str, state: str, lon: str, lat: str, area: str, geometry: Column, classes: Sequence[str]) -> dict[str, Column]:
    """Mean of completeness (hierarchy, boundary, geometry, classes) and accuracy
    (coordinates, area, hierarchy), halves of the overall quality."""
    def share(cols):
        return row_sum([F.col(c).isNotNull().cast("int") for c in cols]) / len(cols)

    # Twelve decimal places are full accuracy, areas from 0.1 to 10000 square km are plausible.
    complete = (share([sa3, sa4, state]) + share([lat, lon, area]) + geometry.isNotNull().cast("int") + share(classes)) / 4
    digits = codes.decimal_places(F.col(lat)) + codes.decimal_places(F.col(lon))
    coordinates = F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.least(F.lit(1.0), digits / 12)).otherwise(0.0)
    size = F.when(F.col(area).between(0.1, 10000), 1.0).when(F.col(area).isNotNull(), 0.5).otherwise(0.0)
    c = F.col(code)
    chain = mean_of_available([F.col(code).startswith(F.col(sa3)).cast("int"), F.col(sa3).startswith(F.col(sa4)).cast("int"),
                               (codes.state_of_code(c) == F.col(state)).cast("int")], default=0.0)
    accurate = (coordinates + size + chain) / 3
    flags = [F.when(codes.decimal_places(F.col(lat)) >= 6, "high_precision_coordinates"),
             F.when(F.col(sa3).isNotNull() & F.col(sa4).isNotNull() & F.col(state).isNotNull(), "complete_hierarchy"),
             F.when(geometry.isNotNull(), "valid_geometry"), F.when(share(classes) == 1, "complete_classifications")]
    return {"geographic_completeness": complete, "geographic_accuracy": accurate, "geographic_overall_quality": (complete + accurate) / 2,
            "geographic_quality_flags": F.array_compact(F.array(*flags))}


def geographic_score(df: DataFrame, code: str, kind: str, rules: Sequence[Rule], threshold: float = 90.0) -> DataFrame:
    """100·(1 − breaches/rows), cell completeness, code presence and pass/warn/fail."""
    bad = row_sum([F.coalesce(r.breach, F.lit(False)).cast("int") for r in rules])
    s = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(bad).alias("errors"), F.count(code).alias("codes"), F.count(kind).alias("kinds"))
    score = F.greatest(F.lit(0.0), 1 - F.col("errors") / F.col("rows")) * 100
    return s.select("rows", "errors", score.alias("quality_score"), ((F.col("codes") + F.col("kinds")) / (F.col("rows") * 2) * 100).alias("completeness_score"),
                    (F.col("codes") / F.col("rows") * 100).alias("accuracy_score"),
                    F.when(score >= threshold, "passed").when(F.col("errors") > 0, "failed").otherwise("warning").alias("status"))


def model_summary(df: DataFrame, key: str, rules: Sequence[Rule], n: int = 10) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid, warned rows and success rate; the n commonest breached rules)."""
    errors = row_sum([F.coalesce(r.breach, F.lit(False)).cast("int") for r in rules if r.severity == ERROR])
    warns = row_sum([F.coalesce(r.breach, F.lit(False)).cast("int") for r in rules if r.severity == WARNING])
    s = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(errors == 0).alias("valid"), F.count_if(errors > 0).alias("invalid"), F.count_if(warns > 0).alias("warned"))
    return s.withColumn("success_rate", F.col("valid") / F.col("rows")), top_rules(violations(df, key, rules), n)


def metric_alerts(metrics: DataFrame, name: str, value: str, thresholds: Mapping[str, float]) -> DataFrame:
    """Metric rows over their threshold."""
    limit = F.try_element_at(codes.literal_map({k: float(v) for k, v in thresholds.items()}), F.col(name))
    return metrics.withColumn("threshold", limit).filter(F.col(value) > F.col("threshold"))
