"""Several sources, one record: conflict resolution, source choice, rules, levels.

The working form is long: one row per (key, field, source) with its value as
text, a quality in 0-1 and a timestamp.  Everything is an aggregate of constant
size per key, combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions.codes import literal_map
from zonalis.functions.ratios import row_sum

# Coverage by source, source order and field orders.
SOURCE_COVERAGE = {
    "census": 0.95, "seifa": 0.98, "health_indicators": 0.85,
    "geographic_boundaries": 0.99, "medicare_pbs": 0.80, "environmental": 0.70,
}
SOURCE_PRIORITY = {
    "census": 1, "seifa": 2, "health_indicators": 3,
    "geographic_boundaries": 4, "medicare_pbs": 5, "environmental": 6,
}
FIELD_PRIORITY = {
    "total_population": ["census", "health_indicators", "seifa"],
    "life_expectancy": ["health_indicators", "aihw", "abs"],
    "seifa_irsd_score": ["seifa", "abs"],
    "gp_services_per_1000": ["medicare_pbs", "health_indicators"],
}
MANDATORY_FIELDS = [
    "sa2_code", "sa2_name", "geographic_hierarchy", "boundary_data", "total_population",
    "demographic_profile", "seifa_scores", "seifa_deciles", "data_completeness_score", "integration_level",
]
KEY_INDICATORS = ["life_expectancy", "gp_services_per_1000", "bulk_billing_rate", "total_population",
                  "median_age", "seifa_scores", "boundary_data"]
# Names of the strategies.
STRATEGIES = ("highest_quality", "most_recent", "source_priority", "weighted_average", "consensus", "manual")


def overall_quality(completeness: Column, source: Column, reliability: Column | float = 1.0) -> Column:
    coverage = F.coalesce(F.try_element_at(literal_map(SOURCE_COVERAGE), source), F.lit(0.5))
    return completeness * 0.4 + coverage * 0.3 + F.lit(reliability) * 0.3


def field_priority(field: Column, source: Column) -> Column:
    """Place in the field's own order, else in the general order, else 999."""
    own = {f"{f}|{s}": i for f, order in FIELD_PRIORITY.items() for i, s in enumerate(order)}
    return F.coalesce(F.try_element_at(literal_map(own), F.concat_ws("|", field, source)),
                      F.try_element_at(literal_map(SOURCE_PRIORITY), source), F.lit(999))


def strategy_for(field: Column, default: str = "highest_quality") -> Column:
    return (F.when(field.rlike("rate|percentage|prevalence"), "weighted_average")
            .when(field.rlike("code|name|category"), "consensus").otherwise(default))


def resolve_conflicts(df: DataFrame, key: Sequence[str], field: str, *, source: str = "source", value: str = "value",
                      quality: str = "quality", ts: str = "ts", as_of, strategy: Column | None = None,
                      min_sources: int = 3, share: float = 0.7, power: float = 2.0) -> DataFrame:
    """(key, field, resolved, confidence, strategy, sources) per conflicting field.

    Equal qualities, times or priorities fall to the first source by name, then to the
    least value; equally common values to the shorter, then to the least.
    """
    ident = [*key, field]
    rows = df.filter(F.col(value).isNotNull())
    q = F.col(quality)
    weight = F.pow(q, F.lit(power))
    number = F.col(value).try_cast("double")
    # First per distinct value, so consensus counts need no list of values.
    per_value = rows.groupBy(*ident, value).agg(
        F.count(F.lit(1)).alias("_k"),
        F.min(F.struct((-q).alias("q"), F.col(source).alias("s"))).alias("_best"),
        F.min(F.struct((-F.unix_micros(F.col(ts).cast("timestamp"))).alias("t"), F.col(source).alias("s"))).alias("_newest"),
        F.min(F.struct(field_priority(F.col(field), F.col(source)).alias("p"), F.col(source).alias("s"))).alias("_first"),
        F.sum(q).alias("_sq"), F.sum(weight).alias("_w"), F.sum(number * weight).alias("_vw"))
    v = F.col(value)
    g = per_value.groupBy(*ident).agg(
        F.sum("_k").alias("sources"),
        F.min_by(v, F.struct("_best", v)).alias("_by_quality"), (-F.min("_best")["q"]).alias("_top_quality"),
        F.min_by(v, F.struct("_newest", v)).alias("_by_time"), (-F.min("_newest")["t"]).alias("_newest_us"),
        F.min_by(v, F.struct("_first", v)).alias("_by_priority"), (F.sum("_sq") / F.sum("_k")).alias("_mean_quality"),
        F.bool_and(number.isNotNull()).alias("_numeric"), F.try_divide(F.sum("_vw"), F.sum("_w")).alias("_weighted"),
        F.max("_k").alias("_most"), F.min_by(v, F.struct((-F.col("_k")).alias("k"), F.length(v).alias("l"), v)).alias("_common"))
    s = strategy if strategy is not None else strategy_for(F.col(field))
    age = F.floor((F.unix_micros(F.lit(as_of).cast("timestamp")) - F.col("_newest_us")) / 86_400_000_000)
    agreed = (F.col("sources") >= min_sources) & (F.col("_most") / F.col("sources") >= share)
    weighted = F.col("_numeric") & (s == "weighted_average")
    g = g.withColumns({
        "strategy": s,
        "resolved": F.when(s == "manual", None).when(s == "most_recent", F.col("_by_time"))
        .when(s == "source_priority", F.col("_by_priority")).when(weighted, F.col("_weighted").cast("string"))
        .when((s == "consensus") & agreed, F.col("_common")).otherwise(F.col("_by_quality")),
        "confidence": F.when(s == "manual", 0.0).when(s == "most_recent", F.greatest(F.lit(0.5), 1 - age / 365.0))
        .when(weighted, F.col("_mean_quality")).when((s == "consensus") & agreed, F.col("_most") / F.col("sources"))
        .otherwise(F.col("_top_quality")),
    })
    return g.select(*ident, "strategy", "resolved", "confidence", "sources")


def best_value_per_field(df: DataFrame, key: Sequence[str], field: str, source: str, value: str, quality: str) -> DataFrame:
    """The value of the highest quality with its source, and the other sources' values.

    Sources are first reduced to one row each, so the map holds as many entries as
    there are distinct sources.
    """
    ident = [*key, field]
    per_source = df.filter(F.col(value).isNotNull()).groupBy(*ident, source).agg(
        F.min_by(value, F.struct((-F.col(quality)).alias("q"), F.col(value))).alias("_v"), F.max(quality).alias("_q"))
    g = per_source.groupBy(*ident).agg(
        F.min_by(F.struct(F.col("_v").alias("value"), F.col(source).alias("selected_source"), F.col("_q").alias("confidence")),
                 F.struct((-F.col("_q")).alias("q"), F.col(source))).alias("_b"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(source, "_v")))).alias("_all"))
    return g.select(*ident, "_b.*", F.map_filter("_all", lambda k, _: k != F.col("_b.selected_source")).alias("alternatives"))


def fields_to_columns(best: DataFrame, key: Sequence[str], field: str, value: str, fields: Mapping[str, str]) -> DataFrame:
    """Resolved long rows as one row per key; `fields` gives each column's type."""
    picks = [F.max(F.when(F.col(field) == f, F.col(value))).try_cast(t).alias(f) for f, t in fields.items()]
    return best.groupBy(*key).agg(*picks)


def quality_dimensions(value: Column, field: Column, related_share: Column, updated: Column, as_of, consistency: Column,
                       reliability: Column, half_life: float = 365.0) -> dict[str, Column]:
    """Completeness, accuracy, timeliness, consistency and reliability of one value."""
    number = value.try_cast("double")
    ranged = F.when(number.isNull(), 0.5).when(number.between(0, 100), 1.0).otherwise(0.5)
    people = F.when(number.isNull(), 0.5).when(number >= 0, 1.0).otherwise(0.0)
    accuracy = (F.when(value.isNull(), 0.0).when(field.rlike("percentage|rate"), ranged)
                .when(field.contains("population"), people).otherwise(0.9))
    days = F.datediff(F.lit(as_of).cast("date"), updated)
    return {
        "completeness": F.when(value.isNull(), 0.0).otherwise(F.coalesce(related_share, F.lit(1.0))),
        "accuracy": accuracy, "timeliness": F.when(updated.isNull(), 0.5).otherwise(F.pow(F.lit(0.5), days / half_life)),
        "consistency": F.coalesce(consistency, F.lit(0.9)), "reliability": F.coalesce(reliability, F.lit(0.5)),
    }


# Weights of the quality dimensions.
DIMENSION_WEIGHTS = {"completeness": 0.3, "accuracy": 0.3, "timeliness": 0.2, "consistency": 0.1, "reliability": 0.1}


def quality_score(dimensions: Mapping[str, Column]) -> Column:
    total = None
    for d, w in DIMENSION_WEIGHTS.items():
        total = dimensions[d] * w if total is None else total + dimensions[d] * w
    return total


def select_best_source(df: DataFrame, key: Sequence[str], source: str, score: str) -> DataFrame:
    return df.groupBy(*key).agg(
        F.min_by(source, F.struct((-F.col(score)).alias("q"), F.col(source))).alias("selected_source"),
        F.max(score).alias("score"))


def required_quality(field: Column) -> Column:
    """Least acceptable quality by field name."""
    return (F.when(field.contains("mortality"), 0.95).when(field.contains("population"), 0.90)
            .when(field.contains("prevalence"), 0.85).otherwise(0.80))


# Rules as Column conditions, (name, source fields, condition, priority).
INTEGRATION_RULES = [
    ("population_validation", ["total_population", "male_population", "female_population"],
     lambda: F.abs(F.col("total_population") - (F.col("male_population") + F.col("female_population"))) < 10, 200),
    ("mortality_rate_standardisation", ["crude_mortality_rate", "age_distribution"], None, 180),
    ("seifa_completeness", ["seifa_irsd", "seifa_irsad", "seifa_ier", "seifa_ieo"], None, 150),
]


def applicable_rules(columns: Sequence[str], rules=INTEGRATION_RULES) -> Column:
    """Names of the rules that apply to a row, highest priority first."""
    hits = []
    for name, fields, condition, _ in sorted(rules, key=lambda r: -r[3]):
        if not set(fields) <= set(columns):
            continue
        ok = F.lit(True)
        for f in fields:
            ok = ok & F.col(f).isNotNull()
        if condition is not None:
            ok = ok & condition()
        hits.append(F.when(ok, name))
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def missing_mandatory(columns: Sequence[str], mandatory: Sequence[str] = MANDATORY_FIELDS) -> Column:
    return F.array_compact(F.array(*[
        F.when(F.col(f).isNull(), f) if f in columns else F.lit(f) for f in mandatory]))


def integration_level(sources: Column, *, staged: bool = False) -> Column:
    """From the number of sources; the staged form asks for four, not five."""
    return F.when(sources >= (4 if staged else 5), "comprehensive").when(sources >= 3, "standard").otherwise("minimal")


def record_completeness(columns: Sequence[str], indicators: Sequence[str] = KEY_INDICATORS) -> tuple[Column, Column]:
    """(share of the key indicators present in %, names of the absent ones)."""
    have = [F.col(c).isNotNull().cast("int") for c in indicators if c in columns]
    missing = [F.when(F.col(c).isNull(), c) if c in columns else F.lit(c) for c in indicators]
    return row_sum(have) / len(indicators) * 100, F.array_compact(F.array(*missing))


def first_by_source(columns: Sequence[str], field: str, order: Sequence[str]) -> Column:
    """First non-null <field>_<source> in source order, then the plain field."""
    names = [f"{field}_{s}" for s in order] + [field]
    have = [F.col(n) for n in names if n in columns]
    return F.coalesce(*have) if have else F.lit(None)


def largest_base(columns: Sequence[str], candidates: Sequence[str]) -> Column:
    have = [F.col(c) for c in candidates if c in columns]
    return F.greatest(*have) if len(have) > 1 else have[0] if have else F.lit(None)


# Health fields picked by source order.
HEALTH_FIELDS = {
    "life_expectancy": ["life_expectancy", "life_expectancy_male", "life_expectancy_female"],
    "mortality": ["all_cause_mortality_rate", "cardiovascular_mortality_rate", "cancer_mortality_rate",
                  "respiratory_mortality_rate", "diabetes_mortality_rate", "suicide_mortality_rate",
                  "infant_mortality_rate", "avoidable_mortality_rate"],
}


def priority_struct(df: DataFrame, fields: Sequence[str], sources: Sequence[str], order: Sequence[str]) -> Column:
    """Struct of fields, each from the first source column (a struct) that has it;
    ordered sources first, then the rest."""
    ranked = [s for s in order if s in sources] + [s for s in sources if s not in order]
    inner = {s: {f.name for f in df.schema[s].dataType.fields} for s in ranked if s in df.columns}
    picks = []
    for f in fields:
        have = [F.col(f"{s}.{f}").cast("double") for s in ranked if f in inner.get(s, ())]
        picks.append((F.coalesce(*have) if have else F.lit(None).cast("double")).alias(f))
    return F.struct(*picks)


def fix_population(df: DataFrame, tolerance: int = 10) -> DataFrame:
    """Total := males + females where they differ by more than the tolerance; flags
    for other domains' bases over 110 % of the total and scores outside 500-1500."""
    both = F.col("males") + F.col("females")
    off = F.coalesce(F.abs(both - F.col("total_population")) > tolerance, F.lit(False))
    out = df.withColumn("population_fixed", off).withColumn("total_population", F.when(off, both).otherwise(F.col("total_population")))
    limit = F.col("total_population") * 1.1
    for base in ("education_pop_base", "labour_force_pop"):
        if base in df.columns:
            out = out.withColumn(f"{base}_exceeds", F.coalesce(F.col(base) > limit, F.lit(False)))
    for s in ("irsad_score", "irsd_score", "ier_score", "ieo_score"):
        if s in df.columns:
            out = out.withColumn(f"{s}_unusual", F.coalesce(~F.col(s).between(500, 1500), F.lit(False)))
    return out


def domain_total_flags(parts: Mapping[str, tuple[Sequence[str], str, float | None]]) -> dict[str, Column]:
    """<name>_flag: parts differ from the base by over 50, or over the given share of it."""
    out = {}
    for name, (cols, base, share) in parts.items():
        gap = F.abs(row_sum(cols) - F.col(base))
        out[f"{name}_flag"] = gap > (50 if share is None else F.col(base) * share)
    return out
