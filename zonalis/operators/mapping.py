"""Column mapping, schema enforcement, filters and paging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.operators.ordering import positions

TRANSFORMS = {
    "uppercase": F.upper, "lowercase": F.lower, "strip": F.trim,
    "to_int": lambda c: c.try_cast("long"), "to_float": lambda c: c.try_cast("double"),
}
CASTS = {"string": "string", "integer": "long", "float": "double", "boolean": "boolean"}


@dataclass(frozen=True)
class ColumnMapping:
    source: str
    target: str
    data_type: str | None = None
    transform: str | None = None
    default: object = None
    required: bool = False

    def expression(self) -> Column:
        c = F.col(self.source)
        if self.required and self.default is not None:
            c = F.coalesce(c, F.lit(self.default))
        if self.transform:
            c = TRANSFORMS[self.transform](c)
        if self.data_type:
            c = c.try_cast(CASTS[self.data_type])
        return c.alias(self.target)


def apply_mappings(df: DataFrame, mappings: Sequence[ColumnMapping]) -> DataFrame:
    """Default, transform, cast and rename in one select; unmapped columns go."""
    missing = [m.source for m in mappings if m.required and m.source not in df.columns]
    if missing:
        raise ValueError(f"required columns absent: {missing}")
    return df.select(*[m.expression() for m in mappings if m.source in df.columns])


def standard_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_").replace("-", "_") for c in df.columns])


def resolve_candidates(df: DataFrame, candidates: Mapping[str, Sequence[str]],
                       required: Sequence[str] = ()) -> DataFrame:
    """Rename the first present candidate of each target."""
    found = {t: next((c for c in cs if c in df.columns), None) for t, cs in candidates.items()}
    absent = [t for t in required if found.get(t) is None]
    if absent:
        raise ValueError(f"no candidate column for {absent}")
    return df.withColumnsRenamed({s: t for t, s in found.items() if s})


def first_usable(df: DataFrame, names: Sequence[str], blanks: Sequence[str] = ("",)) -> Column:
    """First of the present fields that is neither null nor a blank marker."""
    present = [n for n in names if n in df.columns]
    if not present:
        return F.lit(None).cast("string")
    cleaned = [F.when(~F.trim(F.col(n).cast("string")).isin(*blanks), F.col(n).cast("string")) for n in present]
    return F.coalesce(*cleaned)


def ensure_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Absent or non-numeric counts become 0."""
    have = set(df.columns)
    return df.withColumns({
        c: F.coalesce(F.col(c).try_cast("double").cast("long"), F.lit(0).cast("long")) if c in have
        else F.lit(0).cast("long") for c in columns
    })


def enforce_schema(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Columns of the schema in its order: cast when possible, defaulted when null or absent."""
    defaults = defaults or {}
    out = []
    for f in schema.fields:
        c = F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def page(df: DataFrame, key: Sequence[str], limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*key).offset(offset).limit(limit)


def page_after(df: DataFrame, key: str, last_seen, limit: int) -> DataFrame:
    """Keyset form of paging: reads no skipped rows, whatever the page number."""
    rest = df if last_seen is None else df.filter(F.col(key) > F.lit(last_seen))
    return rest.orderBy(key).limit(limit)


PAGES, ROWS = "pages", "rows"


def write_pages(df: DataFrame, path: str, order: Sequence[str], size: int) -> None:
    """df in the order of its columns `order`, which no two rows share and which are not null, with an
    index of the first and last key of every page of `size` rows."""
    placed = positions(df, order).withColumn("_page", F.floor((F.col("_rn") - 1) / size))
    rows = placed.drop("_rn", "_n")
    rows.repartitionByRange("_page").sortWithinPartitions(*order).drop("_page").write.parquet(f"{path}/{ROWS}")
    key = F.struct(*order)
    placed.groupBy("_page").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/{PAGES}")


def read_page(spark: SparkSession, path: str, order: Sequence[str], number: int) -> DataFrame:
    """Page `number` (from 0) of what write_pages wrote: one index row, then one range of keys, which
    the scan skips to; no row before it is read or sorted.  Beyond the last page there are no rows."""
    rows = spark.read.parquet(f"{path}/{ROWS}")
    found = spark.read.parquet(f"{path}/{PAGES}").filter(F.col("_page") == number).select("first", "last").first()
    if found is None:
        return rows.limit(0)
    low, high = found["first"], found["last"]
    lead = F.col(order[0]).between(F.lit(low[0]), F.lit(high[0]))  # what the files' statistics can judge
    key = F.struct(*order)
    ends = [F.struct(*[F.lit(end[c]).cast(rows.schema[c].dataType).alias(c) for c in order]) for end in (low, high)]
    return rows.filter(lead & (key >= ends[0]) & (key <= ends[1])).orderBy(*order)


def equals(df: DataFrame, **wanted) -> DataFrame:
    for name, value in wanted.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def quality_filter(df: DataFrame, score: str, minimum: float = 0.5) -> DataFrame:
    return df.filter(F.col(score) >= minimum)


def duplicate_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Each repeated row (or key) with its count."""
    keys = list(keys or df.columns)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def check_rules(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """(rule, passed) for non_empty, no_duplicates and min_records:n, in one row per rule."""
    grouped = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    facts = grouped.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
                        F.coalesce(F.max("_copies"), F.lit(0)).alias("most"))
    parts = []
    for rule in rules:
        name, _, arg = rule.partition(":")
        if name == "non_empty":
            ok = F.col("rows") > 0
        elif name == "no_duplicates":
            ok = F.col("most") <= 1
        elif name == "min_records":
            ok = F.col("rows") >= int(arg)
        else:
            raise ValueError(f"unknown rule {rule}")
        parts.append(F.struct(F.lit(rule).alias("rule"), ok.alias("passed")))
    return facts.select(F.inline(F.array(*parts)))


def apply_rules(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """fill_nulls, remove_duplicates and rename_column:old->new, in order."""
    for rule in rules:
        name, _, arg = rule.partition(":")
        if name == "fill_nulls":
            df = df.na.fill("").na.fill(0)
        elif name == "remove_duplicates":
            df = df.dropDuplicates()
        elif name == "rename_column":
            old, new = (x.strip() for x in arg.split("->"))
            df = df.withColumnRenamed(old, new)
        else:
            raise ValueError(f"unknown rule {rule}")
    return df


# Renames and quality codes of the version upgrade.
V2_RENAMES = {
    "area_id": "geographic_id", "area_code": "geographic_id", "site_id": "station_id",
    "temp_max": "max_temperature", "temp_min": "min_temperature",
}
QUALITY_CODES = {"1": "Y", "2": "G", "3": "Q", "4": "P", "9": "M"}


def upgrade_to_v2(df: DataFrame, *, fahrenheit: Sequence[str] = (), version: str = "2.0.0") -> DataFrame:
    """Version 1 rows in version 2 form: renames, centroid struct, Celsius, quality
    letters, merged infant and child deaths, percentile from rank, version stamp."""
    have = set(df.columns)
    out = df.withColumnsRenamed({a: b for a, b in V2_RENAMES.items() if a in have and b not in have})
    new: dict[str, Column] = {c: (F.col(c) - 32) * 5 / 9 for c in fahrenheit}
    if {"latitude", "longitude"} <= have:
        new["centroid"] = F.struct("latitude", "longitude")
    if "quality_code" in have:
        code = F.col("quality_code").cast("string")
        letters = F.create_map(*[F.lit(x) for kv in QUALITY_CODES.items() for x in kv])
        new["quality_flag"] = F.coalesce(F.try_element_at(letters, code), F.lit("N"))
    if {"infant_deaths", "child_deaths"} <= have:
        new["deaths_0_4"] = F.coalesce("infant_deaths", F.lit(0)) + F.coalesce("child_deaths", F.lit(0))
    if "children" in have:
        new["children_0_4"] = F.floor(F.col("children") * 0.25)
    if "adults" in have:
        new["adults_15_24"] = F.floor(F.col("adults") * 0.15)
    if {"rank", "total_areas"} <= have:
        new["percentile"] = (F.col("total_areas") - F.col("rank") + 1) / F.col("total_areas") * 100
    return out.withColumns(new).withColumn("schema_version", F.lit(version))


def read_mixed_versions(v1: DataFrame, v2: DataFrame, **kw) -> DataFrame:
    return upgrade_to_v2(v1, **kw).unionByName(v2, allowMissingColumns=True)
