"""Nested records to flat ones: structs, arrays, maps and periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.functions import geo


def flat_columns(schema: T.StructType, fields: Sequence[str], *, sep: str = "_", max_depth: int = 5,
                 prefixed: bool = True) -> list[Column]:
    """Leaves of the named struct fields as <prefix><sep><name> columns."""
    out: list[Column] = []

    def walk(path: str, kind: T.DataType, name: str, depth: int) -> None:
        if isinstance(kind, T.StructType) and depth < max_depth:
            for f in kind.fields:
                walk(f"{path}.`{f.name}`", f.dataType, f"{name}{sep}{f.name}" if name else f.name, depth + 1)
        else:
            out.append(F.col(path).alias(name))

    for f in fields:
        walk(f"`{f}`", schema[f].dataType, f if prefixed else "", 0)
    return out


def map_columns(column: str, keys: Sequence[str], *, sep: str = "_") -> list[Column]:
    """Known keys of a map as columns."""
    return [F.try_element_at(F.col(column), F.lit(k)).alias(f"{column}{sep}{k}") for k in keys]


def array_columns(column: str, how: str = "concatenate", *, size: int = 0, sep: str = "_") -> list[Column]:
    """An array as one column per place, one text, JSON, or itself."""
    c = F.col(column)
    if how == "expand":
        return [F.get(c, F.lit(i)).alias(f"{column}{sep}{i}") for i in range(size)]
    if how == "concatenate":
        return [F.array_join(F.transform(c, lambda x: x.cast("string")), ", ").alias(column)]
    return [(F.to_json(c) if how == "json" else c).alias(column)]


def widest_array(df: DataFrame, column: str) -> int:
    """Number of columns an expanded array needs, by one max."""
    return df.agg(F.coalesce(F.max(F.size(column)), F.lit(0)).alias("n")).first()["n"]


# Fields copied first, and metadata fields, of a flat record.
CORE_FIELDS = ["sa2_code", "sa2_name", "sa3_code", "sa4_code", "state_code", "total_population",
               "population_density_per_sq_km", "median_age"]
METADATA_FIELDS = ["integration_level", "data_completeness_score", "integration_timestamp",
                   "composite_health_index", "health_inequality_index", "schema_version"]


def flat_record(df: DataFrame, *, structs: Sequence[str] = (), maps: Mapping[str, Sequence[str]] | None = None,
                arrays: Sequence[str] = (), array_how: str = "concatenate", nulls: str = "preserve",
                rename: Mapping[str, str] | None = None, exclude: Sequence[str] = (), sep: str = "_") -> DataFrame:
    """Core fields, flattened structs, known map keys, arrays and metadata in one
    select; then null policy, renames and exclusions."""
    cols = [F.col(c) for c in CORE_FIELDS if c in df.columns]
    cols += flat_columns(df.schema, [s for s in structs if s in df.columns], sep=sep)
    for m, keys in (maps or {}).items():
        cols += map_columns(m, keys, sep=sep)
    for a in arrays:
        cols += array_columns(a, array_how, size=widest_array(df, a) if array_how == "expand" else 0, sep=sep)
    cols += [F.col(c) for c in METADATA_FIELDS if c in df.columns]
    out = df.select(*cols)
    if nulls == "fill_zero":
        out = out.na.fill(0)
    out = out.withColumnsRenamed(dict(rename or {}))
    return out.drop(*exclude)


def without_null_fields(df: DataFrame) -> DataFrame:
    """Rows as JSON text holding only the fields that have a value."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "true"}).alias("record"))


def periods_to_columns(df: DataFrame, key: str, periods: Sequence[str]) -> DataFrame:
    """data_<period> structs as <field>_<period> columns."""
    cols = [F.col(key)]
    for p in periods:
        cols += [F.col(f"data_{p}.{f.name}").alias(f"{f.name}_{p}") for f in df.schema[f"data_{p}"].dataType.fields]
    return df.select(*cols)


def periods_pivoted(df: DataFrame, key: str, period: str, values: Sequence, fields: Sequence[str]) -> DataFrame:
    """Long (key, period, fields...) rows in the same wide form, by one grouped pass."""
    picks = [F.max(F.when(F.col(period) == v, F.col(f))).alias(f"{f}_{v}") for v in values for f in fields]
    return df.groupBy(key).agg(*picks)


# Sources and flags a record may name.
EXPECTED_SOURCES = ["census", "seifa", "health_indicators", "geographic_boundaries", "medicare_pbs"]
QUALITY_FLAGS = ["high_confidence", "complete_seifa", "validated_geography"]


def lineage_columns(sources: str = "source_datasets", missing: str = "missing_indicators", flags: str = "quality_flags") -> dict[str, Column]:
    """Source and missing counts, has_<source>_data and quality_flag_<flag>."""
    def has(c, x):
        return F.coalesce(F.array_contains(c, x), F.lit(False))
    out = {"source_count": F.coalesce(F.size(sources), F.lit(0)), "missing_indicator_count": F.coalesce(F.size(missing), F.lit(0))}
    out |= {f"has_{s}_data": has(sources, s) for s in EXPECTED_SOURCES}
    return out | {f"quality_flag_{f}": has(flags, f) for f in QUALITY_FLAGS}


# Source age keys of each standard band.
AGE_BUCKETS = [
    ("age_0_4", "0[_-]4|under_5"), ("age_5_14", "5[_-]14|5[_-]9|10[_-]14"), ("age_15_24", "15[_-]24|15[_-]19|20[_-]24"),
    ("age_25_44", "25[_-]44|25[_-]34|35[_-]44"), ("age_45_64", "45[_-]64|45[_-]54|55[_-]64"), ("age_65_plus", "65.*|over_65"),
]


def rebucketed_ages(c: Column) -> Column:
    """A map of age keys to counts, summed onto six bands; keys match whole numbers."""
    entries = F.map_entries(c)

    def total(pattern):
        rx = rf"(^|[^0-9])({pattern})($|[^0-9])"
        hits = F.filter(entries, lambda e: F.lower(e["key"]).rlike(rx))
        return F.aggregate(hits, F.lit(0.0), lambda a, e: a + F.coalesce(e["value"].cast("double"), F.lit(0.0)))

    return F.map_from_arrays(F.array(*[F.lit(b) for b, _ in AGE_BUCKETS]), F.array(*[total(p) for _, p in AGE_BUCKETS]))


def rates_per_100000(c: Column) -> Column:
    """Values under keys naming per_1000 times 100, under the renamed key."""
    def is_old(k):
        return k.contains("per_1000") & ~k.contains("per_100000")
    scaled = F.transform_values(c, lambda k, v: F.when(is_old(k), v * 100).otherwise(v))
    return F.transform_keys(scaled, lambda k, v: F.when(is_old(k), F.replace(k, F.lit("per_1000"), F.lit("per_100000"))).otherwise(k))


def prevalence_percent(c: Column) -> Column:
    """Proportions up to 1 as percentages, at most 100."""
    return F.transform_values(c, lambda k, v: F.when(v <= 1.0, v * 100).otherwise(F.least(F.lit(100.0), v)))


def keys_naming(c: Column, *parts: str) -> Column:
    return F.map_filter(c, lambda k, v: k.rlike("|".join(parts)) & v.isNotNull())


def geometry_text(c: Column, how: str = "wkt") -> Column:
    """Polygon struct as well-known text, GeoJSON or its coordinates."""
    if how == "geojson":
        return F.to_json(c)
    if how == "coordinates":
        return F.to_json(c["coordinates"])
    other = F.concat(F.upper(c["type"]), F.lit("("), F.to_json(c["coordinates"]), F.lit(")"))
    return F.when(F.upper(c["type"]) == "POLYGON", geo.polygon_wkt(c["coordinates"][0])).otherwise(other)
