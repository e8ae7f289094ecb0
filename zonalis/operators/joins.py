"""Equi-joins between area tables: chains, one-to-one merges, look-ups, concordance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions import codes
from zonalis.functions import fixed_values as V
from zonalis.operators.common import salted_join


def left_chain(base: DataFrame, key: str, *others: DataFrame) -> DataFrame:
    """Left joins on one key.  Broadcasts are left to the optimiser's size check."""
    for o in others:
        base = base.join(o, key, "left")
    return base


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df unchanged, failing at run time when a key repeats.

    The check is an aggregate on the join keys, so the join that follows needs no
    further shuffle of this side.
    """
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k"), F.any_value(F.struct(*rest)).alias("_v"))
    once = F.when(F.col("_k") == 1, F.col("_v")).otherwise(
        F.raise_error(F.concat(F.lit("repeated key: "), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))))
    return g.select(*keys, once.alias("_v")).select(*keys, "_v.*")


def domain_joins(base: DataFrame, domains: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left one-to-one joins; each domain's other columns get its name as suffix.
    Domains without all keys are skipped."""
    out = one_row_per_key(base, keys)
    for name, d in domains.items():
        if not set(keys) <= set(d.columns):
            continue
        right = one_row_per_key(d, keys)
        right = right.withColumnsRenamed({c: f"{c}_{name}" for c in d.columns if c not in keys})
        out = out.join(right, list(keys), "left")
    return out


def lookup(df: DataFrame, dimension: DataFrame, key: str, dim_key: str, sk: str, unknown: int = -99) -> DataFrame:
    """Surrogate key of the dimension row; unmatched rows get the unknown member."""
    dim = dimension.select(F.col(dim_key).alias(key), sk)
    return df.join(dim, key, "left").withColumn(sk, F.coalesce(sk, F.lit(unknown)))


def merge_sources(sources: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Union of keys over the sources; a later source's present value wins, and
    `sources` lists the contributors.  One shuffle on the key for any number of sources."""
    names = list(sources)
    stacked, columns = None, []
    for i, n in enumerate(names):
        d = sources[n].filter(F.col(key).isNotNull()).withColumn("_rank", F.lit(i))
        columns += [c for c in sources[n].columns if c != key and c not in columns]
        stacked = d if stacked is None else stacked.unionByName(d, allowMissingColumns=True)
    picks = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in columns]
    seen = [F.when(F.max(F.col("_rank") == i), n) for i, n in enumerate(names)]
    return stacked.groupBy(key).agg(*picks, F.array_compact(F.array(*seen)).alias("sources"))


def area_concordance(areas: DataFrame, code: str) -> DataFrame:
    """(code_type, code, target, factor) of an area list: itself, and equal shares
    of its SA3 and SA4 prefixes."""
    base = areas.select(F.col(code).alias("target")).distinct()
    own = base.select(F.lit("sa2").alias("code_type"), F.col("target").alias("code"), "target", F.lit(1.0).alias("factor"))
    out = own
    for level in ("SA3", "SA4"):
        part = base.withColumn("code", codes.parent_code(F.col("target"), level)).filter("code IS NOT NULL")
        share = part.groupBy("code").agg((F.lit(1.0) / F.count(F.lit(1))).alias("factor"))
        out = out.unionByName(part.join(share, "code").select(F.lit(level.lower()).alias("code_type"), "code", "target", "factor"))
    return out


def map_to_areas(df: DataFrame, code: str, code_type: str, concordance: DataFrame, *, key: Sequence[str],
                 centroids: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """One row per (record, target area) with its allocation factor.

    Code types go through their aliases.  A record without a target keeps one row
    with a null area, factor 0 and a mapping_error, or fails the job when strict.
    `concordance` has (code_type, code, target, factor); `key` spreads hot codes.
    """
    left = df.withColumn("code_type", codes.normal_code_type(F.col(code_type))).withColumn(
        "_code", F.trim(F.col(code).cast("string")))
    right = concordance.select("code_type", F.col("code").alias("_code"), F.col("target").alias("target_area"), "factor")
    out = salted_join(left, right, ["code_type", "_code"], list(key), how="left")
    digits = {"postcode": 4, "sa1": 11, "sa2": 9, "sa3": 5, "sa4": 3}
    badly = F.lit(False)
    for kind, n in digits.items():
        badly = badly | ((F.col("code_type") == kind) & ~F.col("_code").rlike(rf"^\d{{{n}}}$"))
    known_type = F.col("code_type").isin(*V.ALLOCATION)
    problem = (
        F.when(F.col("target_area").isNotNull(), None)
        .when(F.col("_code").isNull() | (F.col("_code") == ""), "missing_code")
        .when(~F.coalesce(known_type, F.lit(False)), "unsupported_code_type")
        .when(badly, "invalid_code_format").otherwise("no_mapping")
    )
    if strict:
        problem = F.when(problem.isNull(), None).otherwise(F.raise_error(F.concat(F.lit("mapping failed: "), problem)))
    methods = codes.literal_map({k: v[0] for k, v in V.ALLOCATION.items()})
    sure = codes.literal_map({k: v[1] for k, v in V.ALLOCATION.items()})
    hit = F.col("target_area").isNotNull()
    out = out.withColumns({
        "allocation_factor": F.coalesce("factor", F.lit(0.0)),
        "mapping_method": F.when(hit, F.try_element_at(methods, F.col("code_type"))),
        "mapping_confidence": F.when(hit, F.try_element_at(sure, F.col("code_type"))),
        "mapping_error": problem,
    }).drop("factor", "_code")
    return out if centroids is None else out.join(centroids.withColumnRenamed("area", "target_area"), "target_area", "left")


def allocated_totals(mapped: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Measures shared out by allocation factor and summed per target area."""
    return mapped.filter(F.col("target_area").isNotNull()).groupBy("target_area").agg(
        *[F.sum(F.col(m) * F.col("allocation_factor")).alias(m) for m in measures])


def join_boundaries(df: DataFrame, boundaries: DataFrame, left_key: str, right_key: str,
                    population: str, area: str) -> DataFrame:
    """Inner join on differently named keys, with population density."""
    d = df.join(boundaries, df[left_key] == boundaries[right_key])
    return d.withColumn("population_density", F.when(F.col(area) > 0, F.col(population) / F.col(area)))


def sibling_counts(areas: DataFrame, code: str, parent: str) -> DataFrame:
    """Number of other areas under the same parent, without pairing them."""
    n = areas.filter(F.col(parent).isNotNull()).groupBy(parent).agg((F.count(F.lit(1)) - 1).alias("sibling_count"))
    return areas.join(n, parent, "left")


def members_in_chunks(areas: DataFrame, code: str, parent: str, chunk: int = 1000, **kw) -> DataFrame:
    """(parent, chunk number, ordered member codes): each area's siblings are its
    parent's chunks less itself.  Lists stay bounded however large a parent is."""
    from zonalis.operators.ordering import positions
    p = positions(areas.select(code, parent).filter(F.col(parent).isNotNull()), [code], [parent], **kw)
    c = F.floor((F.col("_rn") - 1) / chunk).cast("int")
    return p.groupBy(parent, c.alias("chunk")).agg(F.array_sort(F.collect_list(code)).alias("members"))


def unique_and_present(df: DataFrame, key: str) -> DataFrame:
    """Counts of repeated and of null keys, the two tests every mart must pass."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("k"))
    null = F.col(key).isNull()
    return g.agg(F.count_if((F.col("k") > 1) & ~null).alias("repeated_keys"),
                 F.coalesce(F.sum(F.when(null, F.col("k"))), F.lit(0)).alias("null_keys"))


