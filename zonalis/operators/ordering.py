"""Global and per-group order statistics without unpartitioned windows.

Rows are range-sorted by (group, order key) and written once; each written
slice numbers its own rows.  A group that spans slices is stitched together
from one small row per (slice, group) edge, so no task ever holds a whole
group and a group with a third of all rows is just a run of slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.session import materialise

SLICE, POS = "_slice", "_pos"
_OFFSET_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def sort_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def sorted_slices(df: DataFrame, group: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """df in global (group, order) order with a stable slice number and row position."""
    mid = F.monotonically_increasing_id()
    ranged = (
        df.orderBy(*[F.col(g) for g in group], *sort_columns(order))
        .withColumn("_mid", mid)
        .withColumn(SLICE, F.shiftright("_mid", _OFFSET_BITS))
        .withColumn(POS, F.col("_mid").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1)))
        .drop("_mid")
    )
    return materialise(ranged, "slices")


def _group_struct(group: Sequence[str]) -> Column:
    return F.struct(*[F.col(g) for g in group]) if group else F.struct(F.lit(0).alias("_all"))


def _openers(slices: DataFrame, *columns: str) -> DataFrame:
    """What each slice opens with.  A group or a run of ties that crosses a border
    opens the slice after it, so this holds them all, one row per slice at most."""
    return slices.filter(F.col(POS) == 0).select(*columns).distinct()


def edge_totals(slices: DataFrame, group: Sequence[str], **aggs: Column) -> DataFrame:
    """One row per (slice, group) for the groups that cross a slice border."""
    g = slices.withColumn("_g", _group_struct(group))
    spanning = _openers(g, "_g")
    return (
        g.join(F.broadcast(spanning), g["_g"].eqNullSafe(spanning["_g"]), "left_semi")
        .groupBy(SLICE, "_g").agg(*[c.alias(n) for n, c in aggs.items()])
    )


def with_edges(slices: DataFrame, edges: DataFrame, group: Sequence[str]) -> DataFrame:
    e = edges.withColumnsRenamed({SLICE: "_eslice", "_g": "_eg"})
    s = slices.withColumn("_g", _group_struct(group))
    joined = s.join(
        F.broadcast(e), (s[SLICE] == e["_eslice"]) & s["_g"].eqNullSafe(e["_eg"]), "left"
    )
    return joined.drop("_eslice", "_eg")


def positions(
    df: DataFrame,
    order: Sequence[str | Column],
    group: Sequence[str] = (),
    *,
    weight: str | None = None,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Adds _rn (1-based position in group), _n (group size) and, when asked,
    _rank (minimum position among rows equal on `ties`), _cum and _total
    (running and whole sum of `weight`).  `ties` names the columns that lead `order`."""
    order = list(order)
    slices = sorted_slices(df, group, order)
    zero = F.lit(0)
    edges = edge_totals(
        slices, group,
        cnt=F.count(F.lit(1)), low=F.min(POS),
        wsum=F.coalesce(F.sum(weight).cast("double"), F.lit(0.0)) if weight else F.max(F.lit(0.0)),
    )
    across = Window.partitionBy("_g")
    earlier = across.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(
        SLICE, "_g", "low",
        F.coalesce(F.sum("cnt").over(earlier), zero).alias("_before"),
        F.sum("cnt").over(across).alias("_gn"),
        F.coalesce(F.sum("wsum").over(earlier), F.lit(0.0)).alias("_wbefore"),
        F.sum("wsum").over(across).alias("_gw"),
    )
    s = with_edges(slices, edges.drop("low"), group)
    inside = Window.partitionBy(SLICE, *group)
    # The order key leads, so that ranking on its first columns needs no other sort.
    run = inside.orderBy(*sort_columns(order), POS)
    before = F.coalesce(F.col("_before"), zero)
    out = s.withColumn("_rn", before + F.row_number().over(run))
    if ties is not None:
        out = out.withColumn("_local", before + F.rank().over(inside.orderBy(*sort_columns(order[: len(ties)]))))
    out = out.withColumn("_n", F.coalesce("_gn", F.count(F.lit(1)).over(inside)))
    if weight:
        rows = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn("_cum", F.coalesce("_wbefore", F.lit(0.0)) + F.sum(weight).over(rows))
        out = out.withColumn("_total", F.coalesce("_gw", F.sum(weight).over(inside).cast("double")))
    drop = [SLICE, POS, "_g", "_before", "_gn", "_wbefore", "_gw"]
    if ties is None:
        return out.drop(*drop)
    # Least position of equal values: found within the slice, but for the values
    # slices open with, from the first slice that holds them.
    tied = slices.select(SLICE, POS, F.struct(_group_struct(group).alias("g"), F.struct(*ties).alias("t")).alias("_k"))
    keys = _openers(tied, "_k")
    first = (
        tied.join(F.broadcast(keys), tied["_k"].eqNullSafe(keys["_k"]), "left_semi")
        .groupBy("_k").agg(F.min(F.struct(SLICE, POS)).alias("f"))
    )
    starts = first.join(
        F.broadcast(edges), (F.col(f"f.{SLICE}") == edges[SLICE]) & F.col("_k.g").eqNullSafe(edges["_g"])
    ).select(F.col("_k").alias("_sk"), (F.col("_before") + F.col(f"f.{POS}") - F.col("low") + 1).alias("_start"))
    out = out.withColumn("_k", F.struct(F.col("_g").alias("g"), F.struct(*ties).alias("t")))
    out = out.join(F.broadcast(starts), out["_k"].eqNullSafe(starts["_sk"]), "left")
    return out.withColumn("_rank", F.coalesce("_start", "_local")).drop(*drop, "_k", "_sk", "_start", "_local")


def value_runs(df: DataFrame, value: str, group: Sequence[str] = (), *, weight: str | None = None, **kw) -> DataFrame:
    """Distinct values per group with their weight _c, running weight _cum and group
    total _total.  Equal values are counted before they are sorted, so a value held
    by a third of the rows is one row here."""
    rows = df.filter(F.col(value).isNotNull())
    c = F.sum(weight).cast("double") if weight else F.count(F.lit(1)).cast("double")
    counts = rows.groupBy(*group, value).agg(c.alias("_c"))
    return positions(counts, [value], group, weight="_c", **kw).drop("_rn", "_n")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    group: Sequence[str] = (),
    *,
    exclusive: bool = False,
    count: str | None = None,
) -> DataFrame:
    """Exact quantiles per group, linear between neighbours (position p(n-1)), or
    the exclusive form at p(n+1); _n counts the values, or adds up `count` where rows stand for
    many.  Positions are read off sorted value runs, never off a per-group buffer."""
    base = df.select(*group, value, *([count] if count else [])).filter(F.col(value).isNotNull())
    runs = value_runs(base, value, group, weight=count)
    n, out = F.col("_total"), []
    for name, p in probs.items():
        at = F.lit(p) * (n + 1) if exclusive else F.lit(p) * (n - 1) + 1
        at = F.greatest(F.lit(1.0), F.least(n, at))
        low, high = F.floor(at), F.ceil(at)
        v_low = F.min(F.when(F.col("_cum") >= low, F.col(value)))
        v_high = F.min(F.when(F.col("_cum") >= high, F.col(value)))
        out.append((v_low + (v_high - v_low) * F.max(at - low)).alias(name))
    return runs.groupBy(*group).agg(*out, F.max("_total").cast("long").alias("_n"))


def carried_value(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    group: Sequence[str] = (),
    *,
    backward: bool = False,
    out: str | None = None,
) -> DataFrame:
    """Last non-null value at or before each row (next, when backward)."""
    out = out or value
    slices = sorted_slices(df, group, order)
    known = F.when(F.col(value).isNotNull(), F.col(POS))
    pick = F.min_by(value, known) if backward else F.max_by(value, known)
    edges = edge_totals(slices, group, v=pick)
    # Backward is forward over the reversed order: Spark starts a frame that is open
    # at its end anew for every row, so its time would grow with a slice's square.
    slice_order, row_order = (F.desc(SLICE), F.desc(POS)) if backward else (F.asc(SLICE), F.asc(POS))
    run = Window.partitionBy("_g").orderBy(slice_order).rowsBetween(Window.unboundedPreceding, -1)
    s = with_edges(slices, edges.select(SLICE, "_g", F.last("v", True).over(run).alias("_carry")), group)
    w = Window.partitionBy(SLICE, *group).orderBy(row_order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.last(value, True).over(w)
    return s.withColumn(out, F.coalesce(here, F.col("_carry"))).drop(SLICE, POS, "_g", "_carry")


def neighbours(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    group: Sequence[str] = (),
) -> DataFrame:
    """Adds _rn (position in group) and the nearest known values at or before and at
    or after each row, as structs _prev and _next of position p and value v."""
    def known(position: Column) -> Column:
        return F.when(F.col(value).isNotNull(), F.struct(position.alias("p"), F.col(value).cast("double").alias("v")))

    slices = sorted_slices(df, group, order)
    at = F.when(F.col(value).isNotNull(), F.col(POS))
    edges = edge_totals(
        slices, group, cnt=F.count(F.lit(1)), low=F.min(POS),
        firstk=F.min_by(known(F.col(POS)), at), lastk=F.max_by(known(F.col(POS)), at))
    # What follows is read in reversed order, as in carried_value.
    run = Window.partitionBy("_g")
    earlier = run.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    later = run.orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_before", F.coalesce(F.sum("cnt").over(earlier), F.lit(0)))

    def in_group(c: str) -> Column:
        moved = F.struct((F.col("_before") + F.col(f"{c}.p") - F.col("low") + 1).alias("p"), F.col(f"{c}.v").alias("v"))
        return F.when(F.col(c).isNotNull(), moved)

    edges = edges.withColumns({"firstk": in_group("firstk"), "lastk": in_group("lastk")}).select(
        SLICE, "_g", "_before", F.last("lastk", True).over(earlier).alias("_pc"), F.last("firstk", True).over(later).alias("_nc"))
    here = Window.partitionBy(SLICE, *group)
    w = here.orderBy(POS)
    s = with_edges(slices, edges, group)
    s = s.withColumn("_rn", F.coalesce("_before", F.lit(0)) + F.row_number().over(w)).withColumn("_known", known(F.col("_rn")))
    prev = F.last("_known", True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.last("_known", True).over(here.orderBy(F.desc(POS)).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return s.withColumns({"_prev": F.coalesce(prev, "_pc"), "_next": F.coalesce(following, "_nc")}).drop(
        SLICE, POS, "_g", "_before", "_pc", "_nc", "_known")
