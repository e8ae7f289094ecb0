"""Mixing sources to target weights by Pfair scheduling of blocks.

Documents of a source are numbered and cut into blocks.  Among the sources that are left,
block j (from 0) of a source with share w is released at slot floor(j / w) and due by slot
ceil((j + 1) / w); in every slot the released block with the earliest deadline runs.  Such a
schedule keeps every source less than one block away from its share at every slot.  When a
source runs out, the shares of the others are raised alike and a new phase begins.

With whole-number weights a phase repeats after as many slots as the weights add up to, so
one period is scheduled and every block's slot follows by arithmetic: what is computed on
the driver is bounded by the weights and the number of sources, not by the documents.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.operators.ordering import SLICE, sorted_slices

BLOCK = 64
MOST_SOURCES, MOST_WEIGHT = 10_000, 1_000


def period(weights: Mapping[str, int]) -> dict[str, list[tuple[int, int, int]]]:
    """For one period, each source's blocks as (slot, release, deadline)."""
    total = sum(weights.values())
    out: dict[str, list[tuple[int, int, int]]] = {s: [] for s in weights}
    waiting = [(0, -(-total // w), s, 0) for s, w in weights.items()]  # release, deadline, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            release, deadline, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, s, j, release))
        deadline, s, j, release = heapq.heappop(ready)
        out[s].append((slot, release, deadline))
        w, j = weights[s], j + 1
        if j < w:
            heapq.heappush(waiting, (j * total // w, -(-(j + 1) * total // w), s, j))
    return out


@dataclass(frozen=True)
class Phase:
    """Slots from `start` on: for each source still there the block it begins with, its
    weight, and its slots within a period."""

    start: int
    first: dict[str, int]
    weights: dict[str, int]
    slots: dict[str, list[tuple[int, int, int]]]


def phases(blocks: Mapping[str, int], weights: Mapping[str, int]) -> list[Phase]:
    """The phases until every block has a slot; a phase ends with the slot in which a source
    runs out of blocks."""
    left = {s: n for s, n in blocks.items() if n}
    done = dict.fromkeys(left, 0)
    out, start = [], 0
    while left:
        w = {s: weights[s] for s in left}
        total, slots = sum(w.values()), period(w)
        ends = {s: (n - 1) // w[s] * total + slots[s][(n - 1) % w[s]][0] for s, n in left.items()}
        end = min(ends.values())
        out.append(Phase(start, {s: done[s] for s in left}, w, slots))
        for s in list(left):
            whole, rest = divmod(end, total)
            ran = whole * w[s] + sum(x[0] <= rest for x in slots[s])
            done[s] += ran
            left[s] -= ran
            if not left[s]:
                del left[s]
        start += end + 1
    return out


def target_weights(shares: Mapping[str, float], scale: int = MOST_WEIGHT) -> dict[str, int]:
    """Whole-number weights that add up to about `scale`, none below 1."""
    total = sum(shares.values())
    return {s: max(1, round(scale * x / total)) for s, x in shares.items()}


def _numbered(docs: DataFrame, source: str, order: list[Column]) -> DataFrame:
    """docs with `_n`, the place of a row in its source from 0, and `_all`, the source's rows.
    Rows are range-sorted and numbered slice by slice, so a source may span many tasks."""
    named = docs.withColumn("_s", F.coalesce(F.col(source).cast("string"), F.lit("")))
    slices = sorted_slices(named.withColumns({f"_o{i}": c for i, c in enumerate(order)}), ["_s"], [f"_o{i}" for i in range(len(order))])
    counts = slices.groupBy(SLICE, "_s").agg(F.count(F.lit(1)).alias("_c"), F.min("_pos").alias("_low"))
    by = Window.partitionBy("_s")
    edges = counts.select(
        SLICE, "_s", "_low", F.coalesce(F.sum("_c").over(by.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_c").over(by).alias("_all"))
    out = slices.join(edges, [SLICE, "_s"]).withColumn("_n", F.col("_before") + F.col("_pos") - F.col("_low"))
    return out.drop(SLICE, "_pos", "_before", "_low", *[f"_o{i}" for i in range(len(order))])


def schedule(docs: DataFrame, *, source: str = "source", order: list[str] | None = None, shares: Mapping[str, float] | None = None,
             block: int = BLOCK) -> DataFrame:
    """Every row of docs with the slot it is scheduled in.

    Adds block (of its source, from 0), slot (over all sources, from 0), phase, release and
    deadline (slots, within all), and place (within the block).  Slots are the training
    order; slot and place together are unique, and slots have no gaps.  Every row is kept.

    shares are the target weights; sources that it does not name, and those without a
    source (null counts as the empty name), get the mean share.  None gives all the same.
    `order` lists columns that order a source's rows, by default a digest of doc_id and then
    doc_id; rows alike in all of it may take each other's places.  At most MOST_SOURCES sources.
    """
    added = ["block", "slot", "phase", "release", "deadline", "place"]
    rest = [c for c in docs.columns if c not in added]
    keys = [F.col(c) for c in order] if order else [F.xxhash64("doc_id"), F.col("doc_id")]
    rows = _numbered(docs.select(*rest), source, keys)
    counts = rows.groupBy("_s").agg(F.max("_all").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(counts) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    blocks = {r["_s"]: -(-r["n"] // block) for r in counts}
    named = {s: x for s, x in (shares or {}).items() if s in blocks and x > 0}
    mean = sum(named.values()) / len(named) if named else 1.0
    weights = target_weights({s: named.get(s, mean) for s in blocks}) if blocks else {}
    spark = docs.sparkSession
    plan = [
        (s, number, p.first[s], p.weights[s], sum(p.weights.values()), p.start, [list(x) for x in p.slots[s]])
        for number, p in enumerate(phases(blocks, weights)) for s in p.first]
    # One row per phase and source that is left in it; each slots array is one period.
    table = spark.createDataFrame(plan, "_s string, phase int, _first long, _w long, _total long, _start long, _slots array<array<long>>")
    lists = table.groupBy("_s").agg(F.array_sort(F.collect_list(F.struct("phase", "_first", "_w", "_total", "_start", "_slots"))).alias("_p"))
    b = F.floor(F.col("_n") / block)
    rows = rows.withColumn("block", b).join(F.broadcast(lists), "_s")
    rows = rows.withColumn("_p", F.element_at(F.filter("_p", lambda p: p["_first"] <= F.col("block")), -1))
    j = F.col("block") - F.col("_p._first")
    turn = F.floor(j / F.col("_p._w")) * F.col("_p._total") + F.col("_p._start")
    at = F.get(F.col("_p._slots"), (j % F.col("_p._w")).cast("int"))
    return rows.select(
        *rest, "block", (turn + F.get(at, F.lit(0))).alias("slot"), F.col("_p.phase").alias("phase"),
        (turn + F.get(at, F.lit(1))).alias("release"), (turn + F.get(at, F.lit(2))).alias("deadline"), (F.col("_n") % block).alias("place"))


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """docs in training order: range-partitioned and sorted by the slot of each row's block.

    Only (doc_id, source) and a digest are numbered; rows that are alike in doc_id and text
    share the first of their places.  Every row is kept, and no column is added.
    """
    keyed = docs.withColumn("_text", F.xxhash64("text"))
    narrow = schedule(keyed.select("doc_id", "source", "_text"), **parameters)
    at = narrow.groupBy(F.col("doc_id").alias("_id"), F.col("_text").alias("_t")).agg(F.min(F.struct("slot", "place")).alias("_at"))
    out = keyed.join(at, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_text").eqNullSafe(F.col("_t")), "left")
    return out.repartitionByRange("_at").sortWithinPartitions("_at").select(*docs.columns)
