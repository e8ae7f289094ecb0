"""Hard negatives by bounds along a spanning tree of the anchors.

Anchors are taken in blocks of bounded size.  The anchors of a block are joined to a minimum
spanning tree by distance.  A task that scans rows scores them whole at the root; at every
other anchor a row's score lies within |anchor - parent| * |row| of its score at the parent
(its known range there, if it was not scored there).  Only rows whose range overlaps what is
still wanted at the anchor are scored:

    positives   rows of the same label that may pass the k-th best so far
    negatives   rows of other labels that may lie in the window below a positive's score
                and pass the k-th best so far in it

The block's own anchors are rows of the table too, so their scores tell from the start what
a row must reach.  A block is broadcast to the scan of all rows; what is shuffled is each
task's best rows for every anchor or window, and those are merged by rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.llm.vectors import finite, matrix
from zonalis.session import materialise, scratch_path

BLOCK_ANCHORS, CHUNK_ROWS = 2_048, 2_048
_EXACT = 2**53


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """(anchor, parent, distance) in an order that has parents first; the root's parent is -1.
    Every step takes the anchor nearest to the tree."""
    n = len(vectors)
    near, parent, steps = np.full(n, np.inf), np.full(n, -1), []
    out = np.zeros(n, bool)
    at = 0
    for _ in range(n):
        out[at] = True
        steps.append((at, int(parent[at]), float(np.sqrt(near[at])) if parent[at] >= 0 else 0.0))
        far = ((vectors - vectors[at]) ** 2).sum(1)
        closer = ~out & (far < near)
        near[closer], parent[closer] = far[closer], at
        at = int(np.argmin(np.where(out, np.inf, near)))
    return steps


@dataclass
class Block:
    """Anchors with their tree, and what is wanted of the rows at each."""

    number: np.ndarray  # of each anchor, unlike in all blocks
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray  # whole numbers in double precision
    steps: list[tuple[int, int, float]]
    floors: dict[int, list[float]] = field(default_factory=dict)  # by anchor: what the k-th best has at least, by window
    windows: dict[int, list[int]] = field(default_factory=dict)  # by anchor: scores of its positives, each once

    def children(self) -> np.ndarray:
        of = np.array([p for _, p, _ in self.steps if p >= 0], int)
        return np.bincount(of, minlength=len(self.ids))


def _products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: in double precision where that is exact, else in Python's."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(vector).max(initial=0)) * len(vector)
    if most < _EXACT:
        return rows @ vector
    as_int = np.frompyfunc(int, 1, 1)
    return as_int(rows) @ as_int(vector)


def walk(block: Block, rows: np.ndarray, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows scored there, their scores) in tree order.  `wanted` gets an anchor and
    the least and largest score of every row, and returns the rows to score."""
    norms = np.sqrt((rows**2).sum(1)) * (1 + 1e-9)
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    waiting = block.children()
    for a, parent, distance in block.steps:
        length = float(np.sqrt((block.vectors[a] ** 2).sum()))
        if parent < 0:
            middle, slack = rows @ block.vectors[a], norms * length * 1e-9
            need = np.arange(len(rows))
        else:
            middle, slack = held[parent]
            middle, slack = middle.copy(), slack + norms * (distance * (1 + 1e-9) + 1e-9 * length)
            need = wanted(a, middle - slack, middle + slack)
            waiting[parent] -= 1
            if not waiting[parent]:
                del held[parent]
        scores = _products(rows[need], block.vectors[a])
        if parent >= 0:
            middle[need], slack[need] = scores.astype(float), norms[need] * length * 1e-9
        if waiting[a]:
            held[a] = middle, slack
        yield a, need, scores


def _first(found: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    """The k first of (score, id), by score from the largest and then id."""
    return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def in_window(score: np.ndarray, positive: int, least: Fraction) -> np.ndarray:
    """least * positive <= score <= positive, in whole numbers."""
    return (score * least.denominator >= positive * least.numerator) & (score <= positive)


class Positives:
    """The k first rows of the anchor's label for every anchor, other than the anchor's id."""

    def __init__(self, block: Block, k: int):
        self.block, self.k = block, k
        self.best: dict[int, list[tuple[int, int]]] = {}
        self.floor = [(block.floors.get(a) or [-np.inf])[0] for a in range(len(block.ids))]

    def add(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        b = self.block
        mine = lambda a: (labels == b.labels[a]) & (ids != b.ids[a])
        for a, need, scores in walk(b, rows, lambda a, low, high: np.flatnonzero(mine(a) & (high >= self.floor[a]))):
            take = np.flatnonzero(mine(a)[need] & (scores >= self.floor[a]))
            if len(take):
                new = zip(scores[take].tolist(), ids[need[take]].tolist(), strict=True)
                best = self.best[a] = _first([*self.best.get(a, []), *new], self.k)
                if len(best) == self.k:
                    self.floor[a] = max(self.floor[a], best[-1][0])

    def found(self) -> Iterator[tuple[int, int, int, int]]:
        for a, best in self.best.items():
            for score, i in best:
                yield int(self.block.number[a]), 0, i, int(score)


class Negatives:
    """The k first rows of other labels in the window of every positive's score."""

    def __init__(self, block: Block, k: int, least: Fraction):
        self.block, self.k, self.least = block, k, least
        self.best: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.floor = {(a, p): f for a, ps in block.windows.items() for p, f in zip(ps, block.floors[a], strict=True)}

    def _wanted(self, a: int, low: np.ndarray, high: np.ndarray, other: np.ndarray) -> np.ndarray:
        hit = np.zeros(len(other), bool)
        for p in self.block.windows.get(a, []):
            hit |= (high >= max(float(self.least) * p * (1 - 1e-12) - 1e-9, self.floor[a, p])) & (low <= p)
        return np.flatnonzero(hit & other)

    def add(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        b = self.block
        other = lambda a: labels != b.labels[a]
        for a, need, scores in walk(b, rows, lambda a, low, high: self._wanted(a, low, high, other(a))):
            unlike = other(a)[need]
            for p in b.windows.get(a, []):
                take = np.flatnonzero(unlike & in_window(scores, p, self.least).astype(bool) & (scores >= self.floor[a, p]))
                if len(take):
                    new = zip(scores[take].tolist(), ids[need[take]].tolist(), strict=True)
                    best = self.best[a, p] = _first([*self.best.get((a, p), []), *new], self.k)
                    if len(best) == self.k:
                        self.floor[a, p] = max(self.floor[a, p], best[-1][0])

    def found(self) -> Iterator[tuple[int, int, int, int]]:
        for (a, p), best in self.best.items():
            for score, i in best:
                yield int(self.block.number[a]), p, i, int(score)


def _own_floors(block: Block, k: int, least: Fraction | None) -> dict[int, list[float]]:
    """What the block's own anchors, being rows too, promise for the k-th best: for positives,
    or with `least` for the negatives of every window."""
    out = {}
    for a in range(len(block.ids)):
        scores = _products(block.vectors, block.vectors[a])
        if least is None:
            pools = [scores[(block.labels == block.labels[a]) & (block.ids != block.ids[a])]]
        else:
            other = block.labels != block.labels[a]
            pools = [scores[other & in_window(scores, p, least).astype(bool)] for p in block.windows.get(a, [])]
        out[a] = [np.sort(pool)[-k] if len(pool) >= k else -np.inf for pool in pools]
    return out


_FOUND = "anchor long, window long, id long, score long"


def _scan(rows: DataFrame, make: Callable[[], Positives | Negatives], scale: float) -> DataFrame:
    """What every task finds in its rows (id, label, v)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = make()
        for batch in batches:
            for at in range(0, len(batch), CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                whole = np.floor(scale * matrix(part.column(2), "float64"))
                state.add(part.column(0).to_numpy(), part.column(1).to_numpy(), whole)
        found = list(state.found())
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(4)], names=["anchor", "window", "id", "score"])

    return rows.mapInArrow(task, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, *, row_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256.0,
                   positives: int = 5, negatives: int = 5, least: Fraction = Fraction(80, 100), block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every
    row that `anchor` marks and each of its first `positives` rows of the same label, the first
    `negatives` rows of other labels that score from `least` of the positive's score to all of it.

    Components count as floor(scale * x); scores are whole inner products, larger first, ties by
    smaller id.  Rows with a null id, label or vector, an empty vector, or a component that is null or not
    finite take no part, and vectors of another length than the anchor's are left out.  Rows that repeat an id
    are candidates each, but never for an anchor of that id; rows alike in id, label and
    vector are one anchor.  A positive whose score is negative has no window.  A score beyond a
    long is an error.  Without anchors or rows the result is empty.
    """
    spark = rows.sparkSession
    wide = F.transform(vector, lambda x: F.lit(float(scale)) * x.cast("double"))
    kept = rows.select(F.col(row_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"),
                       F.coalesce(anchor, F.lit(False)).alias("_anchor"), wide.alias("_wide"))
    kept = kept.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & finite("_wide")).drop("_wide")
    chosen = kept.filter("_anchor").select("id", "label", "v", F.size("v").alias("dims")).distinct().withColumn("number", F.monotonically_increasing_id())
    chosen = materialise(chosen, "anchors")
    out = scratch_path(spark, "negatives")
    made = 0
    for dims, count in chosen.groupBy("dims").count().orderBy("dims").toLocalIterator():
        blocks = -(-count // block_anchors)
        those = kept.filter(F.size("v") == dims).select("id", "label", "v")
        for n in range(blocks):
            part = chosen.filter((F.col("dims") == dims) & (F.pmod(F.xxhash64("number"), F.lit(blocks)) == n)).select("number", "id", "label", "v").orderBy("number").toArrow()
            if not len(part):
                continue
            vectors = np.floor(scale * matrix(part.column("v"), "float64"))
            block = Block(*(part.column(c).to_numpy() for c in ("number", "id", "label")), vectors, spanning_tree(vectors))
            block.floors = _own_floors(block, positives, None)
            first = _best(_scan(those, lambda b=block: Positives(b, positives), scale), positives)
            first = materialise(first.select("anchor", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
            place = {int(x): a for a, x in enumerate(block.number)}
            for x, p in first.filter("positive_score >= 0").select("anchor", "positive_score").distinct().collect():
                block.windows.setdefault(place[x], []).append(p)
            block.floors = _own_floors(block, negatives, least)
            second = _best(_scan(those, lambda b=block: Negatives(b, negatives, least), scale), negatives).select(
                "anchor", F.col("window").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            named = chosen.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id"))
            both = first.drop("rank").join(second, ["anchor", "positive_score"]).join(named, "anchor")
            both.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score").write.parquet(f"{out}/block={made}")
            made += 1
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.read.schema(schema).parquet(*[f"{out}/block={i}" for i in range(made)]) if made else spark.createDataFrame([], schema)
