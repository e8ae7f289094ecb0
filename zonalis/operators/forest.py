"""Multivariate outliers by an ensemble of random split trees.

A tree splits a small random part of a bounded sample at random columns and places until rows stand
alone.  Outliers stand alone early, so a short mean path over many trees marks them,
whatever the shape of the bulk is.  Trees are a few flat arrays, broadcast to the scoring of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.operators.common import attach_row
from zonalis.operators.ordering import exact_quantiles
from zonalis.session import materialise

TREES, PER_TREE, POOL = 100, 256, 8_192


def mean_path(n: np.ndarray | int) -> np.ndarray:
    """Mean length of an unsuccessful search among n random keys: what a leaf of n rows adds."""
    n = np.asarray(n, float)
    more = np.maximum(n - 1, 1.0)
    return np.where(n > 2, 2 * (np.log(more) + np.euler_gamma) - 2 * more / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Complete binary trees: node i has the children 2i + 1 and 2i + 2.  A leaf has column -1 and
    the path length that rows ending there count."""

    column: np.ndarray  # trees x nodes
    place: np.ndarray
    path: np.ndarray
    depth: int
    scale: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """2^(-mean path / expected path): towards 1 for outliers, about 0.5 and below for the bulk."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for column, place, path in zip(self.column, self.place, self.path, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                c = column[at]
                right = rows[every, np.maximum(c, 0)] >= place[at]
                at = np.where(c < 0, at, 2 * at + 1 + right)
            total += path[at]
        return 2.0 ** (-total / len(self.column) / self.scale)


def grow(sample: np.ndarray, *, trees: int = TREES, per_tree: int = PER_TREE, seed: int = 42) -> Forest:
    """Trees over random parts of `sample`, a matrix without nulls."""
    rng = np.random.default_rng(seed)
    size = min(per_tree, len(sample))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    nodes = 2 ** (depth + 1) - 1
    column, place, path = np.full((trees, nodes), -1, np.int32), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        waiting = [(0, 0, sample[rng.choice(len(sample), size, replace=False)])]
        while waiting:
            node, level, rows = waiting.pop()
            low, high = rows.min(0), rows.max(0)
            open_ = np.flatnonzero(high > low)
            if level == depth or not len(open_):
                path[t, node] = level + mean_path(len(rows))
                continue
            c = rng.choice(open_)
            cut = rng.uniform(low[c], high[c])
            right = rows[:, c] >= cut
            if right.all():  # a cut that rounds to the least value
                cut = np.nextafter(low[c], high[c])
                right = rows[:, c] >= cut
            column[t, node], place[t, node] = c, cut
            waiting += [(2 * node + 1, level + 1, rows[~right]), (2 * node + 2, level + 1, rows[right])]
    return Forest(column, place, path, depth, float(mean_path(max(size, 2))))


def forest_outliers(df: DataFrame, columns: Sequence[str], share: float = 0.05, *, trees: int = TREES, per_tree: int = PER_TREE,
                    pool: int = POOL, seed: int = 42, least: int = 20, **kw) -> DataFrame:
    """Complete rows of df with `isolation` (0 to 1) and `outlier`, whether it exceeds its
    exact quantile of 1 - share.

    Rows with a null or undefined value in one of the columns are left out.  Trees see at most
    `pool` rows, those of the least digest of their values; all rows are scored.  Splits
    do not depend on a column's unit, so nothing is scaled first.  With fewer than `least` rows isolation is null.
    """
    value = [F.col(c).cast("double") for c in columns]
    ok = None
    for v in value:
        good = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
        ok = good if ok is None else ok & good
    rows = df.filter(F.coalesce(ok, F.lit(False)))
    sample = rows.select(*[v.alias(f"v{i}") for i, v in enumerate(value)]).orderBy(
        F.xxhash64(F.lit(seed), *value), *value).limit(pool).toArrow()
    if len(sample) < least:
        return rows.withColumns({"isolation": F.lit(None).cast("double"), "outlier": F.lit(False)})
    forest = grow(np.column_stack([sample.column(i).to_numpy() for i in range(len(columns))]), trees=trees, per_tree=per_tree, seed=seed)
    shared = df.sparkSession.sparkContext.broadcast(forest)  # trees x nodes, whatever the table's size
    names = [f"_v{i}" for i in range(len(columns))]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = np.column_stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in names])
            kept = [i for i, n in enumerate(batch.schema.names) if n not in names]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in kept], pa.array(shared.value.scores(matrix))], names=[*[batch.schema.names[i] for i in kept], "isolation"])

    rest = [c for c in df.columns if c not in ("isolation", "outlier")]
    wide = rows.select(*rest, *[v.alias(n) for v, n in zip(value, names, strict=True)])
    schema = T.StructType([*[f for f in wide.schema.fields if f.name not in names], T.StructField("isolation", T.DoubleType())])
    scored = materialise(wide.mapInArrow(score, schema), "isolation")  # the quantile and the flag read the same scores
    cut = exact_quantiles(scored, "isolation", {"_cut": 1 - share}, **kw).select("_cut")
    return attach_row(scored, cut).withColumn("outlier", F.col("isolation") > F.col("_cut")).drop("_cut")
