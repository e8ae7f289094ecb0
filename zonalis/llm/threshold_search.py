"""Exact top-k inner products by Fagin's threshold algorithm, for blocks of queries at once.

A task reads its rows shard by shard.  A shard keeps, for every dimension, its rows sorted by
that component, once for all queries.  Lists are read from the end that adds to a query's
product, to the same depth in all; no row unmet at a depth can score more than the sum of
the weighted components there.  Where that bound cannot beat the k-th best score that the
query has so far, only the rows met are scored (the random access).  Depths grow fourfold;
queries whose bound still wins when the lists would have met more than half of the shard
are settled by one blocked product.

Queries are taken in blocks of bounded size, which are broadcast to the scan of all rows.  A
block's own vectors that are rows, too, tell what a row must reach from the start.  What is
shuffled is the k best of every task; the best of all tasks are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis.llm.vectors import finite, matrix
from zonalis.session import materialise, scratch_path

SHARD_ROWS, BLOCK_QUERIES = 4_096, 4_096
FIRST_DEPTH = 8
_EXACT = 2**53


class Search:
    """The k best rows so far of every query of a block, other than those of its id."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.queries, self.ids, self.k = queries, ids, k
        n = len(ids)
        self.floor = np.full(n, -np.inf) if floor is None else floor.astype(float)  # what the k-th best has at least
        self.best: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        self.met = self.all = 0  # rows scored, and rows there were, over all queries

    def _offer(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        take = np.flatnonzero((scores >= self.floor[q]) & (ids != self.ids[q]))
        if len(take):
            if len(take) > self.k:  # ties with the k-th stay
                take = take[scores[take] >= np.sort(scores[take])[-self.k]]
            new = zip(scores[take].tolist(), ids[take].tolist(), strict=True)
            best = self.best[q] = sorted([*self.best[q], *new], key=lambda x: (-x[0], x[1]))[: self.k]
            if len(best) == self.k:
                self.floor[q] = max(self.floor[q], float(best[-1][0]))

    def add(self, rows: np.ndarray, ids: np.ndarray) -> None:
        """Meet a shard: rows of whole numbers."""
        n, dims = rows.shape
        self.all += n * len(self.ids)
        most = float(np.abs(rows).max(initial=0)) * float(np.abs(self.queries).max(initial=0)) * dims
        if most >= _EXACT:  # beyond what double precision holds: Python's whole numbers
            as_int = np.frompyfunc(int, 1, 1)
            whole, self.floor = as_int(rows), np.full(len(self.ids), -np.inf)
            self.met += n * len(self.ids)
            for q, vector in enumerate(self.queries):
                self._offer(q, whole @ as_int(vector), ids)
            return
        rows = rows.astype(np.float64)
        queries = self.queries.astype(np.float64)
        rising = np.argsort(rows, axis=0, kind="stable")
        sorted_rows = np.take_along_axis(rows, rising, 0)
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        open_ = np.arange(len(self.ids))
        depth = min(FIRST_DEPTH, n)
        while len(open_) and depth * dims * 2 <= n:
            bound = up[open_] @ sorted_rows[n - 1 - depth] + down[open_] @ sorted_rows[depth]
            stops = bound < self.floor[open_]
            for q in open_[stops]:
                live = np.flatnonzero(queries[q])
                rises = queries[q, live] > 0
                met = np.unique(np.r_[rising[n - depth :, live[rises]].ravel(), rising[:depth, live[~rises]].ravel()])
                self.met += len(met)
                self._offer(q, rows[met] @ queries[q], ids[met])
            open_ = open_[~stops]
            depth *= 4
        self.met += n * len(open_)
        for at in range(0, len(open_), 256):
            some = open_[at : at + 256]
            for q, scores in zip(some.tolist(), queries[some] @ rows.T, strict=True):
                self._offer(q, scores, ids)


def threshold_top(rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, id, score) of each query's k best rows other than its own, ties to smaller ids."""
    search = Search(queries, query_ids, k)
    search.add(rows, ids)
    return [(q, i, int(score)) for q, best in zip(query_ids.tolist(), search.best, strict=True) for score, i in best]


def _own_floor(vectors: np.ndarray, ids: np.ndarray, there: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score among those of the block's queries that are rows of the table."""
    out = np.full(len(ids), -np.inf)
    if float(np.abs(vectors).max(initial=0)) ** 2 * vectors.shape[1] < _EXACT:
        wide = vectors.astype(np.float64)
        for q in range(len(ids)):
            scores = (wide @ wide[q])[there & (ids != ids[q])]
            if len(scores) >= k:
                out[q] = np.partition(scores, -k)[-k]
    return out


def top_products(rows: DataFrame, queries: DataFrame, *, row_id: str = "vec_id", vector: str = "embedding", k: int = 5,
                 shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank from 1, id, score): the k rows with the largest inner product.

    Vectors are arrays of whole numbers (long); null ones and ones that hold null take no
    part, and vectors of another length than the query's are left out.  Rows with the query's
    own id are not candidates.  Rows that repeat an id are candidates each; queries that are alike
    in id and vector are one.  Products that do not fit a double exactly are taken in Python's whole
    numbers; those beyond a long are an error.
    """
    spark = rows.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        ok = F.col(row_id).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull())
        return df.filter(ok).select(F.col(row_id).cast("long").alias("id"), F.col(vector).cast("array<long>").alias("v"), F.size(vector).alias("dims"))

    all_rows = clean(rows)
    asked = materialise(clean(queries).distinct().withColumn("number", F.monotonically_increasing_id()), "queries")
    out, made = scratch_path(spark, "best"), 0
    for dims, count in asked.groupBy("dims").count().orderBy("dims").toLocalIterator():
        blocks = -(-count // block_queries)
        those = all_rows.filter(F.col("dims") == dims).select("id", "v")
        for n in range(blocks):
            part = asked.filter((F.col("dims") == dims) & (F.pmod(F.xxhash64("number"), F.lit(blocks)) == n)).select("id", "v", "number").orderBy("number").toArrow()
            if not len(part) or not dims:
                continue
            vectors, ids = matrix(part.column("v"), "int64"), part.column("id").to_numpy()
            # Queries of a bounded block that are found among the rows.
            named = spark.createDataFrame([(i, v) for i, v in zip(ids.tolist(), vectors.tolist(), strict=True)], "id long, v array<long>")
            found = {(r["id"], tuple(r["v"])) for r in those.join(F.broadcast(named), ["id", "v"], "left_semi").distinct().collect()}
            there = np.array([(i, tuple(v)) in found for i, v in zip(ids.tolist(), vectors.tolist(), strict=True)])
            floor = _own_floor(vectors, ids, there, k)
            _scan(those, vectors, ids, floor, k, shard_rows).write.parquet(f"{out}/block={made}")
            made += 1
    if not made:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    best = spark.read.schema("query_id long, id long, score long").parquet(*[f"{out}/block={i}" for i in range(made)])
    # Ranks are cut to k in each task before the shuffle.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _scan(rows: DataFrame, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int, shard_rows: int) -> DataFrame:
    """(query_id, id, score): what every task finds best in its rows (id, v)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, held, size = Search(queries, query_ids, k, floor), [], 0
        def meet() -> None:
            table = pa.Table.from_batches(held)
            search.add(matrix(table.column(1), "int64"), table.column(0).to_numpy())
        for batch in batches:
            for at in range(0, len(batch), shard_rows):
                part = batch.slice(at, shard_rows)
                held.append(part)
                size += len(part)
                if size >= shard_rows:
                    meet()
                    held, size = [], 0
        if size:
            meet()
        found = [(q, i, int(score)) for q, best in zip(query_ids.tolist(), search.best, strict=True) for score, i in best]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], names=["query_id", "id", "score"])

    return rows.mapInArrow(task, "query_id long, id long, score long")


def quantised(df: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """df whose finite vectors are floor(scale * x) as long, the others null."""
    return df.withColumn(vector, F.when(finite(vector), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))))
