"""Embedding near-duplicates by product quantisation.

Unit vectors are put in the inverted list of their nearest coarse centre; the residual is
coded by one byte per subspace, and its distance to its code is kept.  A query probes every
list that can hold a vector within the radius of the threshold, scans codes by asymmetric
table lookups, and drops a row only if its looked-up distance less its coding error exceeds
the radius.  Both rules are bounds, so whatever the centres and codes are, no link is
lost; survivors are compared exactly in double precision.

Centres and codes are fitted on a bounded sample.  Vectors with equal components and label
are one entry with a count.  Lists are scanned in blocks against blocks of queries, and a
block pair yields link counts and a spanning set of links, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.components import connected
from zonalis.llm.vectors import finite, matrix
from zonalis.session import materialise, scratch_path

SAMPLE = 8_192  # vectors that centres and codes are fitted on, at most
LISTS, SUBSPACES, CODES, ITERATIONS = 64, 8, 64, 8
BLOCK = 2_048
SLOP = 1e-6  # room for rounding in the bounds


def _means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means centres, at most one per row."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ITERATIONS):
        near = _nearest(x, centres)
        for c in range(len(centres)):
            own = x[near == c]
            if len(own):
                centres[c] = own.mean(0)
    return centres


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return _squared(x, centres).argmin(1)


def _cuts(dims: int, subspaces: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, dims, min(subspaces, dims) + 1).astype(int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


def fit(sample: np.ndarray, lists: int, subspaces: int, codes: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Coarse centres, and per subspace the codes of the residuals."""
    rng = np.random.default_rng(7)
    centres = _means(sample, lists, rng)
    rest = sample - centres[_nearest(sample, centres)]
    return centres, [_means(rest[:, a:b], codes, rng) for a, b in _cuts(sample.shape[1], subspaces)]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _scan(index: pa.Table, queries: pa.Table, centres: np.ndarray, codes: list[np.ndarray], at: int, threshold: float) -> pa.Table:
    """Links of a block of queries with a block of one inverted list: per vector its count,
    and links enough to connect what the links connect."""
    raw, asked = matrix(index.column("v"), "float64"), matrix(queries.column("v"), "float64")
    ids, qids = index.column("id").to_numpy(), queries.column("id").to_numpy()
    copies = index.column("copies").to_numpy()
    coded = np.stack([np.frombuffer(c, np.uint8) for c in index.column("code").to_pylist()])
    error = index.column("error").to_numpy()
    radius = np.sqrt(2 - 2 * threshold) + SLOP
    unit = _unit(asked)
    norm, qnorm = np.linalg.norm(raw, axis=1), np.linalg.norm(asked, axis=1)
    rest = unit - centres[at]
    looked = np.zeros((len(unit), len(ids)))
    for s, (a, b) in enumerate(_cuts(raw.shape[1], len(codes))):
        looked += _squared(rest[:, a:b], codes[s])[:, coded[:, s]]
    qi, ri = np.nonzero(np.sqrt(looked) - error[None, :] <= radius)
    up = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    counts = np.zeros(len(qids), np.int64)
    a, b = [], []
    for lo in range(0, len(qi), 65536):
        i, j = qi[lo : lo + 65536], ri[lo : lo + 65536]
        cosine = (asked[i] * raw[j]).sum(1) / (qnorm[i] * norm[j])
        keep = (cosine >= threshold) & (qids[i] != ids[j])
        i, j = i[keep], j[keep]
        np.add.at(counts, i, copies[j])
        for x, y in zip(qids[i].tolist(), ids[j].tolist(), strict=True):
            p, q = top(x), top(y)
            if p != q:
                up[max(p, q)] = min(p, q)
                a.append(x)
                b.append(y)
    some = np.flatnonzero(counts)
    return pa.table({
        "a": pa.array([*qids[some].tolist(), *a], pa.int64()), "b": pa.array([*[None] * len(some), *b], pa.int64()),
        "n": pa.array([*counts[some].tolist(), *[0] * len(a)], pa.int64())})


def embedding_components(rows: DataFrame, *, row_id: str = "vec_id", vector: str = "embedding", label: str | None = "label", threshold: float = 0.93,
                         lists: int = LISTS, subspaces: int = SUBSPACES, codes: int = CODES, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Two rows link if their labels are equal and not null (label=None: all rows) and their
    cosine in double precision is `threshold` (above 0) or more.  Vectors that are null, empty, zero
    or hold null or non-finite numbers link with nothing, nor do vectors of different length.
    n_links counts the other rows linked, component_id is the smallest id reachable, kept tells
    whether that is the row's own.  A null id has no links and a null component, and is not
    kept.  Rows that share an id are told apart in links and share a component.
    """
    spark = rows.sparkSession
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0, at most 1")
    lab = F.col(label).cast("string") if label else F.lit("")
    norm = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = F.col(row_id).isNotNull() & lab.isNotNull() & F.when(finite(vector), (norm > 0) & (norm < float("inf"))).otherwise(False)
    known = rows.filter(usable).select(F.col(row_id).cast("long").alias("id"), lab.alias("label"), F.col(vector).cast("array<double>").alias("v"))
    counted = known.withColumn("_d", F.xxhash64("label", "v"))
    heads = materialise(counted.groupBy("_d", "label", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "vectors")
    same = materialise(counted.join(heads.select("_d", F.col("label").alias("_l"), F.col("v").alias("_v"), F.col("id").alias("head"), "copies"), "_d")
                       .filter((F.col("label") == F.col("_l")) & (F.col("v") == F.col("_v"))).select("id", "head", "copies", "_d"), "copies")

    # Every length is a search of its own; a length that one vector alone has needs none.
    out, made = scratch_path(spark, "links"), 0
    lengths = heads.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    for dims, _ in lengths.orderBy("dims").toLocalIterator():
        own = heads.filter(F.size("v") == dims)
        fitted = np.array([r[0] for r in own.select("v").orderBy(F.xxhash64("id", "v"), "id").limit(sample).collect()])
        centres, books = fit(_unit(fitted), lists, subspaces, codes)
        _links(own, dims, spark.sparkContext.broadcast((centres, books)), threshold, block).write.parquet(f"{out}/length={made}")
        made += 1
    # Copies of one vector are counted below; they need no search.
    schema = "a long, b long, n long"
    links = spark.read.schema(schema).parquet(*[f"{out}/length={i}" for i in range(made)]) if made else spark.createDataFrame([], schema)
    counts = links.groupBy(F.col("a").alias("head")).agg(F.sum("n").alias("n"))
    edges = links.filter(F.col("b").isNotNull()).select("a", "b").unionAll(same.select(F.col("id").alias("a"), F.col("head").alias("b")))
    groups = connected(edges).select(F.col("node").alias("id"), "component")
    # `head` is the smallest id of equal vectors; rows that share id and vector are alike.
    per_row = same.join(counts, "head", "left").groupBy("id", "_d").agg(F.max(F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select(F.col(row_id).cast("long").alias("id"), F.when(usable, F.xxhash64(lab, F.col(vector).cast("array<double>"))).alias("_d"))
    out = out.join(per_row, ["id", "_d"], "left").join(groups, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _links(rows: DataFrame, dims: int, shared, threshold: float, block: int) -> DataFrame:
    def place(batches):
        """List, code and coding error of each row, and the lists it must probe."""
        centres, books = shared.value
        between = np.sqrt(_squared(centres, centres))
        radius = np.sqrt(2 - 2 * threshold) + SLOP
        for batch in batches:
            unit = _unit(matrix(batch.column("v"), "float64"))
            far = _squared(unit, centres)
            own = far.argmin(1)
            rest = unit - centres[own]
            code, kept = np.zeros((len(unit), len(books)), np.uint8), np.zeros_like(rest)
            for s, (a, b) in enumerate(_cuts(dims, len(books))):
                code[:, s] = _nearest(rest[:, a:b], books[s])
                kept[:, a:b] = books[s][code[:, s]]
            # A vector of list c within the radius is no nearer to another centre o than to c:
            # it lies beyond their bisector, at a distance of (d_c^2 - d_o^2) / (2 |c - o|).
            nearest = far[np.arange(len(unit)), own]
            reach = (far - nearest[:, None]) <= 2 * radius * between[own] + SLOP
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("id", "label", "v", "copies")), pa.array(own.astype(np.int32)),
                pa.array([c.tobytes() for c in code], pa.binary()), pa.array(np.linalg.norm(rest - kept, axis=1) + SLOP),
                pa.array([np.flatnonzero(r).astype(np.int32) for r in reach], pa.list_(pa.int32()))],
                names=["id", "label", "v", "copies", "list", "code", "error", "probes"])

    index = materialise(rows.select("id", "label", "v", "copies").mapInArrow(
        place, "id long, label string, v array<double>, copies long, list int, code binary, error double, probes array<int>"), "index")
    asked = index.select(*[F.col(c).alias(c) for c in ("id", "label", "v")], F.explode("probes").alias("list"))
    parts = lambda df, name: df.groupBy("label", "list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))
    sizes = materialise(parts(index, "_i").join(parts(asked, "_q"), ["label", "list"]), "sizes")
    cut = lambda n: F.pmod(F.xxhash64("id", "v"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    key = ["label", "list", "i", "q"]
    left = index.join(sizes, ["label", "list"]).withColumn("i", cut("_i")).withColumn("q", spread("_q")).select(*key, "id", "v", "copies", "code", "error")
    right = asked.join(sizes, ["label", "list"]).withColumn("q", cut("_q")).withColumn("i", spread("_i")).select(*key, "id", "v")

    def meet(one: pa.Table, two: pa.Table) -> pa.Table:
        if not len(one) or not len(two):
            return pa.table({c: pa.array([], pa.int64()) for c in "abn"})
        centres, books = shared.value
        return _scan(one, two, centres, books, one.column("list")[0].as_py(), threshold)

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, "a long, b long, n long")
