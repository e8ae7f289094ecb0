"""Operators on embeddings: brute force, and the cases each docstring defines."""

import numpy as np
import pytest

from zonalis.llm import product_quantiser, threshold_search

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v string"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 12)).astype(np.float32)
    x[100:180] = x[0] + rng.normal(size=(80, 12)).astype(np.float32) * 0.2
    x[180:200] = x[1]
    rows = [(i, v.tolist(), i % 3 if i < 290 else None, "c", "v") for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 12, [float("nan")] + [1.0] * 11, [None] + [1.0] * 11, [float("inf")] * 12, [1.0, 2.0]]
    rows += [(400 + i, v, 1, "c", "v") for i, v in enumerate(odd)]
    return rows + [(None, x[0].tolist(), 0, "c", "v"), (7, x[7].tolist(), 1, "c", "v"), (408, [2.0, 4.0], 1, "c", "v")]


def usable(v):
    return bool(v) and all(c is not None and np.isfinite(c) for c in v)


@pytest.mark.parametrize(("lists", "block"), [(8, 16), (64, 2_048)])
def test_embedding_components(spark, vectors, lists, block):
    got = product_quantiser.embedding_components(spark.createDataFrame(vectors, SCHEMA), lists=lists, codes=16, block=block).collect()
    known = [(i, np.float64(v), lab) for i, v, lab, *_ in vectors if i is not None and lab is not None and usable(v) and any(v)]
    label, links = {i: i for i, *_ in vectors if i is not None}, {}
    pairs = [(p, q) for p in range(len(known)) for q in range(len(known)) if p != q and known[p][2] == known[q][2] and len(known[p][1]) == len(known[q][1])
             and known[p][1] @ known[q][1] / np.sqrt(known[p][1] @ known[p][1]) / np.sqrt(known[q][1] @ known[q][1]) >= 0.93]
    for p, _ in pairs:
        links[known[p][0], tuple(known[p][1])] = links.get((known[p][0], tuple(known[p][1])), 0) + 1
    for _ in known:
        for p, q in pairs:
            a, b = known[p][0], known[q][0]
            label[a] = label[b] = min(label[a], label[b])
    # id 7 occurs twice with one vector: both rows count the other as a link
    for key in [k for k in links if k[0] == 7]:
        links[key] //= 2
    want = sorted((i, links.get((i, tuple(np.float64(v))) if usable(v) else None, 0), label[i], label[i] == i) for i, v, *_ in vectors if i is not None)
    assert sorted(tuple(r) for r in got if r["vec_id"] is not None) == want
    assert [tuple(r) for r in got if r["vec_id"] is None] == [(None, 0, None, False)]


@pytest.mark.parametrize("shard", [4_096, 40])
def test_top_products(spark, vectors, shard):
    rows = threshold_search.quantised(spark.createDataFrame(vectors, SCHEMA))
    got = threshold_search.top_products(rows, rows.filter("vec_id % 50 = 0"), k=5, shard_rows=shard, block_queries=3).collect()
    whole = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v, *_ in vectors if i is not None and usable(v)]
    want = []
    for i, q in whole:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in whole if j != i and len(v) == len(q))[:5]
            want += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_large_numbers():
    big = np.array([[2**40, 1], [2**40, 2], [-(2**40), 3]], np.int64)
    got = threshold_search.threshold_top(big, np.array([1, 2, 3]), np.array([[2**20, 5]]), np.array([9]), 2)
    assert got == [(9, 2, 2**60 + 10), (9, 1, 2**60 + 5)]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert product_quantiser.embedding_components(none).count() == 0
    assert threshold_search.top_products(threshold_search.quantised(none), threshold_search.quantised(none)).count() == 0


def test_vectors_of_many_lengths(spark):
    """Every length is searched, and copies of a vector that has its length alone are linked."""
    rows = [(100 * n + i, [float(n)] * n + [0.01 * i], 1, "c", "v") for n in range(1, 9) for i in range(3)] + [(5_000, [1.0] * 40, 1, "c", "v"), (5_001, [1.0] * 40, 1, "c", "v")]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in product_quantiser.embedding_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {**{100 * n + i: (2, 100 * n) for n in range(1, 9) for i in range(3)}, 5_000: (1, 5_000), 5_001: (1, 5_000)}
