"""Hard negatives against brute force, and the cases the docstring defines."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonalis.llm import anchor_tree

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id long, score double, rank int, _anchor boolean, v string"


def row(i, v, label):
    return (i, v, label, 5, 0.5, 1, True, "x")


def brute(rows, anchors, positives, negatives, least=Fraction(4, 5)):
    known = [(i, [int(np.floor(256 * float(x))) for x in v], lab) for i, v, lab, *_ in rows
             if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v, lab in {(i, tuple(v), lab) for i, v, lab in known if anchors(i)}:
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, m == lab) for j, w, m in known if j != i and len(w) == len(v)]
        mine = sorted(x[:2] for x in scored if x[2])[:positives]
        for p, j in mine:
            window = sorted((s, n) for s, n, alike in scored if not alike and least * -p <= -s <= -p)[:negatives]
            out += [(i, j, r, n, -p, -s) for r, (s, n) in enumerate(window, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    heart = rng.normal(size=(6, 8))
    x = np.concatenate([heart[i % 6] + rng.normal(size=(1, 8)) * (0.05 if i % 3 else 0.6) for i in range(400)]).astype(np.float32)
    out = [row(i, v.tolist(), i % 4 if i % 50 else None if i == 50 else 1) for i, v in enumerate(x)]
    out += [row(1_000 + i, x[3].tolist(), i % 4) for i in range(40)]  # ties
    out += [row(2_000 + i, v, 1) for i, v in enumerate(([], None, [float("nan")] + [1.0] * 7, [None] + [1.0] * 7, [float("inf")] * 8, [0.0] * 8, [1.0, 2.0], [2.0, 1.0]))]
    out += [row(2_006, [1.0, 3.0], 2), row(None, x[0].tolist(), 1), row(20, x[21].tolist(), 0), row(20, x[20].tolist(), 0), row(20, x[20].tolist(), 0), row(21, x[21].tolist(), 1)]
    return out


@pytest.mark.parametrize(("block", "k", "n"), [(2_048, 5, 5), (7, 2, 1)])
def test_hard_negatives(spark, rows, block, k, n):
    got = anchor_tree.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, positives=k, negatives=n, block_anchors=block)
    want = brute(rows, lambda i: i % 10 == 0, k, n)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 80
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_bounds_hold_and_prune():
    """Every row's score lies in the range the tree gives; near anchors need few scores."""
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(40, 16)) * 20 + np.repeat(rng.normal(size=(4, 16)) * 2_000, 10, 0))
    x = np.floor(rng.normal(size=(500, 16)) * 500)
    block = anchor_tree.Block(np.arange(40), np.arange(40), np.zeros(40), vectors, anchor_tree.spanning_tree(vectors))
    assert sorted(a for a, _, _ in block.steps) == list(range(40))
    scored = 0

    def wanted(a, low, high):
        exact = x @ vectors[a]
        assert (low <= exact).all() and (exact <= high).all()
        return np.flatnonzero(high >= np.sort(exact)[-5])

    for a, need, scores in anchor_tree.walk(block, x, wanted):
        assert (scores == x[need] @ vectors[a]).all()
        scored += len(need)
    assert scored < 40 * 500 / 2


def test_the_tree_is_least():
    rng = np.random.default_rng(4)
    v = rng.integers(-50, 50, (30, 3)).astype(float)
    far = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    edges, of = sorted((far[i, j], i, j) for i in range(30) for j in range(i)), list(range(30))
    total = 0.0
    for d, i, j in edges:
        if of[i] != of[j]:
            total, of = total + d, [of[j] if x == of[i] else x for x in of]
    assert abs(sum(d for _, _, d in anchor_tree.spanning_tree(v)) - total) < 1e-6


def test_large_numbers(spark):
    """Products beyond 2^53 are exact."""
    big = [row(0, [2.0**20, 1.0], 1), row(1, [2.0**20, 3.0], 1), row(2, [2.0**20, 2.0], 2), row(3, [2.0**20, 3.0], 2), row(4, [2.0**20, 4.0], 2)]
    got = anchor_tree.hard_negatives(spark.createDataFrame(big, SCHEMA), F.col("vec_id") == 0)
    assert sorted(map(tuple, got.collect())) == brute(big, lambda i: i == 0, 5, 5) != []


def test_nothing_there(spark, rows):
    none = spark.createDataFrame([], SCHEMA)
    assert anchor_tree.hard_negatives(none, F.col("vec_id") % 10 == 0).count() == 0
    assert anchor_tree.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.lit(None).cast("boolean")).count() == 0
