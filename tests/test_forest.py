"""Outliers by random split trees: brute force, and what an ellipse cannot see."""

import math

import numpy as np
import pytest

from zonalis.operators import stats
from zonalis.operators.forest import Forest, forest_outliers, grow, mean_path

SCHEMA = "id long, x double, y double, isolation string, outlier string, note string"


def ring(n=1_500):
    rng = np.random.default_rng(3)
    angle, far = rng.uniform(0, 2 * math.pi, n), rng.normal(10, 0.4, n)
    return list(zip(range(n), (far * np.cos(angle)).tolist(), (far * np.sin(angle)).tolist(), strict=True))


def walked(forest: Forest, row):
    total = 0.0
    for t in range(len(forest.column)):
        node = 0
        while forest.column[t, node] >= 0:
            node = 2 * node + 1 + (row[forest.column[t, node]] >= forest.place[t, node])
        total += forest.path[t, node]
    return 2 ** (-total / len(forest.column) / forest.scale)


def test_planted_outliers_inside_a_ring(spark):
    """Rows in the hollow of a ring are near the mean: only the trees see them."""
    planted = [(10_000 + i, 0.2 * i - 0.4, 0.1 * i, ) for i in range(5)]
    rows = [(*r, "a", "b", "n") for r in [*ring(), *planted]] + [(20_000, None, 1.0, "a", "b", "n"), (20_001, float("nan"), 1.0, "a", "b", "n"), (20_002, float("inf"), 1.0, "a", "b", "n")]
    d = spark.createDataFrame(rows, SCHEMA)
    got = forest_outliers(d, ["x", "y"], share=0.02).collect()
    assert len(got) == 1_505 and {r["id"] for r in got if r["outlier"]} >= {p[0] for p in planted}
    assert 20 <= sum(r["outlier"] for r in got) <= 31 and got[0]["note"] == "n"
    ellipse = {r["id"] for r in stats.multivariate_outliers(d.filter("id < 20000"), ["x", "y"], share=0.02).filter("outlier").collect()}
    assert not ellipse & {p[0] for p in planted}
    forest = grow(np.array([r[1:3] for r in sorted([*ring(), *planted])]))
    assert all(0 < r["isolation"] < 1 for r in got)
    some = np.array([r[1:3] for r in ring(50)])
    assert np.allclose(forest.scores(some), [walked(forest, r) for r in some])


def test_scores_do_not_depend_on_how_rows_are_dealt(spark):
    d = spark.createDataFrame([(*r, "a", "b", "n") for r in ring(300)], SCHEMA)
    one = {r["id"]: r["isolation"] for r in forest_outliers(d.repartition(1), ["x", "y"]).collect()}
    two = {r["id"]: r["isolation"] for r in forest_outliers(d.repartition(7, "y"), ["x", "y"], pool=8_192).collect()}
    assert one == two


def test_sums_of_paths():
    """A leaf of n rows counts the mean depth of a random search tree."""
    assert [float(mean_path(n)) for n in (0, 1, 2)] == [0, 0, 1]
    harmonic = sum(1 / i for i in range(1, 256))
    assert abs(float(mean_path(256)) - (2 * harmonic - 2 * 255 / 256)) < 0.01


@pytest.mark.parametrize("rows", [[], [(i, 1.0, 1.0, "a", "b", "n") for i in range(19)]])
def test_too_few_rows(spark, rows):
    got = forest_outliers(spark.createDataFrame(rows, SCHEMA), ["x", "y"]).collect()
    assert len(got) == len(rows) and not any(r["outlier"] or r["isolation"] is not None for r in got)


def test_equal_rows_are_no_outliers(spark):
    d = spark.createDataFrame([(i, 1.0, 2.0, "a", "b", "n") for i in range(400)] + [(999, 50.0, 2.0, "a", "b", "n")], SCHEMA)
    got = {r["id"]: r for r in forest_outliers(d, ["x", "y"], per_tree=512, share=0.01).collect()}
    assert [i for i, r in got.items() if r["outlier"]] == [999]
