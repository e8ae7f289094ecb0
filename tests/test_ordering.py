"""Ordered operators on skewed data, against pandas."""

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL

from zonalis.operators import impute, ordering, ranking
from zonalis.operators.common import salted_join
from zonalis.plans.catalogue import all_queries
from zonalis.plans.registry import runner


@pytest.fixture(scope="module")
def skewed():
    """One key holds over a third of 6,000 rows; values repeat heavily; some are null."""
    rng = np.random.default_rng(7)
    n = 6000
    key = np.where(rng.random(n) < 0.4, "hot", "k" + pd.Series(rng.integers(0, 50, n)).astype(str))
    value = np.where(rng.random(n) < 0.3, 5.0, np.round(rng.random(n) * 20, 1))
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "v": value, "w": rng.integers(0, 4, n).astype(float)})
    pdf.loc[rng.random(n) < 0.2, "v"] = np.nan
    return pdf


@pytest.fixture
def frame(split, skewed):
    d = split.createDataFrame(skewed.astype(object).where(skewed.notna(), None), "id long, k string, v double, w double")
    return d.repartition(8)


def test_positions_with_ties_and_weights(frame, skewed):
    got = ordering.positions(frame.filter("v IS NOT NULL"), ["v", "id"], ["k"], ties=["v"], weight="w").toPandas().set_index("id").sort_index()
    p = skewed.dropna().sort_values(["k", "v", "id"])
    g = p.groupby("k")
    want = pd.DataFrame({"_rn": g.cumcount() + 1, "_n": g["v"].transform("size"), "_rank": g["v"].rank(method="min"),
                         "_cum": g["w"].cumsum(), "_total": g["w"].transform("sum")}).set_index(p["id"]).sort_index()
    for c in want:
        assert np.allclose(got[c], want[c]), c


def test_global_positions_and_ranks(frame, skewed):
    got = ordering.positions(frame.filter("v IS NOT NULL"), ["v", "id"], ties=["v"]).toPandas().set_index("id").sort_index()
    p = skewed.dropna().set_index("id")
    assert np.array_equal(got["_rank"], p["v"].rank(method="min").astype(int))
    assert sorted(got["_rn"]) == list(range(1, len(p) + 1))


def test_quantiles(frame, skewed):
    got = ordering.exact_quantiles(frame, "v", {"a": 0.25, "m": 0.5, "z": 0.99}, ["k"]).toPandas().set_index("k").sort_index()
    want = skewed.groupby("k")["v"].quantile([0.25, 0.5, 0.99]).unstack()
    assert np.allclose(got[["a", "m", "z"]], want)


def test_exclusive_quartiles(spark):
    import statistics
    xs = [1.0, 2.0, 4.0, 7.0, 11.0, 16.0, 22.0]
    d = spark.createDataFrame([(x,) for x in xs], "v double")
    row = ordering.exact_quantiles(d, "v", {"a": 0.25, "b": 0.75}, exclusive=True).first()
    q = statistics.quantiles(xs, n=4)
    assert (row.a, row.b) == (q[0], q[2])


@pytest.mark.parametrize("backward", [False, True])
def test_carried_values(frame, skewed, backward):
    got = ordering.carried_value(frame, "v", ["id"], ["k"], backward=backward, out="c").toPandas().set_index("id").sort_index()
    g = skewed.groupby("k")["v"]
    want = g.bfill() if backward else g.ffill()
    assert np.allclose(got["c"].astype(float), want, equal_nan=True)


def test_interpolation(frame, skewed):
    got = impute.fill_interpolated(frame, "v", ["id"], ["k"]).toPandas().set_index("id").sort_index()
    want = skewed.groupby("k")["v"].transform(lambda s: s.interpolate(limit_area="inside"))
    assert np.allclose(got["v"].astype(float), want, equal_nan=True)


def test_weighted_median_matches_its_rule(frame, skewed):
    got = impute.weighted_median_table(frame, ["v"], "w", ["k"], "").toPandas().set_index("k")["v"]
    for k, g in skewed.dropna().assign(w=lambda d: d["w"].replace(0, 1)).sort_values("v").groupby("k"):
        cum = g["w"].cumsum().to_numpy()
        i = min(np.searchsorted(cum, cum[-1] / 2, side="right"), len(g) - 1)
        assert got[k] == g["v"].to_numpy()[i]


@pytest.mark.parametrize("n", [1, 2, 9, 10, 23, 60])
def test_decile_equals_quantile_cut_of_first_ranks(spark, n):
    xs = pd.Series(np.random.default_rng(n).permutation(n).astype(float))
    d = spark.createDataFrame([(int(i), float(x)) for i, x in enumerate(xs)], "id long, s double")
    got = ranking.rank_scores(d, "s", "id").orderBy("id").toPandas()["s_decile"].tolist()
    want = [1] if n == 1 else (pd.qcut(xs.rank(method="first"), q=10, labels=False) + 1).tolist()
    assert got == want


def test_salted_join_keeps_every_pair(split):
    left = split.range(100).selectExpr("id", "case when id < 60 then 'a' else cast(id as string) end as k")
    right = split.createDataFrame([("a", 1), ("a", 2), ("70", 3), ("x", 4)], "k string, r int")
    j = salted_join(left, right, ["k"], ["id"], hot_rows=5).toPandas()
    assert len(j) == 121 and set(j["r"]) == {1, 2, 3}
    left_all = salted_join(left, right, ["k"], ["id"], how="left", hot_rows=5).toPandas()
    assert len(left_all) == 121 + 39


def test_no_frame_is_open_at_its_end(frame):
    """Spark starts such a frame anew for every row, so its time grows with the square of a slice."""
    for d in (ordering.carried_value(frame, "v", ["id"], ["k"], backward=True), ordering.neighbours(frame, "v", ["id"], ["k"])):
        plan = d._jdf.queryExecution().optimizedPlan().toString()
        assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan


@pytest.mark.parametrize("name", ["missing_carried", "missing_interpolated"])
def test_queries_have_no_frame_open_at_its_end(spark, name):
    plan = runner(all_queries()[name])(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan
