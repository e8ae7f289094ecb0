"""Spatial joins against brute force where grids are hard: crowds, giants, the meridian, the poles."""

import math
import random

import pytest
from pyspark.sql import functions as F

from zonalis.operators import spatial

BOX = ["x0", "x1", "y0", "y1"]


def km(p, q):
    la1, la2, dlo = math.radians(p[1]), math.radians(q[1]), math.radians(q[0] - p[0])
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin(dlo / 2) ** 2
    return 2 * 6371.0 * math.asin(min(math.sqrt(h), 1.0))


def crowd(n):
    """Small boxes in one degree, some large ones, one world-wide, and some that meet nothing."""
    rng = random.Random(n)
    out = []
    for i in range(n):
        x, y, w = 140 + rng.random(), -35 + rng.random(), rng.choice([0.0, 0.004, 0.01, 0.02])
        out.append((i, x, x + w, y, y + w / 2))
    out += [(n, -180.0, 180.0, -90.0, 90.0), (n + 1, 100.0, 160.0, -40.0, -34.5), (n + 2, 139.0, 140.5, -34.5, -34.5), (n + 3, -300.0, 300.0, -34.2, -34.1)]
    return out + [(n + 4, None, 1.0, 0.0, 1.0), (n + 5, 141.0, 140.0, -35.0, -34.0), (n + 6, float("nan"), 150.0, -35.0, -34.0)]


def real(b):
    return None not in b and b[1] <= b[2] and b[3] <= b[4]


@pytest.mark.parametrize("hot", [None, 50])
def test_ten_thousand_boxes_in_one_degree(spark, hot):
    boxes = crowd(10_000)
    rng = random.Random(1)
    points = [(i, 140 + rng.random(), -35 + rng.random()) for i in range(300)] + [(900, -120.0, 80.0), (901, None, 1.0), (902, 140.5, -34.5), (903, boxes[7][1], boxes[7][3])]
    p = spark.createDataFrame(points, "p long, lon double, lat double")
    b = spark.createDataFrame(boxes, "b long, x0 double, x1 double, y0 double, y1 double")
    got = spatial.points_in_boxes(p, b, point=("p", "lon", "lat"), box_id="b", box=BOX, hot_rows=hot)
    want = {(i, c[0]) for i, x, y in points if x is not None for c in boxes if real(c) and c[1] <= x <= c[2] and c[3] <= y <= c[4]}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_candidates_of_a_point_do_not_follow_the_crowd(spark):
    """A point meets boxes of its own small cells, not all of its degree."""
    b = spark.createDataFrame([x for x in crowd(10_000) if real(x)], "b long, x0 double, x1 double, y0 double, y1 double")
    cells = spatial._box_cells(spatial._stored(b, BOX).withColumnRenamed("_own", "_level"), BOX)
    assert cells.groupBy(*spatial.LEVELLED).count().agg(F.max("count")).first()[0] < 100
    assert cells.groupBy("b").count().filter("b <= 10001").agg(F.max("count")).first()[0] <= 4


@pytest.mark.parametrize("hot", [None, 20])
def test_boxes_of_all_sizes_meet_once(spark, hot):
    boxes = crowd(400)
    a = spark.createDataFrame(boxes, "a long, x0 double, x1 double, y0 double, y1 double")
    o = a.select(F.col("a").alias("b"), *[F.col(c).alias(f"o_{c}") for c in BOX])
    got = spatial.boxes_meeting(a, o, a_id="a", b_id="b", a_box=BOX, b_box=[f"o_{c}" for c in BOX], hot_rows=hot).select("a", "b").collect()
    ok = [c for c in boxes if real(c)]
    want = {(p[0], q[0]) for p in ok for q in ok if p[1] <= q[2] and q[1] <= p[2] and p[3] <= q[4] and q[3] <= p[4]}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def places(seed, n):
    rng = random.Random(seed)
    out = [(rng.uniform(-180, 180), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(n)]
    out += [(rng.choice([-180, 180]) + rng.uniform(-0.5, 0.5) * rng.random(), rng.uniform(-60, 60)) for _ in range(n // 4)]
    out += [(rng.uniform(-180, 180), rng.choice([-1, 1]) * (90 - rng.random() ** 3)) for _ in range(n // 4)]
    out += [(151 + rng.random() * 0.01, -33 + rng.random() * 0.01) for _ in range(n // 2)]
    out = [((x + 180) % 360 - 180, y) for x, y in out]
    return [*out, (180.0, 10.0), (-180.0, 10.0), (0.0, 90.0), (77.0, 90.0), (0.0, -90.0)]


@pytest.mark.parametrize(("k", "n", "hot"), [(1, 300, None), (4, 300, 30), (5, 3, None)])
def test_nearest_services_everywhere(spark, k, n, hot):
    areas, services = places(1, 200), places(2, n)
    services += services[:5] * 3
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(areas)] + [(9_999, None, 1.0)], "id long, lon double, lat double")
    s = spark.createDataFrame([(f"s{i:04}", *p) for i, p in enumerate(services)] + [("none", 1.0, None)], "sid string, slon double, slat double")
    got = spatial.nearest_services(a, s, area=("id", "lon", "lat"), service=("sid", "slon", "slat"), k=k, hot_rows=hot).collect()
    by_area = {}
    for r in got:
        by_area.setdefault(r["id"], []).append((r["rank"], r["service_id"], r["distance_km"]))
    assert sorted(by_area) == list(range(len(areas)))
    for i, p in enumerate(areas):
        mine = sorted(by_area[i])
        want = sorted((km(p, q), f"s{j:04}") for j, q in enumerate(services))[:k]
        assert [m[0] for m in mine] == list(range(1, len(want) + 1))
        assert all(abs(m[2] - w[0]) < 1e-6 for m, w in zip(mine, want, strict=True))
        exact = [w for w in want if sum(abs(w[0] - v[0]) < 1e-6 for v in want) == 1]
        assert {w[1] for w in exact[:-1]} <= {m[1] for m in mine}


def test_services_at_one_place_rank_by_id(spark):
    s = spark.createDataFrame([(f"s{i:03}", 10.0, 20.0) for i in range(200)] + [("far", 50.0, 20.0)], "sid string, slon double, slat double")
    a = spark.createDataFrame([(1, 10.0, 20.0)], "id long, lon double, lat double")
    got = spatial.nearest_services(a, s, area=("id", "lon", "lat"), service=("sid", "slon", "slat"), k=3).orderBy("rank").collect()
    assert [(r["rank"], r["service_id"], r["distance_km"]) for r in got] == [(i + 1, f"s{i:03}", 0.0) for i in range(3)]
    none = s.limit(0)
    assert spatial.nearest_services(a, none, area=("id", "lon", "lat"), service=("sid", "slon", "slat")).count() == 0


def test_close_locations_across_the_meridian_and_at_the_poles(spark):
    spots = [(179.9999, 0.0), (-179.9999, 0.0), (10.0, 89.9999), (190.0 - 360, 89.9999), (0.0, -90.0), (120.0, -90.0), (60.0, 85.0), (60.01, 85.0), (5.0, 5.0)]
    spots += [(x, y) for x, y in places(5, 100)]
    spots = sorted(set(spots))
    d = spark.createDataFrame(spots, "lon double, lat double")
    for limit in (0.1, 5.0, 300.0):
        got = {(r["lon"], r["lat"]): (r["close"], r["nearest_km"]) for r in spatial.close_locations(d, "lon", "lat", limit).collect()}
        for p in spots:
            near = [km(p, q) for q in spots if q != p and km(p, q) < limit]
            assert got.get(p, (0, None))[0] == len(near), p
            assert not near or abs(got[p][1] - min(near)) < 1e-6


def test_hot_spots(spark):
    """A block of high values in a plain field is hot, the values' own cells wrap at 180 degrees."""
    rng = random.Random(4)
    rows = [(i, -180 + (i % 60) * 6 + 0.5, -60 + (i // 60) * 6 + 0.5, rng.random() + (50 if i // 60 == 9 and i % 60 in (59, 0, 1) else 0)) for i in range(60 * 20)]
    d = spark.createDataFrame([*rows, (5_000, 1.0, None, 3.0), (5_001, 1.0, 1.0, None)], "id long, lon double, lat double, v double")
    got = {r["id"]: r for r in spatial.hot_spots(d, area_id="id", lon="lon", lat="lat", value="v", cell=6.0).collect()}
    assert len(got) == len(rows)
    values = {(i % 60, i // 60): v for i, _, _, v in rows}
    n, mean = len(rows), sum(values.values()) / len(rows)
    dev = math.sqrt(sum((v - mean) ** 2 for v in values.values()) / n)
    for i, *_ in rows:
        near = [values[(i % 60 + a) % 60, i // 60 + b] for a in (-1, 0, 1) for b in (-1, 0, 1) if ((i % 60 + a) % 60, i // 60 + b) in values]
        m = len(near)
        z = (sum(near) - mean * m) / (dev * math.sqrt((n * m - m * m) / (n - 1)))
        assert got[i]["neighbours"] == m and abs(got[i]["z"] - z) < 1e-9
        assert got[i]["spot"] == ("hot" if z >= 1.96 else "cold" if z <= -1.96 else "none")
    assert {i for i, r in got.items() if r["spot"] == "hot"} >= {9 * 60, 9 * 60 + 59, 9 * 60 + 1}
    same = spatial.hot_spots(d.withColumn("v", F.lit(1.0)), area_id="id", lon="lon", lat="lat", value="v", cell=6.0)
    assert same.filter("z IS NOT NULL OR spot <> 'none'").count() == 0
    with pytest.raises(ValueError):
        spatial.hot_spots(d, area_id="id", lon="lon", lat="lat", value="v", cell=7.0)
