"""Small frames with known answers."""

import io
import math
import zipfile

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from zonalis.functions import codes, geo, ratios
from zonalis.operators import aggregates, census, geometry, impute, indicators, integrate, joins, quality, spatial, stats, temporal
from zonalis.plans.catalogue import all_queries
from zonalis.plans.registry import runner
from zonalis.session import scratch_path
from zonalis.sinks import writers
from zonalis.sources import delimited, documents, records, tables
from zonalis.streaming import usage


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("text,band", [("40-44 years", "40-44 years"), ("0-4", "0-4"), ("Aged 85+", "85+"), ("10-14", "10-14"), ("All Ages", "all_ages"), ("", "all_ages")])
def test_age_group_is_not_matched_inside_a_longer_number(spark, text, band):
    assert one(spark, codes.standard_age_group(F.lit(text))) == band


@pytest.mark.parametrize("code,chapter", [("D48.1", "Neoplasms"), ("D50", "Blood and immune disorders"), ("C34", "Neoplasms"), ("X70", "External causes"), ("Z00", "Other causes")])
def test_icd_chapter(spark, code, chapter):
    assert one(spark, codes.icd10_chapter(F.lit(code))) == chapter


@pytest.mark.parametrize("pc,state", [("2000", "NSW"), ("2600", "ACT"), ("800", "NT"), ("9000", "QLD"), ("2619", "NSW"), ("300", None), ("12345", None)])
def test_postcode_state(spark, pc, state):
    assert one(spark, codes.postcode_state(F.lit(pc))) == state


def test_known_distance(spark):
    km = one(spark, geo.haversine_km(F.lit(-33.8688), F.lit(151.2093), F.lit(-37.8136), F.lit(144.9631)))
    assert 710 < km < 716


@pytest.mark.parametrize("lon,zone", [(151.2, 55), (115.9, 49), (155.9, 55), (156.0, 56), (113.9, None)])
def test_mga_zone(spark, lon, zone):
    lat = F.lit(-30.0)
    want = {151.2: 55}.get(lon, zone)
    assert one(spark, geo.mga_zone(F.lit(lon), lat)) == want


def test_zero_denominators(spark):
    d = spark.createDataFrame([("1", 0, 0, 0, 0, 0), ("2", 60, 20, 20, 50, 150)],
                              "area string, employed_full_time long, employed_part_time long, unemployed long, not_in_labour_force long, labour_force_pop long")
    a, b = census.labour_force(d).orderBy("area").collect()
    assert (a.unemployment_rate, a.participation_rate, a.full_time_employment_ratio) == (0.0, 0.0, 0.0)
    assert (b.unemployment_rate, b.full_time_employment_ratio) == (20.0, 75.0)
    assert b.participation_rate == pytest.approx(100 / 150 * 100)


def test_diversity(spark):
    assert one(spark, ratios.shannon([F.lit(10), F.lit(10), F.lit(10)])) == pytest.approx(1.0)
    assert one(spark, ratios.shannon([F.lit(30), F.lit(0), F.lit(0)])) == pytest.approx(0.0)
    assert one(spark, ratios.simpson([F.lit(10), F.lit(10)])) == pytest.approx(0.5)
    assert one(spark, ratios.skill_imbalance([F.lit(10), F.lit(0), F.lit(0)])) == 0.0


def test_reversed_bounds_invert_twice_only_as_coded(spark):
    dear = F.lit(700.0)
    assert one(spark, ratios.normalise(dear, 700, 300, inverse=True)) == 0.0
    assert one(spark, ratios.normalise(dear, 700, 300, inverse=True, as_coded=True)) == 100.0


def test_median_ladder(spark):
    rows = [("10101", "101", "1", 10.0), ("10101", "101", "1", 20.0), ("10101", "101", "1", None), ("10102", "101", "1", None), ("20101", "201", "2", None)]
    d = spark.createDataFrame(rows, "sa3 string, sa4 string, state string, v double")
    out = [r.v for r in impute.fill_ladder_median(d, ["v"], ["sa3", "sa4", "state"]).orderBy("sa3", "v").collect()]
    assert out == [10.0, 15.0, 20.0, 15.0, 15.0]


def test_conflict_strategies(spark):
    rows = [("a", "name", "s1", "x", 0.5), ("a", "name", "s2", "x", 0.6), ("a", "name", "s3", "x", 0.4), ("a", "name", "s4", "y", 0.9),
            ("a", "rate", "s1", "10", 0.5), ("a", "rate", "s2", "20", 1.0), ("b", "rate", "s1", "10", 0.5), ("b", "rate", "s2", "n/a", 0.4)]
    d = spark.createDataFrame(rows, "k string, f string, source string, value string, quality double").withColumn("ts", F.lit("2020-01-01").cast("timestamp"))
    got = {(r.k, r.f): r for r in integrate.resolve_conflicts(d, ["k"], "f", as_of="2021-01-01").collect()}
    assert (got["a", "name"].resolved, got["a", "name"].confidence) == ("x", 0.75)
    assert float(got["a", "rate"].resolved) == pytest.approx((10 * 0.25 + 20 * 1.0) / 1.25)
    assert got["b", "rate"].resolved == "10"


def test_interpolated_alignment(spark):
    d = spark.createDataFrame([("a", "population", "2020-01-01", 100.0, 1.0), ("a", "population", "2022-01-01", 200.0, 0.8)], "k string, f string, ts string, value double, quality double")
    d = d.withColumn("ts", F.col("ts").cast("timestamp"))
    r = temporal.align_to_date(d, ["k", "f"], reference="2021-01-01", strategy=temporal.alignment_strategy(F.col("f"))).first()
    assert r.method == "interpolated" and r.value == pytest.approx(100 + 100 * 366 / 731)
    assert r.confidence == pytest.approx(0.9 * 0.5)


def test_repeated_key_fails_the_join(spark):
    left = spark.createDataFrame([(1, 2)], "k int, a int")
    right = spark.createDataFrame([(1, 5), (1, 6)], "k int, b int")
    with pytest.raises(Exception, match="repeated key"):
        joins.domain_joins(left, {"d": right}, ["k"]).collect()


def test_strict_mapping_fails(spark):
    d = spark.createDataFrame([(1, "999999999", "sa2")], "rec int, code string, kind string")
    conc = spark.createDataFrame([("sa2", "101021007", "101021007", 1.0)], "code_type string, code string, target string, factor double")
    assert joins.map_to_areas(d, "code", "kind", conc, key=["rec"]).first()["mapping_error"] == "no_mapping"
    with pytest.raises(Exception, match="mapping failed"):
        joins.map_to_areas(d, "code", "kind", conc, key=["rec"], strict=True).collect()


def test_ring_simplification(spark):
    ring = [[0.0, 0.0], [0.5, 0.00005], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]
    d = spark.createDataFrame([([ring],)], "rings array<array<array<double>>>")
    assert geometry.simplify(d, "rings", "medium_detail").first()["rings"][0] == [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    assert len(geometry.simplify(d, "rings", "high_detail").first()["rings"][0]) == 6


def test_nearest_station_in_empty_surroundings(split):
    a = split.createDataFrame([(1, 150.0, -33.0), (2, 114.0, -20.0), (3, -179.9, 10.0)], "id int, lon double, lat double")
    s = split.createDataFrame([("x", 150.1, -33.0), ("y", 149.0, -33.0), ("z", 179.9, 10.0)], "st string, lon2 double, lat2 double")
    got = {r.id: r.station_id for r in spatial.nearest_station(a, s, area=("id", "lon", "lat"), station=("st", "lon2", "lat2")).collect()}
    assert got == {1: "x", 2: "y", 3: "z"}


def test_coincident_points_do_not_pair(split):
    d = split.createDataFrame([(i, 150.0, -33.0) for i in range(50)] + [(99, 150.0003, -33.0)], "id int, lon double, lat double")
    got = spatial.close_locations(d, "lon", "lat", 0.1).orderBy("lon").collect()
    assert [(r.copies, r.close) for r in got] == [(50, 1), (1, 1)]


def test_header_on_first_line_gives_nothing(spark):
    path = scratch_path(spark, "pre")
    spark.createDataFrame([("Date,Rain",), ("2020-01-01,1",)], "value string").coalesce(1).write.text(path)
    assert delimited.read_csv_after_preamble(spark, path, ["Date", "Rain"]).count() == 0


def test_zip_members(spark):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("notes.txt", "no")
        z.writestr("a/SA2_data.csv", 'id,name\n1,"x, y"\n2,z\n')
        z.writestr("b.json", '{"id": 7}\n')
    files = spark.createDataFrame([("f.zip", bytearray(buf.getvalue()))], "path string, content binary")
    lines = documents.zip_lines(files)
    assert [r.name for r in documents.zip_csv(lines, ["id", "name"]).orderBy("id").collect()] == ["x, y", "z"]
    assert documents.zip_json(lines, "id int").first()["id"] == 7
    assert documents.zip_lines(files, table_id="G99").select("member").distinct().collect()[0].member == "a/SA2_data.csv"


def test_unreadable_parquet_is_skipped(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "sub" / "Good.parquet"))
    (tmp_path / "bad.parquet").write_text("not parquet")
    loaded = tables.load_parquet_tree(spark, str(tmp_path))
    assert set(loaded.tables) == {"raw_good"} and set(loaded.failed) == {"raw_bad"}
    loaded.register()
    assert spark.table("raw_good").count() == 3


def test_census_records(spark):
    d = spark.createDataFrame([("101021007", "12.9", "NA", "38.5"), ("bad", "1", "1", "1")], "SA2_CODE string, Tot_P_P string, P_Tot_M string, Age_psns_med_yr string")
    r = records.census_records(d, 2021).collect()
    assert len(r) == 1 and (r[0].total_population, r[0].male_population, r[0].median_age) == (12, 0, 38.5)


@pytest.mark.parametrize("cols,rows,size,kind,want", [
    (["state_code"], 10001, 0, "auto", "column"), (["state_code"], 10000, 0, "auto", "none"), (["sa3_code"], 50001, 0, "auto", "column"),
    (["x"], 5, 10**9, "auto", "size"), (["last_updated_time"], 5, 0, "temporal", "period"), (["x"], 5, 0, "temporal", "none")])
def test_partition_choice(cols, rows, size, kind, want):
    assert writers.partition_choice(cols, rows, size, kind)["type"] == want


def test_read_back_sees_a_changed_cell(spark):
    a = spark.range(100).selectExpr("id", "cast(id as string) as s")
    b = a.withColumn("s", F.when(F.col("id") == 50, "x").otherwise(F.col("s")))
    r = writers.read_back_check(a, b).first()
    assert r.rows_match and not r.contents_match
    assert writers.read_back_check(a, a.select("s", "id")).first().contents_match


def test_gate_stops_the_job(spark):
    d = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    gate = quality.stage_metrics(d, [quality.empty("v")], ["v_missing"])
    with pytest.raises(RuntimeError, match="quality gate failed"):
        quality.require(gate)


def test_critical_values(spark):
    for df, want in ((1, 12.706), (3, 3.182), (10, 2.228), (30, 2.042), (1000, 1.962)):
        assert one(spark, stats.critical_t(F.lit(df))) == pytest.approx(want, abs=0.02)
    assert one(spark, stats.critical_chi2(F.lit(8))) == pytest.approx(15.507, abs=0.05)
    assert one(spark, stats.normal_tail(F.lit(1.959963985))) == pytest.approx(0.025, rel=1e-5)


def test_composite_index_skips_absent_parts(spark):
    null = F.lit(None).cast("double")
    assert one(spark, indicators.composite_health_index(F.lit(83.0), null, F.lit(1.0), null)) == pytest.approx(75.0)
    assert one(spark, indicators.composite_health_index(null, null, null, null)) is None
    assert one(spark, indicators.wellbeing_index(null, null, null)) == 50.0


def test_small_clusters_are_flagged(spark):
    rows = [(i, float(i % 3) * 10 + math.sin(i), float(i % 3) * 10 + math.cos(i)) for i in range(300)] + [(300 + i, 500.0 + i, -500.0) for i in range(3)]
    d = spark.createDataFrame(rows, "id int, a double, b double")
    bad = stats.cluster_scan(d, ["a", "b"]).filter("anomalous").select("id").toPandas()["id"].tolist()
    assert set(bad) >= {300, 301, 302} and len(bad) < 20


def test_clusters_follow_all_values_of_a_vector(spark):
    """Groups that only the values after the fourth tell apart; rows without a whole vector go."""
    group = lambda i: 2 if i >= 290 else i % 2
    value = lambda i, j: math.sin(7 * i + j) * (1 if j < 4 else 0.1) + (0 if j < 4 else 10.0 * ((j + group(i)) % 3))
    rows = [(i, [value(i, j) for j in range(64)]) for i in range(300)]
    d = spark.createDataFrame([*rows, (300, None), (301, [None] * 64)], "vec_id long, embedding array<float>")
    base = scratch_path(spark, "vectors")
    d.write.parquet(f"{base}/embeddings.parquet")
    got = runner(all_queries()["cluster_scan"])(spark, base).collect()
    assert sorted(r["vec_id"] for r in got) == list(range(300))
    held = {}
    for r in got:
        held.setdefault(r["cluster"], set()).add(group(r["vec_id"]))
    assert all(len(x) == 1 for x in held.values())
    assert all(r["anomalous"] and r["cluster_size"] <= 10 for r in got if r["vec_id"] >= 290)


def test_stream_appends_what_the_batch_counts(spark):
    base = scratch_path(spark, "stream")
    rows = [(f"2024-01-0{1 + i % 4} 0{i % 10}:00:00", "click" if i % 2 else "view", float(i)) for i in range(200)]
    d = spark.createDataFrame(rows, "ts string, kind string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    d.repartition(4).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(d.schema).parquet(f"{base}/in")
    usage.upsert_daily_usage(stream, f"{base}/out", f"{base}/state", ts="ts", kind="kind", value="value").awaitTermination()
    got = usage.latest_usage(spark.read.parquet(f"{base}/out")).orderBy("day", "kind").collect()
    want = usage.daily_usage(d, "ts", "kind", "value").orderBy("day", "kind").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    usage.write_daily_usage(spark.readStream.schema(d.schema).parquet(f"{base}/in"), f"{base}/append", f"{base}/state2", ts="ts", kind="kind", value="value").awaitTermination()
    closed = {tuple(r) for r in spark.read.parquet(f"{base}/append").collect()}
    assert closed <= {tuple(r) for r in want} and closed


def test_untyped_null_column_survives_ordering(split):
    from zonalis.operators.ordering import positions
    d = split.range(20).withColumn("nothing", F.lit(None))
    out = positions(d, ["id"])
    assert out.select("id", "nothing").columns == ["id", "nothing"] and out.count() == 20


def test_export_limits(spark):
    d = spark.createDataFrame([(1, [1, 2])], "id int, xs array<int>")
    assert quality.export_limits(d, "csv") == ["nested column xs"]
    assert quality.export_limits(d, "geojson") == ["no geometry"]
    assert quality.export_limits(d.withColumn("latitude", F.lit(1.0)), "geojson") == []


def test_scratch_is_dropped(spark):
    from zonalis.session import clear_scratch, materialise
    kept = materialise(spark.range(3), "t")
    assert kept.count() == 3
    assert clear_scratch(spark)


def test_mixed_versions(spark):
    from zonalis.operators import mapping
    v1 = spark.createDataFrame([("101021007", 212.0, 1)], "area_code string, temp_max double, quality_code int")
    v2 = spark.createDataFrame([("201021001", 20.0, "2.0.0")], "geographic_id string, max_temperature double, schema_version string")
    rows = {r.geographic_id: r for r in mapping.read_mixed_versions(v1, v2, fahrenheit=["max_temperature"]).collect()}
    assert rows["101021007"].max_temperature == 100.0 and rows["101021007"].quality_flag == "Y"
    assert rows["201021001"].quality_flag is None


def test_keyset_pages_cover_the_table(spark):
    from zonalis.operators import mapping
    d = spark.range(25).withColumnRenamed("id", "k")
    seen, last = [], None
    while rows := mapping.page_after(d, "k", last, 10).collect():
        seen += [r.k for r in rows]
        last = seen[-1]
    assert seen == list(range(25))


def test_employment_imputed_before_zero_fill(spark):
    rows = [("101021001", 10, 4), ("101021002", 30, 8), ("101021003", 5, None)]
    d = spark.createDataFrame(rows, "geographic_id string, labour_force_pop int, unemployed int")
    d = census.with_levels(d)
    got = {r.geographic_id: r.unemployed for r in census.employment(d, impute_first=True).collect()}
    assert got["101021003"] == 8
    assert {r.geographic_id: r.unemployed for r in census.employment(d).collect()}["101021003"] == 0


def test_nearest_station_in_a_crowded_city(split):
    import numpy as np
    rng = np.random.default_rng(3)
    st = [(i, 151.0 + float(x) / 100, -33.0 + float(y) / 100) for i, (x, y) in enumerate(rng.random((150, 2)))]
    st += [(1000 + i, 113.0 + float(x) * 40, -43.0 + float(y) * 30) for i, (x, y) in enumerate(rng.random((50, 2)))]
    pts = [(i, 151.0 + float(x) / 100, -33.0 + float(y) / 100) for i, (x, y) in enumerate(rng.random((60, 2)))]
    pts += [(100 + i, 113.0 + float(x) * 40, -43.0 + float(y) * 30) for i, (x, y) in enumerate(rng.random((40, 2)))]
    a = split.createDataFrame(pts, "id int, lon double, lat double")
    s = split.createDataFrame(st, "sid int, slon double, slat double")
    got = {r.id: r.station_id for r in spatial.nearest_station(a, s, area=("id", "lon", "lat"), station=("sid", "slon", "slat")).collect()}

    def km(p, q):
        la1, la2, dlo = math.radians(p[2]), math.radians(q[2]), math.radians(q[1] - p[1])
        h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin(dlo / 2) ** 2
        return 2 * math.asin(math.sqrt(h))

    assert got == {p[0]: min(st, key=lambda q: (km(p, q), q[0]))[0] for p in pts}


def test_coverage_totals_are_those_of_all_rows(spark):
    d = spark.createDataFrame([("a", "N", 40.0, 1), ("b", "N", 50.0, 9), ("c", "S", 20.0, 1)], "area string, state string, people double, score int")
    states = spark.createDataFrame([("N",), ("S",), ("W",)], "state string")
    kw = {"expected_population": 110, "expected_areas": 3}
    row = aggregates.coverage_totals(d, "area", "state", "people", states, covered=F.col("score") > 5, **kw).first()
    assert (row.population, row.areas, row.missing_states, row.population_ok, row.areas_ok) == (110.0, 3, 2, True, True)
    assert aggregates.coverage_totals(d, "area", "state", "people", states, **kw).first().missing_states == 1


def test_coverage_query_totals_all_customers(spark):
    found = runner(all_queries()["coverage_totals"])(spark, SMALL).first()
    whole = spark.read.parquet(f"{SMALL}/customer.parquet").agg(F.round(F.sum("c_acctbal"), 2).alias("s"), F.count("c_custkey").alias("n")).first()
    assert (found.population, found.areas) == (whole.s, whole.n)
