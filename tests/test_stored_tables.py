"""Exports as whole documents, merges that spare partitions, and pages read by index."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from zonalis.operators import mapping
from zonalis.sinks import writers
from zonalis.sources import documents


def parts(path):
    return sorted(f for f in glob.glob(f"{path}/**/part-*", recursive=True))


def shapes(spark, n):
    ring = F.array(*[F.array(F.col("id") + a, F.lit(b)) for a, b in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0))])
    return spark.range(0, n, 1, 5).select(
        F.format_string("%03d", "id").alias("code"), F.when(F.col("id") == 3, None).otherwise(F.lit('a "b", c')).alias("name"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))


@pytest.mark.parametrize("files", [None, 2])
def test_every_file_is_one_feature_collection(spark, tmp_path, files):
    path = f"{tmp_path}/g"
    writers.write_geojson(shapes(spark, 23), path, geometry="geometry", files=files)
    seen = []
    for f in parts(path):
        doc = json.load(open(f))
        assert doc["type"] == "FeatureCollection"
        seen += [x["properties"]["code"] for x in doc["features"]]
    assert sorted(seen) == [f"{i:03}" for i in range(23)] and len(parts(path)) == (files or 5)
    for how in ({}, {"lined": True}):
        back = documents.read_features(spark, path, "code:string,name:string", **how).orderBy("code").collect()
        assert [r["code"] for r in back] == sorted(seen) and back[3]["name"] is None and back[4]["name"] == 'a "b", c'
        assert back[7]["geometry"]["coordinates"][0][1] == [8.0, 0.0]
    assert writers.read_export(spark, "geojson", path).count() == 23


def test_empty_tables_make_valid_documents(spark, tmp_path):
    writers.write_geojson(shapes(spark, 1).filter("code = 'none'"), f"{tmp_path}/g", geometry="geometry")
    writers.write_json_documents(spark.range(0).withColumn("s", F.lit("x")), f"{tmp_path}/j", facts={"n": 1, "data": "ignored"}, files=1)
    assert all(json.load(open(f))["features"] == [] for f in parts(f"{tmp_path}/g"))
    assert [json.load(open(f)) for f in parts(f"{tmp_path}/j")] == [{"n": 1, "data": []}] and parts(f"{tmp_path}/g")


def test_an_aborted_export_leaves_nothing(spark, tmp_path):
    bad = shapes(spark, 40).withColumn("name", F.when(F.col("code") == "033", F.raise_error(F.lit("stop")).cast("string")).otherwise("x"))
    for write in (lambda p: writers.write_geojson(bad, p, geometry="geometry"), lambda p: writers.write_json_documents(bad.drop("geometry"), p)):
        path = f"{tmp_path}/aborted{len(os.listdir(tmp_path))}"
        with pytest.raises(Exception, match="stop"):
            write(path)
        assert parts(path) == [] and not os.path.exists(f"{path}/_SUCCESS")


def test_json_documents(spark, tmp_path):
    path = f"{tmp_path}/j"
    writers.write_json_documents(spark.range(0, 9, 1, 3).select("id", F.lit(None).cast("string").alias("s")), path, listed="records", facts={"of": "é"})
    docs = [json.load(open(f)) for f in parts(path)]
    assert sorted(r["id"] for d in docs for r in d["records"]) == list(range(9)) and all(d["of"] == "é" and d["records"][0]["s"] == "" for d in docs)


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, day string, v double")


def stored(spark, path):
    return sorted(tuple(r) for r in spark.read.schema("id long, v double, day string").parquet(path).select("id", "day", "v").collect())


def test_merge_spares_other_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    start = [(i, f"0{i % 3}", float(i)) for i in range(30)]
    assert writers.merge_into(spark, path, [table(spark, start)], ["id", "day"], ["day"]) == [("00",), ("01",), ("02",)]
    assert stored(spark, path) == sorted(start)
    before = parts(path)
    one, two = table(spark, [(1, "01", 100.0), (77, "01", 7.0)]), table(spark, [(1, "01", 200.0), (88, "09", 8.0), (5, "0'9", 5.0)])
    assert writers.merge_into(spark, path, [one, two], ["id", "day"], ["day"]) == [("0'9",), ("01",), ("09",)]
    want = sorted([r for r in start if r[0] != 1] + [(1, "01", 200.0), (77, "01", 7.0), (88, "09", 8.0), (5, "0'9", 5.0)])
    assert stored(spark, path) == want
    kept = [f for f in before if "day=01" not in f]
    assert set(kept) <= set(parts(path)) and len(kept) and not [f for f in before if "day=01" in f and f in parts(path)]
    writers.merge_into(spark, path, [one, two], ["id", "day"], ["day"])
    assert stored(spark, path) == want and set(kept) <= set(parts(path))
    assert writers.merge_into(spark, path, [one.limit(0)], ["id", "day"], ["day"]) == []
    with pytest.raises(ValueError):
        writers.merge_into(spark, path, [one], ["id"], ["day"])


def test_merge_reads_touched_partitions_only(spark, tmp_path):
    path = f"{tmp_path}/t"
    writers.merge_into(spark, path, [table(spark, [(i, f"{i % 4}", 1.0) for i in range(40)])], ["id", "day"], ["day"])
    plan = spark.read.parquet(path).filter((F.col("day").cast("string") == F.lit("2")))
    assert len(plan.inputFiles()) == 4 and "PartitionFilters: [isnotnull" in plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")


def test_a_page_is_one_range(spark, tmp_path):
    path = f"{tmp_path}/p"
    rows = [(i * 37 % 5_003, f"k{i % 11:02}", i) for i in range(5_003)]
    df = spark.createDataFrame(rows, "n int, k string, id long").repartition(6)
    mapping.write_pages(df, path, ["k", "n"], 20)
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    for page in (0, 1, 123, 249):
        got = mapping.read_page(spark, path, ["k", "n"], page)
        assert [tuple(r) for r in got.select("n", "k", "id").collect()] == order[20 * page : 20 * page + 20]
    last = mapping.read_page(spark, path, ["k", "n"], 250).select("n", "k", "id").collect()
    assert [tuple(r) for r in last] == order[5_000:]
    assert mapping.read_page(spark, path, ["k", "n"], 251).count() == 0
    plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(k," in plan and "LessThanOrEqual(k," in plan and "Offset" not in plan
