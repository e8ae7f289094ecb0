"""The look-back report kept by a stream against the same report from a batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from zonalis.session import scratch_path
from zonalis.streaming import usage

SCHEMA = "ts timestamp, kind string, value double, at int"


def events(seed, n):
    rng = random.Random(seed)
    start = dt.datetime(2024, 2, 25, 12)
    out = []
    for i in range(n):
        when = start + dt.timedelta(hours=rng.randrange(24 * 20))
        out.append((when, rng.choice(["view", "click", "click", None]), None if rng.random() < 0.2 else float(rng.randrange(9)), i % 6))
    return out


def brute(rows, days):
    by = {}
    for when, kind, value, _ in rows:
        by.setdefault((when.date(), kind), []).append(value)
    out = {}
    for day, kind in by:
        held = [v for (d, k), vs in by.items() if k == kind and 0 <= (day - d).days < days for v in vs]
        known = [v for v in held if v is not None]
        out[day, kind] = (len(held), sum(known) / len(known) if known else None)
    return out


@pytest.mark.parametrize("order", ["sorted", "shuffled"])
def test_stream_equals_batch(spark, order):
    """Files come in order of time or all mixed up, so that most rows are late."""
    base, rows = scratch_path(spark, "lookback"), events(3, 400)
    if order == "sorted":
        rows = [(*r[:3], i * 6 // len(rows)) for i, r in enumerate(sorted(rows, key=lambda r: r[0]))]
    df = spark.createDataFrame(rows, SCHEMA)
    path = {k: f"{base}/{k}" for k in ("in", "out", "state")}
    read = lambda: spark.readStream.schema(df.drop("at").schema).option("maxFilesPerTrigger", 1).parquet(path["in"])
    for first in (True, False):  # a stream that stops goes on where it was
        df.filter(F.col("at") < 3 if first else F.col("at") >= 3).drop("at").repartition(3).write.mode("append").parquet(path["in"])
        usage.upsert_lookback(read(), path["out"], path["state"], ts="ts", kind="kind", value="value", days=7, late="60 days").awaitTermination()
        seen = [r for r in rows if (r[3] < 3) or not first]
        want = brute(seen, 7)
        got = {(r["day"], r["kind"]): (r["n"], r["mean"]) for r in usage.read_lookback(spark, path["out"]).collect()}
        assert got.keys() == want.keys()
        for key, (n, mean) in want.items():
            assert got[key][0] == n and (got[key][1] is None if mean is None else abs(got[key][1] - mean) < 1e-9), key
    batch = usage.lookback(usage.daily_totals(df, "ts", "kind", "value"), 7).collect()
    assert {(r["day"], r["kind"]): r["n"] for r in batch} == {k: v[0] for k, v in want.items()}


def test_rows_later_than_the_watermark_are_left_out(spark):
    base = scratch_path(spark, "late")
    day = lambda d: dt.datetime(2024, 1, d, 12)
    for i, rows in enumerate(([(day(20), "a", 1.0)], [(day(21), "a", 1.0)], [(day(2), "a", 1.0), (day(20), "a", 3.0)])):
        spark.createDataFrame(rows, "ts timestamp, kind string, value double").coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("ts timestamp, kind string, value double").parquet(f"{base}/in")
        usage.upsert_lookback(stream, f"{base}/out", f"{base}/state", ts="ts", kind="kind", value="value", days=3, late="2 days").awaitTermination()
    got = {r["day"].day: (r["n"], r["mean"]) for r in usage.read_lookback(spark, f"{base}/out").collect()}
    assert got == {20: (2, 2.0), 21: (3, 5 / 3)}


def test_nothing_was_written(spark):
    assert usage.read_lookback(spark, scratch_path(spark, "none")).count() == 0
