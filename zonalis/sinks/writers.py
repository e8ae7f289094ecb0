"""Exports: formats, partitioning, web narrowing, versions and read-back."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.functions import geo
from zonalis.session import materialise

CODEC = "zstd"


def narrow_integers(df: DataFrame) -> DataFrame:
    """Integer columns in the least width that holds them, by one min/max scan."""
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegerType, T.LongType))]
    if not ints:
        return df
    row = df.agg(*[f.alias(f"{n}_{c}") for c in ints for n, f in (("lo", F.min(c)), ("hi", F.max(c)))]).first()
    casts = {}
    for c in ints:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        if lo is None:
            continue
        kind = next((k for k, bits in (("byte", 7), ("short", 15), ("int", 31)) if -(1 << bits) <= lo and hi < 1 << bits), "long")
        casts[c] = F.col(c).cast(kind)
    return df.withColumns(casts)


def write_parquet(df: DataFrame, path: str, *, codec: str = CODEC, narrow: bool = False, mode: str = "error") -> None:
    out = narrow_integers(df) if narrow else df
    out.write.mode(mode).option("compression", codec).parquet(path)


def csv_columns(df: DataFrame) -> list[Column]:
    """Line breaks to spaces, floats with six decimals, times to the second."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.regexp_replace(c, r"[\r\n]", " ")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(c.isNotNull(), F.format_string("%.6f", c.cast("double")))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return out


def write_csv(df: DataFrame, path: str, *, compress: bool = False, mode: str = "error") -> None:
    w = df.select(*csv_columns(df)).write.mode(mode).option("header", True).option("escape", '"')
    (w.option("compression", "gzip") if compress else w).csv(path)


def json_columns(df: DataFrame) -> list[Column]:
    """ISO times, and nulls of text columns as empty text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))
        elif isinstance(f.dataType, T.DateType):
            c = F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
        elif isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))
        out.append(c.alias(f.name))
    return out


def write_json(df: DataFrame, path: str, *, compress: bool = False, mode: str = "error") -> None:
    """JSON lines; every field present."""
    w = df.select(*json_columns(df)).write.mode(mode).option("ignoreNullFields", "false")
    (w.option("compression", "gzip") if compress else w).json(path)


def one_document_a_file(rows: DataFrame, head: str, tail: str) -> DataFrame:
    """Lines of text (`value`) between head and tail, joined by commas, for every partition: written as
    text, each file is one document.  A task streams its lines, and Spark commits its file
    as a whole or not at all."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = lambda *values: pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])
        yield line(head)
        first = True
        for batch in batches:
            if len(batch):
                lead = pa.array(["" if first and not i else "," for i in range(len(batch))], pa.string())
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(lead, batch.column(0).cast(pa.string()), "")], names=["value"])
                first = False
        yield line(tail)

    return rows.select("value").mapInArrow(wrapped, "value string")


def write_json_documents(df: DataFrame, path: str, *, listed: str = "data", facts: Mapping[str, object] | None = None, files: int | None = None,
                         mode: str = "error") -> None:
    """Files that are one JSON object each: `facts`, and the records in a list named `listed`.
    `files` says how many; an empty table makes documents of no records."""
    opening = "".join(f"{json.dumps(k)}:{json.dumps(v)}," for k, v in (facts or {}).items() if k != listed)
    rows = df.select(F.to_json(F.struct(*json_columns(df)), {"ignoreNullFields": "false"}).alias("value"))
    rows = rows.repartition(files) if files else rows
    one_document_a_file(rows, "{" + opening + json.dumps(listed) + ":[", "]}").write.mode(mode).text(path)


def _first(df: DataFrame, parts: Sequence[str]) -> str | None:
    return next((c for c in df.columns if any(p in c.lower() for p in parts)), None)


def geojson_lines(df: DataFrame, *, geometry: str | None = None, places: int = 6) -> DataFrame:
    """One GeoJSON feature per row: polygon geometry when named, else a point from
    the first latitude- and longitude-like columns; properties as number or text."""
    lat, lon = _first(df, ["lat"]), _first(df, ["lon", "lng"])
    if geometry:
        shape = F.when(F.col(geometry).isNotNull(), F.struct(
            F.col(geometry)["type"].alias("type"),
            F.transform(F.col(geometry)["coordinates"], lambda ring: geo.rounded_ring(ring, places)).alias("coordinates")))
        used = {geometry}
    elif lat and lon:
        shape = F.struct(F.lit("Point").alias("type"),
                         F.array(F.round(F.col(lon), places), F.round(F.col(lat), places)).alias("coordinates"))
        used = {lat, lon}
    else:
        shape = F.struct(F.lit("Point").alias("type"), F.array(F.lit(0.0), F.lit(0.0)).alias("coordinates"))
        used = set()
    props = []
    for f in df.schema.fields:
        if f.name in used:
            continue
        number = isinstance(f.dataType, T.NumericType)
        props.append(F.col(f.name).cast("double" if number else "string").alias(f.name))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*props).alias("properties"), shape.alias("geometry"))
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


COLLECTION = ('{"type":"FeatureCollection","features":[', "]}")


def write_geojson(df: DataFrame, path: str, *, geometry: str | None = None, sequence: bool = False, files: int | None = None, mode: str = "error") -> None:
    """Every file is one FeatureCollection, a feature a line; with `sequence`, features only,
    as a GeoJSON text sequence.  `files` says how many."""
    rows = geojson_lines(df, geometry=geometry)
    rows = rows.repartition(files) if files else rows
    (rows if sequence else one_document_a_file(rows, *COLLECTION)).write.mode(mode).text(path)


def write_by_column(df: DataFrame, path: str, columns: Sequence[str], *, mode: str = "error") -> None:
    """One folder per value.  The rebalance hint gathers each value into few files
    and lets Spark split a value that outgrows a partition."""
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)


def write_by_period(df: DataFrame, path: str, column: str, *, period: str = "month", mode: str = "error") -> None:
    pattern = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}[period]
    write_by_column(df.withColumn("period", F.date_format(column, pattern)), path, ["period"], mode=mode)


def hash_bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def write_by_hash(df: DataFrame, path: str, key: Sequence[str], buckets: int, *, mode: str = "error") -> None:
    write_by_column(df.withColumn("bucket", hash_bucket(key, buckets)), path, ["bucket"], mode=mode)


def write_by_count(df: DataFrame, path: str, rows: int, *, mode: str = "error") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", rows).parquet(path)


def partition_choice(columns: Sequence[str], rows: int, size_bytes: int, kind: str = "auto") -> dict:
    """How to cut an export of this shape."""
    none = {"type": "none"}
    if kind == "auto":
        if "state_code" in columns and rows > 10_000:
            return {"type": "column", "column": "state_code"}
        if "sa3_code" in columns and rows > 50_000:
            return {"type": "column", "column": "sa3_code"}
        return {"type": "size", "max_rows": 100_000} if size_bytes > 100_000_000 else none
    if kind in ("state", "sa3"):
        return {"type": "column", "column": f"{kind}_code"}
    if kind == "temporal":
        date = next((c for c in columns if "date" in c.lower() or "time" in c.lower()), None)
        return {"type": "period", "column": date, "period": "month"} if date else none
    return {"type": "size", "max_rows": 100_000} if kind == "size" else none


_WIDTHS = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "date": 4}


def measured_choice(df: DataFrame, kind: str = "auto") -> dict:
    """The choice for df as it is: its rows and the bytes of its values, counted in one scan."""
    size = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
        else:
            size = size + F.lit(_WIDTHS.get(f.dataType.typeName(), 8))
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return partition_choice(df.columns, row["rows"], row["bytes"], kind)


def write_partitioned(df: DataFrame, path: str, choice: Mapping, *, mode: str = "error") -> None:
    kind = choice["type"]
    if kind == "column" and choice["column"] in df.columns:
        write_by_column(df, path, [choice["column"]], mode=mode)
    elif kind == "period" and choice["column"] in df.columns:
        write_by_period(df, path, choice["column"], period=choice["period"], mode=mode)
    elif kind == "size":
        write_by_count(df, path, choice["max_rows"], mode=mode)
    else:
        df.write.mode(mode).parquet(path)


# Name parts of coordinate columns.
COORDINATE_PARTS = {"lat", "latitude", "lon", "lng", "longitude", "x", "y"}


def for_web(df: DataFrame) -> DataFrame:
    """Doubles as floats, rounded to three places unless a part of their name is a coordinate's;
    sorted by area code, else by postcode."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            coordinate = COORDINATE_PARTS.intersection(re.split("[^a-z]+", f.name.lower()))
            casts[f.name] = (F.col(f.name) if coordinate else F.round(f.name, 3)).cast("float")
    out = df.withColumns(casts)
    key = next((k for k in ("sa2_code", "postcode") if k in df.columns), None)
    return out.orderBy(key) if key else out


WRITERS: dict[str, Callable] = {
    "parquet": write_parquet, "csv": write_csv, "json": write_json, "geojson": write_geojson,
}


def export_formats(df: DataFrame, base: str, formats: Sequence[str]) -> dict[str, str]:
    """path or error per format; one failure does not stop the rest.  With parquet
    among them, the other formats are made from that copy, so df is computed once."""
    done: dict[str, str] = {}
    source = df
    for name in sorted(formats, key=lambda f: f != "parquet"):
        path = f"{base}/{name}"
        try:
            WRITERS[name](source, path)
            done[name] = path
            if name == "parquet":
                source = df.sparkSession.read.schema(df.schema).parquet(path)
        except Exception as e:
            done[name] = f"failed: {type(e).__name__}: {str(e).strip().splitlines()[0] if str(e).strip() else 'no message'}"
    return done


def with_version(df: DataFrame, version: str, created_at: str, loader: str) -> DataFrame:
    return df.withColumn("_version", F.struct(F.lit(version).alias("version"), F.lit(created_at).alias("created_at"),
                                              F.lit(loader).alias("loader_id")))


def merge_deltas(base: DataFrame, deltas: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Base and deltas in creation order; the latest row of a key wins."""
    rows = base.withColumn("_seq", F.lit(0))
    for i, d in enumerate(deltas, 1):
        rows = rows.unionByName(d.withColumn("_seq", F.lit(i)), allowMissingColumns=True)
    rest = [c for c in rows.columns if c not in (*key, "_seq")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "_seq").alias("_r")).select(*key, "_r.*")


def merge_into(spark: SparkSession, path: str, deltas: Sequence[DataFrame], key: Sequence[str], partition: Sequence[str]) -> list[tuple]:
    """Merge deltas, in creation order, into the parquet table at path and return the partitions
    that were written.

    The table is partitioned by `partition`, columns of the key, so that a row never moves.  Only the partitions
    that deltas touch are read, merged, written aside and put in place of the old
    ones; the files of all others stay.  Doing it again changes nothing.  A table that is not there is made.
    """
    if not deltas or not set(partition) <= set(key) or not partition:
        raise ValueError("deltas are needed, and partition columns that are part of the key")
    rows = deltas[0]
    for d in deltas[1:]:
        rows = rows.unionByName(d, allowMissingColumns=True)
    # As many as folders, which the driver lists anyhow.
    touched = sorted((tuple(r) for r in rows.select(*partition).distinct().collect()), key=str)
    if not touched:
        return []
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    try:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
        # The names of folders are read as the deltas' types, not as what they look like.
        base = spark.read.schema(T.StructType([T.StructField(f.name, kinds[f.name] if f.name in partition else f.dataType) for f in found])).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        base = rows.limit(0)
    mine = None
    for values in touched:
        one = None
        for c, v in zip(partition, values, strict=True):
            same = F.col(c).isNull() if v is None else F.col(c) == F.lit(v)
            one = same if one is None else one & same
        mine = one if mine is None else mine | one
    merged = materialise(merge_deltas(base.filter(mine), deltas, key), "merged")
    merged.repartition(*partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)
    return touched


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and two order-free sums of row hashes: equal contents, no shuffle."""
    h = F.xxhash64(*(columns or sorted(df.columns)))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("hash_xor"),
                  F.coalesce(F.sum(F.pmod(h, F.lit(2147483647))), F.lit(0)).alias("hash_sum"))


def read_back_check(original: DataFrame, exported: DataFrame) -> DataFrame:
    """Row count, column count, column set and contents of an export against its source."""
    same_columns = set(original.columns) == set(exported.columns)
    a, b = fingerprint(original), None
    if same_columns:
        types = {f.name: f.dataType for f in original.schema.fields}
        b = fingerprint(exported.select(*[F.col(c).cast(types[c]).alias(c) for c in original.columns]))
    else:
        b = exported.agg(F.count(F.lit(1)).alias("rows")).withColumns({"hash_xor": F.lit(None), "hash_sum": F.lit(None)})
    from zonalis.operators.common import attach_row
    both = attach_row(a, b.toDF("rows2", "xor2", "sum2"))
    return both.select(
        "rows", (F.col("rows") == F.col("rows2")).alias("rows_match"),
        F.lit(len(original.columns) == len(exported.columns)).alias("column_count_match"), F.lit(same_columns).alias("columns_match"),
        F.coalesce((F.col("hash_xor") == F.col("xor2")) & (F.col("hash_sum") == F.col("sum2")), F.lit(False)).alias("contents_match"))


def export_metadata(df: DataFrame) -> DataFrame:
    """Per column: type, null %, distinct values, numeric min/max/mean, longest text
    and five smallest values, from one counted long form."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    kinds = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"),
                               (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("num"))
                      for c in df.columns])
    counts = df.select(F.inline(cells)).groupBy("column", "text").agg(F.count(F.lit(1)).alias("k"), F.any_value("num").alias("num"))
    stats = counts.groupBy("column").agg(
        F.sum("k").alias("rows"), (F.coalesce(F.sum(F.when(F.col("text").isNull(), F.col("k"))), F.lit(0)) / F.sum("k") * 100).alias("null_pct"),
        F.count("text").alias("distinct_values"), F.min("num").alias("min"), F.max("num").alias("max"),
        (F.sum(F.col("num") * F.col("k")) / F.sum(F.when(F.col("num").isNotNull(), F.col("k")))).alias("mean"),
        F.max(F.length("text")).alias("max_length"))
    from pyspark.sql import Window
    w = Window.partitionBy("column").orderBy("text")
    few = counts.filter("text IS NOT NULL").withColumn("i", F.row_number().over(w)).filter("i <= 5").groupBy("column").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda s: s["text"]), "|").alias("samples"))
    return stats.join(few, "column", "left").withColumn("type", kinds[F.col("column")])


def export_quality(df: DataFrame) -> DataFrame:
    """0.6·cell completeness % + 0.4·(100, or 90 when any row repeats)."""
    filled = None
    for c in df.columns:
        one = F.col(c).isNotNull().cast("int")
        filled = one if filled is None else filled + one
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_k")).withColumn("_f", filled * F.col("_k"))
    s = g.agg(F.sum("_k").alias("rows"), F.sum("_f").alias("filled"), (F.sum("_k") - F.count(F.lit(1))).alias("duplicate_rows"))
    complete = F.col("filled") / (F.col("rows") * len(df.columns)) * 100
    return s.select("rows", "duplicate_rows", complete.alias("completeness_pct"),
                    (complete * 0.6 + F.when(F.col("duplicate_rows") > 0, 90).otherwise(100) * 0.4).alias("score"))


def entropy_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Shannon entropy in bits of each column's values, distinct ratio and flags."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text")) for c in columns])
    counts = df.select(F.inline(cells)).groupBy("column", "text").agg(F.count(F.lit(1)).alias("k"))
    k = F.when(F.col("text").isNotNull(), F.col("k"))
    n = F.sum(k)
    s = counts.groupBy("column").agg(
        (F.log2(n.cast("double")) - F.sum(k * F.log2(k.cast("double"))) / n).alias("entropy"),
        (F.count("text") / F.sum("k")).alias("distinct_ratio"), (F.sum("k") > F.coalesce(n, F.lit(0))).alias("has_nulls"),
        F.coalesce(F.max(F.length("text")) > 1000, F.lit(False)).alias("has_long_text"))
    return s.withColumn("repetitive", F.col("distinct_ratio") < 0.1)


def read_export(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        return spark.read.option("header", True).option("escape", '"').csv(path)
    if fmt == "json":
        return spark.read.json(path)
    return spark.read.text(path).filter(~F.col("value").isin(*COLLECTION))
