"""JSON records, zip archives and GeoJSON features."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_records(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Records listed under `data`, else under `records`, of each JSON document."""
    listed = T.ArrayType(record)
    top = T.StructType([T.StructField("data", listed), T.StructField("records", listed)])
    docs = spark.read.schema(top).option("multiLine", True).json(path)
    return docs.select(F.inline(F.coalesce("data", "records")))


def read_zip_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")


def zip_lines(files: DataFrame, *, table_id: str | None = None, batch: int = 10000) -> DataFrame:
    """(path, member, line_no, line) of csv and json members of each archive.

    With `table_id`, only the first csv whose name holds it, else the first whose
    name holds SA2.  Lines stream out in batches; an archive is decoded where it lies.
    """

    def chosen(names: list[str]) -> list[str]:
        if table_id is None:
            return [n for n in names if n.lower().endswith((".csv", ".json"))]
        csvs = [n for n in names if n.endswith(".csv")]
        hits = [n for n in csvs if table_id.upper() in n.upper()] or [n for n in csvs if "SA2" in n.upper()]
        return hits[:1]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in chosen(z.namelist()):
                        with io.TextIOWrapper(z.open(name), encoding="utf-8", newline=None) as text:
                            rows: list[tuple] = []
                            for i, line in enumerate(text):
                                rows.append((path, name, i, line.rstrip("\n")))
                                if len(rows) == batch:
                                    yield pd.DataFrame(rows, columns=["path", "member", "line_no", "line"])
                                    rows = []
                            if rows:
                                yield pd.DataFrame(rows, columns=["path", "member", "line_no", "line"])

    return files.select("path", "content").mapInPandas(decode, "path string, member string, line_no long, line string")


def zip_csv(lines: DataFrame, columns: list[str]) -> DataFrame:
    """CSV members as text columns; the given names stand for the header line."""
    rows = lines.filter(F.lower("member").endswith(".csv") & (F.col("line_no") > 0))
    return rows.select("path", "member", F.from_csv("line", ", ".join(f"`{c}` string" for c in columns)).alias("r")).select(
        "path", "member", "r.*")


def zip_json(lines: DataFrame, schema: str) -> DataFrame:
    """JSON-lines members as rows."""
    rows = lines.filter(F.lower("member").endswith(".json"))
    return rows.select("path", "member", F.from_json("line", schema).alias("r")).select("path", "member", "r.*")


POLYGON = "struct<type:string,coordinates:array<array<array<double>>>>"


def read_features(spark: SparkSession, path: str, properties: str, *, sequence: bool = False, lined: bool = False) -> DataFrame:
    """Feature properties and polygon geometry.  A FeatureCollection is one document; `sequence` reads
    one feature per line, `lined` a collection with a feature a line between its first and last: both split."""
    feature = f"struct<type:string,properties:struct<{properties}>,geometry:{POLYGON}>"
    if sequence or lined:
        line = F.ltrim(F.col("value"), F.lit(",")) if lined else F.col("value")
        rows = spark.read.text(path).select(F.from_json(line, feature).alias("f"))
        rows = rows.filter(F.col("f.type") == "Feature") if lined else rows
    else:
        docs = spark.read.schema(f"type string, features array<{feature}>").option("multiLine", True).json(path)
        rows = docs.select(F.explode("features").alias("f"))
    return rows.filter("f IS NOT NULL").select("f.properties.*", F.col("f.geometry").alias("geometry"))


def parse_geometry(text: str, out: str = "geometry") -> list:
    """Geometry text as (parsed polygon, kept well-known text, invalid flag) columns."""
    g = F.from_json(F.col(text), POLYGON)
    is_json = F.col(text).startswith("{")
    wkt = F.when(~is_json & F.col(text).rlike(r"^[A-Z]+\s*\("), F.col(text))
    bad = F.when(is_json, g["type"].isNull() | g["coordinates"].isNull()).otherwise(wkt.isNull())
    return [F.when(is_json & ~bad, g).alias(out), wkt.alias(f"{out}_wkt"), F.coalesce(bad, F.lit(True)).alias(f"{out}_invalid")]
