"""Delimited text, with or without lines before the header."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.operators.mapping import first_usable


# A comma outside double quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All columns as text; typing is the normaliser's work, so one bad cell costs
    a cell, not a file.  Give `columns` to skip reading headers up front."""
    reader = spark.read.option("header", True).option("escape", '"')
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(path)


def map_fields(df: DataFrame, candidates: Mapping[str, Sequence[str]], blanks: Sequence[str] = ("",)) -> DataFrame:
    """Each target takes its first usable source field."""
    return df.select(*[first_usable(df, cs, blanks).alias(t) for t, cs in candidates.items()])


def read_csv_after_preamble(spark: SparkSession, path: str, columns: Sequence[str], *,
                            date_column: str = "Date", start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows after the first line that starts with 'Date' or holds 'YYYY-MM-DD'.

    A file whose header is its first line, or that has none, gives nothing.  Lines
    are read in splits; a line's place is its split offset and row within it.  Dates
    compare as text.  Adds `_file`.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"))
    at = F.struct("_block", "_row")
    is_header = F.col("value").startswith("Date") | F.col("value").contains("YYYY-MM-DD")
    headers = lines.groupBy("_file").agg(
        F.min(at).alias("_first"), F.min(F.when(is_header, at)).alias("_at"),
        F.min_by("value", F.when(is_header, at)).alias("_header"))

    def unquoted(text):
        cells = F.split(text, _COMMA, -1)
        return F.transform(cells, lambda c: F.regexp_replace(F.regexp_replace(F.trim(c), r'^"|"$', ""), '""', '"'))

    # A header is split once, in its file's row: what lines take from it is where each column stands, -1 if nowhere.
    named = headers.filter(F.col("_at") > F.col("_first")).withColumn("_names", unquoted("_header"))
    headers = named.select("_file", "_at", F.array(*[F.array_position("_names", F.lit(c)).cast("int") - 1 for c in columns]).alias("_places"))
    body = lines.join(headers, "_file").filter(at > F.col("_at")).filter(F.trim("value") != "")
    packed = body.select("_file", "_places", unquoted("value").alias("_cells"))
    places = [F.get("_places", F.lit(i)) for i in range(len(columns))]
    out = packed.select("_file", *[F.when(p >= 0, F.get("_cells", p)).alias(c) for c, p in zip(columns, places)])
    if start:
        out = out.filter(F.col(date_column).isNull() | (F.col(date_column) >= start))
    if end:
        out = out.filter(F.col(date_column).isNull() | (F.col(date_column) <= end))
    return out
