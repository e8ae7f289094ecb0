"""Parquet trees as named raw tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class LoadedTables:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)

    def register(self) -> None:
        for name, df in self.tables.items():
            df.createOrReplaceTempView(name)

    def counts(self) -> DataFrame:
        """(table, records); parquet answers a count from its footers."""
        parts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("table"), "records")
                 for n, df in self.tables.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def parquet_names(spark: SparkSession, folder: str) -> dict[str, str]:
    """raw_<stem> -> path of every parquet file or parquet folder under folder.

    Only names are listed; the part files of a parquet folder are one table.
    """
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
        .select(F.regexp_extract("path", r"^(.*?/([^/]+)\.parquet)(/|$)", 1).alias("root"),
                F.lower(F.regexp_extract("path", r"^(.*?/([^/]+)\.parquet)(/|$)", 2)).alias("stem"))
        .filter("stem <> ''").distinct()
    )
    return {f"raw_{row.stem}": row.root for row in listed.toLocalIterator()}


def load_parquet_tree(spark: SparkSession, folder: str) -> LoadedTables:
    """Every parquet table under folder; one that cannot be read is skipped and reported."""
    out = LoadedTables()
    for name, path in sorted(parquet_names(spark, folder).items()):
        try:
            out.tables[name] = spark.read.parquet(path)
        except Exception as e:  # a bad footer surfaces as the gateway's own error type
            out.failed[name] = str(e).splitlines()[0]
    return out
