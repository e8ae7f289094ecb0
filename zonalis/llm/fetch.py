"""Fetching the texts of a few documents from all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from zonalis.session import materialise

_SCAN = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"


def texts_of(docs: DataFrame, wanted: DataFrame, keys: list[str], then: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of docs that `wanted` (a written table) names by `keys`, given to `then` and written.

    Spark's run-time Bloom filter drops most other rows before the shuffle; by default it is
    tried for scans of 10 GB or more, here from 16 MB on.  `wanted` has a column `blocks`
    of 1 or more: Spark tries the filter only for a side with a condition.
    """
    spark = docs.sparkSession
    before = spark.conf.get(_SCAN)
    spark.conf.set(_SCAN, "16m")
    try:
        return materialise(then(docs.join(wanted.filter(wanted["blocks"] >= 1), keys)), "texts")
    finally:
        spark.conf.set(_SCAN, before)
