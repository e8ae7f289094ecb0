"""Sorted partitions read as groups, and batches of bounded size, for functions given to mapInArrow."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """What is written meanwhile goes to Python workers in batches of about `size` bytes (one row
    at least).  By default 10,000 rows go at once, whose texts the executor holds outside its
    heap, up to three times while the buffer doubles, and the worker once more."""
    before = spark.conf.get(_BYTES)
    spark.conf.set(_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(_BYTES, before)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each run of equal keys (a long column without nulls), one table a
    run, from a partition that is sorted by it.  Holds one run at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if held and keys[lo] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = keys[lo]
    if held:
        yield pa.Table.from_batches(held)
