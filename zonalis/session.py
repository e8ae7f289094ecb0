"""Session settings and the few cluster-facing helpers every operator shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app: str = "zonalis", master: str | None = None, **conf) -> SparkSession:
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by spark.checkpoint.dir.

    A local session that names none uses a folder in its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/zonalis/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Drop what this application wrote to the shared folder, once its results are saved."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage through a table in the shared folder, so that losing an
    executor never recomputes (and so never renumbers) what was derived from it."""
    path = scratch_path(df.sparkSession, label)
    # Files hold no untyped nulls; such columns are put back on reading.
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    stored = df.drop(*void)
    stored.write.parquet(path)
    back = df.sparkSession.read.schema(stored.schema).parquet(path)
    return back.withColumns({c: F.lit(None) for c in void}).select(*df.columns) if void else back


def drop(*tables: DataFrame) -> None:
    """Delete written tables that nothing is read from any more."""
    for df in tables:
        jvm, conf, own = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration(), _own_scratch(df.sparkSession)
        for folder in {x.rpartition("/")[0] for x in df.inputFiles()}:
            if f"{jvm.org.apache.hadoop.fs.Path(own).toUri().getPath()}/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Meanwhile a query's shuffle files go when it ends; else they stay until the driver happens to collect
    its garbage.  Only for what is written: a query that runs again shuffles again."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)
