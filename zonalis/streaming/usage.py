"""The usage counts of an event table kept up to date as a stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def daily_usage(events: DataFrame, ts: str, kind: str, value: str, *, late: str = "1 day", window: str = "1 day") -> DataFrame:
    """(day, kind, n, mean): the same columns from a stream or a batch.  On a
    stream, state is kept for windows younger than the watermark only."""
    source = events.withWatermark(ts, late) if events.isStreaming else events
    g = source.groupBy(F.window(ts, window).alias("w"), F.col(kind).alias("kind"))
    out = g.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
    return out.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "kind", "n", "mean")


def write_daily_usage(stream: DataFrame, path: str, checkpoint: str, **kw):
    """Append finished windows to parquet; stops when the present files are read."""
    out = daily_usage(stream, **kw)
    return (out.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def upsert_daily_usage(stream: DataFrame, path: str, checkpoint: str, **kw):
    """Write every changed window of a batch to a folder of its own, numbered by batch:
    a repeated batch overwrites its own folder, so results stay exactly once."""
    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (daily_usage(stream, **kw).writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_usage(folder: DataFrame) -> DataFrame:
    """The newest version of each window in an upserted folder."""
    return folder.groupBy("day", "kind").agg(F.max_by(F.struct("n", "mean"), "batch").alias("r")).select("day", "kind", "r.*")


def daily_totals(events: DataFrame, ts: str, kind: str, value: str, *, late: str = "1 day") -> DataFrame:
    """(day, kind, n, known, total): events of a day, those with a value, and the sum of the values."""
    source = events.withWatermark(ts, late) if events.isStreaming else events
    g = source.groupBy(F.window(ts, "1 day").alias("w"), F.col(kind).alias("kind"))
    out = g.agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("known"), F.sum(value).alias("total"))
    return out.select(F.to_date("w.start").alias("day"), "kind", "n", "known", "total")


def lookback(daily: DataFrame, days: int) -> DataFrame:
    """(day, kind, n, mean) of the `days` days that end with day, for every day with events of the
    kind.  What the window sorts is a row per kind and day."""
    trailing = Window.partitionBy("kind").orderBy(F.unix_date("day")).rangeBetween(1 - days, 0)
    known = F.sum("known").over(trailing)
    mean = F.sum("total").over(trailing) / F.when(known > 0, known)
    return daily.select("day", "kind", F.sum("n").over(trailing).alias("n"), mean.alias("mean"))


def _newest(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The newest version of each (day, kind) in the numbered batches of a folder."""
    try:
        rows = spark.read.schema(f"{schema}, batch int").parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    rest = [c for c in rows.columns if c not in ("day", "kind", "batch")]
    return rows.groupBy("day", "kind").agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select("day", "kind", "_r.*")


_DAILY = "day date, kind string, n long, known long, total double"
_REPORT = "day date, kind string, n long, mean double"


def upsert_lookback(stream: DataFrame, path: str, checkpoint: str, *, ts: str, kind: str, value: str, days: int = 30, late: str = "1 day"):
    """Keep the look-back report of every day up to date under path, read by read_lookback.

    Spark keeps a day's totals as state until the watermark has passed it; a day that
    late rows change is written anew, and so are the reports of the days whose range holds it, no
    others.  Both go to folders numbered by batch, which a repeated batch overwrites.
    """

    def save(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        names = f"{path}/daily/batch={number}"
        batch.select(F.col("day"), F.col("kind").cast("string"), "n", "known", F.col("total").cast("double")).write.mode("overwrite").parquet(names)
        changed = spark.read.schema(_DAILY).parquet(names)
        ends = changed.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
        if ends["first"] is None:
            return
        near = F.col("day").between(F.date_sub(F.lit(ends["first"]), days - 1), F.date_add(F.lit(ends["last"]), days - 1))
        daily = _newest(spark, f"{path}/daily", _DAILY).filter(near)
        told = changed.select(F.explode(F.sequence("day", F.date_add("day", days - 1))).alias("_day"), F.col("kind").alias("_kind")).distinct()
        report = lookback(daily, days)
        report = report.join(told, (F.col("day") == F.col("_day")) & F.col("kind").eqNullSafe(F.col("_kind")), "left_semi")
        report.write.mode("overwrite").parquet(f"{path}/report/batch={number}")

    return (daily_totals(stream, ts, kind, value, late=late).writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_lookback(spark: SparkSession, path: str) -> DataFrame:
    """The newest report of every day."""
    return _newest(spark, f"{path}/report", _REPORT)
