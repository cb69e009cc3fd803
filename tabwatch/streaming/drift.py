"""Drift kept up to date from a stream of predictions.

Each micro-batch adds its value counts, by hour, under its own batch id; replaying a batch overwrites them. `fold` sums
older hours into days and older days into months, so what is kept grows with the months, not with the hours. Reports
are computed from the summed counts, with the same operators as in batch: a window is the whole units in it, and the
unit that it starts inside of is counted from the log.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwatch.operators import drift
from tabwatch.operators.reference import KEY
from tabwatch.schema import DatasetContract, MonitorConfig


def count_stream(
    stream: DataFrame, contract: DatasetContract, out: str, checkpoint: str, *, keys: Sequence[str] = ("model_version_id",),
    available_now: bool = True, interval: str = "1 minute",
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        hourly = batch.withColumn("start", F.date_trunc("hour", "created_at"))
        counts = drift.feature_counts(hourly, contract, [*keys, "start"])
        counts.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


@dataclass(frozen=True)
class Folds:
    """What is folded: batches up to `upto`; starts before `days` are days, those before `months` months."""

    upto: int
    days: datetime
    months: datetime


def _folds(spark: SparkSession, out: str) -> Folds | None:
    """The newest whole fold; its mark is written last."""
    try:
        mark = spark.read.schema("upto long, days timestamp, months timestamp").parquet(f"{out}-folds").orderBy(F.desc("upto"), F.desc("days")).first()
    except AnalysisException:  # nothing was folded yet
        return None
    return None if mark is None else Folds(*mark)


def _folded(out: str, folds: Folds) -> str:
    return f"{out}-folded/upto={folds.upto}-{folds.days:%Y%m%d}-{folds.months:%Y%m}"


def unit_counts(spark: SparkSession, out: str, folds: Folds | None) -> DataFrame:
    """(keys, start, feature, num, cat, n): the folded counts and those of the batches since."""
    batches = spark.read.parquet(out)
    if folds is None:
        return batches.drop("batch_id")
    later = batches.where(F.col("batch_id") > folds.upto).drop("batch_id")
    return spark.read.schema(later.schema).parquet(_folded(out, folds)).unionByName(later)


def fold(spark: SparkSession, out: str, *, as_of: datetime, keep_hours: int = 72, keep_days: int = 62, settled: bool = False, remove: bool = False) -> Folds:
    """Sums counts older than `keep_hours` into days and those older than `keep_days` into months.

    The newest batch may still be replayed and stays, unless the stream is stopped and `settled` says so. The fold takes
    the place of what it sums with its mark, in one step for readers; `remove` then deletes the folders it stands for.
    """
    before = _folds(spark, out)
    newest = spark.read.parquet(out).agg(F.max("batch_id")).first()[0]
    midnight = lambda t: t.replace(hour=0, minute=0, second=0, microsecond=0)
    days = midnight(as_of - timedelta(hours=keep_hours))
    months = midnight(as_of - timedelta(days=keep_days)).replace(day=1)
    if before is not None:  # a unit is never split again
        days, months = max(days, before.days), max(months, before.months)
    folds = Folds(int(newest) - (0 if settled else 1), days, min(days, months))
    if folds == before:
        return folds
    batches = spark.read.parquet(out)
    since = batches.where((F.col("batch_id") > (-1 if before is None else before.upto)) & (F.col("batch_id") <= folds.upto)).drop("batch_id")
    rows = since if before is None else spark.read.schema(since.schema).parquet(_folded(out, before)).unionByName(since)
    start = F.when(F.col("start") < F.lit(folds.months), F.date_trunc("month", "start")).when(F.col("start") < F.lit(days), F.date_trunc("day", "start")).otherwise(F.col("start"))
    keys = [c for c in rows.columns if c not in ("start", "n")]
    summed = rows.withColumn("start", start).groupBy("start", *keys).agg(F.sum("n").alias("n"))
    summed.write.mode("overwrite").parquet(_folded(out, folds))
    mark = spark.createDataFrame([(folds.upto, folds.days, folds.months)], "upto long, days timestamp, months timestamp")
    mark.coalesce(1).write.mode("append").parquet(f"{out}-folds")
    if remove:
        gone = [f"{out}/batch_id={r[0]}" for r in batches.where((F.col("batch_id") <= folds.upto) & (F.col("batch_id") < newest)).select("batch_id").distinct().collect()]
        for path in [*gone, *([] if before is None else [_folded(out, before)])]:
            _delete(spark, path)
    return folds


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def next_unit(since: Column, folds: Folds | None) -> Column:
    """The first start of a unit that is not before `since`."""
    def after(unit: str) -> Column:
        begun = F.date_trunc(unit, since)
        return F.when(begun == since, since).otherwise(begun + F.expr(f"INTERVAL 1 {unit}"))

    if folds is None:
        return after("hour")
    return F.when(since < F.lit(folds.months), after("month")).when(since < F.lit(folds.days), after("day")).otherwise(after("hour"))


def report(
    spark: SparkSession,
    out: str,
    versions: DataFrame,
    training_rows: DataFrame,
    contract: DatasetContract,
    *,
    since: Column | None = None,
    predictions: DataFrame | None = None,
    config: MonitorConfig = MonitorConfig(),
    kept: str | None = None,
) -> DataFrame:
    """Feature results per version from the counts so far.

    A window from `since` on takes the counts of its whole units; the hour (of folded counts, the day or month) that
    `since` falls into is counted from `predictions`, the log, of which only that unit is read.
    """
    key = "model_version_id"
    folds = _folds(spark, out)
    counts = unit_counts(spark, out, folds).select(key, "start", "feature", "num", "cat", "n")
    if since is not None:
        if predictions is None:
            raise ValueError("A window needs the log for the unit that it starts inside of.")
        begun = next_unit(since, folds)
        first = predictions.where((F.col("created_at") >= since) & (F.col("created_at") < begun))
        broken = drift.feature_counts(first.withColumn("start", F.date_trunc("hour", "created_at")), contract, [key, "start"])
        counts = counts.where(F.col("start") >= begun).unionByName(broken.select(*counts.columns))
    total = counts.groupBy(key, "feature", "num", "cat").agg(F.sum("n").alias("n"))
    sizes = drift.row_counts(total, [key], "sample_size")
    reference, keyed = drift.references(versions, training_rows, contract, kept)
    passed = drift.with_status(keyed, sizes, config).where(F.col("status") == "ok").select(KEY, key)
    return drift.feature_results(reference, total, contract, keys=[key], groups=passed, config=config).drop(KEY)
