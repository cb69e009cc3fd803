"""Platform tables on Parquet: appends, the prediction log, and versioned publication."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_predictions(scored: DataFrame, path: str, *, period: str = "day") -> None:
    """Appends to the prediction log, partitioned by day (or a longer period) and sorted by version.

    Dates prune folders; a version's rows lie together in each file, so its filter skips row groups
    however many versions there are. The rebalance hint gathers a period's rows into files of even
    size, and adaptive execution splits a period that holds much of the log.
    """
    dated = scored.withColumn("dt", F.to_date(F.date_trunc(period, "created_at"))).hint("rebalance", F.col("dt"))
    dated.sortWithinPartitions("dt", "model_version_id", "created_at").write.mode("append").partitionBy("dt").parquet(path)


def land_rows(raw: DataFrame, dataset_id: str, path: str) -> None:
    """Keeps a dataset's rows as they came, valid or not. Landing the same dataset again replaces it."""
    raw.withColumn("dataset_id", F.lit(dataset_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("dataset_id").parquet(path)


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema("version bigint").parquet(f"{path}/commits")
    except AnalysisException:
        return None


def current_version(spark: SparkSession, path: str) -> int:
    commits = _commits(spark, path)
    return 0 if commits is None else (commits.agg(F.max("version")).head()[0] or 0)


def publish(df: DataFrame, path: str) -> int:
    """Replaces a small table in one step, for a single writer.

    The rows go to a directory of their own; the version only counts once its one-row commit file
    exists. Readers see the old or the new table, and a writer that dies leaves the old one.
    """
    spark = df.sparkSession
    version = current_version(spark, path) + 1
    df.write.mode("overwrite").parquet(f"{path}/data/v{version}")
    spark.range(version, version + 1, 1, 1).select(F.col("id").alias("version")).write.mode("append").parquet(f"{path}/commits")
    return version


def latest(spark: SparkSession, path: str) -> DataFrame:
    version = current_version(spark, path)
    if version == 0:
        raise LookupError(f"nothing published under {path}")
    return spark.read.parquet(f"{path}/data/v{version}")
