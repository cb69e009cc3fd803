"""Structured access-log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.schema import ACCESS_LOG


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with a fixed schema; completed requests only, latency also in seconds."""
    lines = spark.read.schema(ACCESS_LOG).json(path)
    return lines.where(F.col("message") == "request_completed").withColumn("latency_s", F.col("latency_ms") / 1000)
