"""Windowed counts and latency histograms over event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.operators.monitoring import histogram_aggregates


def _windowed(stream: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str | None, watermark: str):
    # Watermarks need an instant; zone-less input is taken as UTC.
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return timed.groupBy(window.alias("window"), *keys)


def _flat(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in df.columns if c not in ("window", *keys)]
    return df.select(F.col("window.start").alias("window_start"), *keys, *values)


def windowed_counts(
    stream: DataFrame, keys: Sequence[str], *, ts: str = "created_at", size: str = "1 hour", slide: str | None = None,
    watermark: str = "1 hour",
) -> DataFrame:
    """(window_start, keys, n) in tumbling or sliding windows; rows later than the watermark are dropped."""
    return _flat(_windowed(stream, ts, keys, size, slide, watermark).agg(F.count(F.lit(1)).alias("n")), keys)


def windowed_histogram(
    stream: DataFrame, keys: Sequence[str], latency: Column, *, ts: str = "created_at", size: str = "1 hour", watermark: str = "1 hour"
) -> DataFrame:
    """(window_start, keys, le_*, latency_sum, latency_count): cumulative latency buckets per window."""
    return _flat(_windowed(stream, ts, keys, size, None, watermark).agg(*histogram_aggregates(latency)), keys)
