"""Usage, job statistics, counters, latency histograms and the monitoring summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.functions.stats import ratio_or_zero
from tabwatch.functions.text import seconds_between
from tabwatch.schema import ACTIVE_STATUSES

# Default upper bounds, in seconds, of a request latency histogram.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0, float("inf"))


def usage(predictions: DataFrame, versions: DataFrame) -> DataFrame:
    """Predictions per model version with share of total, first and last use, most used first.

    The log is reduced to one row per version before anything else; a version missing from the
    registry keeps its counts with null labels.
    """
    counts = predictions.groupBy("model_version_id").agg(
        F.count(F.lit(1)).alias("prediction_count"),
        F.min("created_at").alias("first_prediction_at"),
        F.max("created_at").alias("last_prediction_at"),
    )
    # One row per version is left, so the total is a window over everything: no second scan of the log.
    counts = counts.withColumn("_total", F.sum("prediction_count").over(Window.partitionBy(F.lit(0))))
    labels = versions.select(F.col("id").alias("model_version_id"), "version_label", "algorithm", "stage")
    return (
        counts.join(labels, "model_version_id", "left")
        .withColumn("percentage_of_total", ratio_or_zero(F.col("prediction_count") * 100, F.col("_total")))
        .drop("_total")
        .orderBy(F.col("prediction_count").desc(), "model_version_id")
    )


def total_usage(used: DataFrame) -> DataFrame:
    return used.agg(
        F.coalesce(F.sum("prediction_count"), F.lit(0)).cast("bigint").alias("total_predictions"),
        F.count(F.lit(1)).alias("n_versions"),
    )


def stale_versions(predictions: DataFrame, versions: DataFrame) -> DataFrame:
    """Versions that are not in production yet were used after the current one was promoted."""
    promoted = versions.where(F.col("stage") == "production").agg(F.max("promoted_at")).scalar()
    return usage(predictions, versions).where(
        (F.col("stage") != "production") & (F.col("last_prediction_at") >= promoted)
    )


def with_duration(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("duration_seconds", seconds_between(F.col("started_at"), F.col("finished_at")))


def job_stats(jobs: DataFrame) -> DataFrame:
    """One row over all training jobs: counts by state and the mean duration of completed ones."""
    trained = with_duration(jobs.where(F.col("job_type") == "train"))
    status = F.col("status")
    duration = F.when(status == "completed", F.col("duration_seconds"))
    return trained.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count_if(status == "completed").alias("completed_jobs"),
        F.count_if(status == "failed").alias("failed_jobs"),
        F.count_if(status.isin(*ACTIVE_STATUSES)).alias("active_jobs"),
        F.avg(duration).alias("average_training_duration_seconds"),
        F.count(duration).alias("n_durations_sampled"),
    )


def _newest_failures(jobs: DataFrame, condition: Column, limit: int) -> DataFrame:
    return jobs.where((F.col("status") == "failed") & condition).orderBy(F.col("created_at").desc(), "id").limit(limit)


def training_failures(jobs: DataFrame, limit: int = 5) -> DataFrame:
    """Newest failed training jobs of all time."""
    return _newest_failures(jobs, F.col("job_type") == "train", limit).select(
        F.col("id").alias("job_id"), "dataset_id", "error_message", "created_at", "finished_at"
    )


def recent_failures(jobs: DataFrame, as_of: Column, limit: int = 5) -> DataFrame:
    """Newest failed jobs of any type in the last 24 hours."""
    return _newest_failures(jobs, F.col("created_at") >= as_of - F.expr("INTERVAL 24 HOURS"), limit).select(
        F.col("id").alias("job_id"), "job_type", "error_message", "created_at"
    )


def counters(log: DataFrame, labels: Sequence[str], *, amount: Column | None = None) -> DataFrame:
    """Count per label set, plus a grand-total row whose labels are all null and `is_total` is true."""
    n = F.count(F.lit(1)) if amount is None else F.sum(amount)
    per_label = log.groupBy(*labels).agg(n.alias("n"))
    total = per_label.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n")).select(
        *[F.lit(None).cast(per_label.schema[c].dataType).alias(c) for c in labels], "n"
    )
    return per_label.withColumn("is_total", F.lit(False)).unionByName(total.withColumn("is_total", F.lit(True)))


def batch_requests(predictions: DataFrame, inline_limit: int) -> DataFrame:
    """(request_id, n_records, mode) of requests for several records: `sync` up to `inline_limit` records, else `async`."""
    sized = predictions.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")
    return sized.withColumn("mode", F.when(F.col("n_records") <= inline_limit, "sync").otherwise("async"))


def event_counters(predictions: DataFrame, errors: DataFrame, batches: DataFrame) -> DataFrame:
    """(metric, label, n, is_total): predictions by version, errors by reason and batch requests by mode, and their totals.

    `errors` has a reason for each failed prediction, `batches` is as of batch_requests. All three logs are one union,
    counted for the labels and for the metrics in one pass over grouping sets. A metric without events has its total 0.
    """
    def events(df: DataFrame, metric: str, label: str) -> DataFrame:
        return df.select(F.lit(metric).alias("metric"), F.col(label).cast("string").alias("label"), F.lit(1).alias("one"))

    union = events(predictions, "predictions", "model_version_id").unionByName(events(errors, "prediction_errors", "reason"))
    union = union.unionByName(events(batches, "batch_predictions", "mode"))
    start = predictions.sparkSession.createDataFrame([("predictions",), ("prediction_errors",), ("batch_predictions",)], "metric string")
    union = union.unionByName(start.select("metric", F.lit(None).cast("string").alias("label"), F.lit(0).alias("one")))
    counted = union.groupingSets([["metric", "label"], ["metric"]], "metric", "label").agg(
        F.sum("one").alias("n"), (F.grouping("label") == 1).alias("is_total")
    )
    return counted.where("is_total OR n > 0").select("metric", "label", "n", "is_total")


def histogram_aggregates(latency: Column) -> list[Column]:
    """Cumulative bucket counts, sum and count as plain aggregates, for batch and streaming use."""
    buckets = [F.count_if(latency <= b).alias(bucket_name(b)) for b in LATENCY_BOUNDS]
    return [*buckets, F.sum(latency).alias("latency_sum"), F.count(latency).alias("latency_count")]


def bucket_name(bound: float) -> str:
    return "le_inf" if bound == float("inf") else "le_" + f"{bound:g}".replace(".", "_")


def latency_histogram(log: DataFrame, keys: Sequence[str], latency: Column) -> DataFrame:
    """(keys, le, cumulative_count, latency_sum, latency_count), one row per bucket bound."""
    wide = log.groupBy(*keys).agg(*histogram_aggregates(latency))
    buckets = F.array(
        *[F.struct(F.lit(b).alias("le"), F.col(bucket_name(b)).alias("cumulative_count")) for b in LATENCY_BOUNDS]
    )
    return wide.select(*keys, "latency_sum", "latency_count", F.explode(buckets).alias("_b")).select(
        *keys, "_b.le", "_b.cumulative_count", "latency_sum", "latency_count"
    )


def summary(
    predictions: DataFrame, jobs: DataFrame, versions: DataFrame, *, as_of: Column, min_samples: int, errors: DataFrame | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    """One row: production model, recent activity, drift status, failures, job statistics and totals.

    Each part is reduced to one row on its own, from a single pass over its table, and attached as scalar subqueries.
    `errors` is a log of failed predictions, `batches` one of batch requests (one row each). Usage is a row for each
    version: it is `usage`, and here only the number of versions and the most used one (ties: the smallest id).
    """
    cutoff = as_of - F.expr("INTERVAL 24 HOURS")
    production = versions.where(F.col("stage") == "production").agg(
        F.min(F.struct(F.col("id").alias("model_version_id"), "version_label", "algorithm", "promoted_at")).alias("p")
    )
    facts = usage(predictions, versions).agg(
        F.coalesce(F.sum("prediction_count"), F.lit(0)).cast("bigint").alias("total_predictions"),
        F.max(F.when(F.col("stage") == "production", F.col("prediction_count"))).alias("production_n"),
        F.count(F.lit(1)).alias("n_versions_used"),
        F.min(F.struct((-F.col("prediction_count")).alias("o"), "model_version_id"))["model_version_id"].alias("most_used_version"),
    ).select(F.struct("*").alias("u"))
    recent = predictions.where(F.col("created_at") >= cutoff).agg(F.count(F.lit(1)).alias("n"))
    failures = recent_failures(jobs, as_of).agg(F.array_sort(F.collect_list("job_id")).alias("f"))

    def total(events: DataFrame | None) -> Column:
        return F.lit(0).cast("bigint") if events is None else events.agg(F.count(F.lit(1))).scalar()

    row = job_stats(jobs).select(
        F.struct("*").alias("training_job_stats"),
        F.col("active_jobs").alias("active_training_jobs"),
        production.scalar().alias("current_production_model"),
        facts.scalar().alias("_u"),
        recent.scalar().alias("recent_prediction_count"),
        failures.scalar().alias("recent_failed_jobs"),
        total(errors).alias("prediction_error_count"),
        total(batches).alias("total_batch_requests"),
    )
    model, size = F.col("current_production_model"), F.coalesce(F.col("_u.production_n"), F.lit(0))
    return row.select(
        "current_production_model",
        F.lit(24.0).alias("recent_window_hours"),
        "recent_prediction_count",
        "prediction_error_count",
        "total_batch_requests",
        F.col("_u.total_predictions").alias("total_predictions"),
        F.when(model.isNull(), "no_production_model").when(size < min_samples, "insufficient_data").otherwise("ok").alias("drift_status"),
        "active_training_jobs",
        "recent_failed_jobs",
        "training_job_stats",
        F.col("_u.n_versions_used").alias("n_versions_used"),
        F.col("_u.most_used_version").alias("most_used_version"),
    )
