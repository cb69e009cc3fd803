"""Filtered, ordered and paged listings, point look-ups and display joins."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.text import DASH, short_id
from tabwatch.schema import JOB_STATUSES, JOB_TYPES, STAGES

# Public columns per table; payload columns are left out before any sort or join.
DATASET_SUMMARY = ("id", "filename", "schema_name", "n_rows", "is_valid", "uploaded_at")
PREDICTION_SUMMARY = ("id", "request_id", "model_version_id", "prediction", "probability", "created_at")
MODEL_SUMMARY = (
    "id", "version_label", "algorithm", "stage", "metrics", "dataset_id", "training_job_id", "created_at", "promoted_at",
)
JOB_SUMMARY = (
    "id", "job_type", "status", "dataset_id", "n_records", "model_version", "model_version_ids", "result",
    "error_message", "created_at", "started_at", "finished_at",
)
MAX_PAGE = {"predictions": 500, "jobs": 200}


def where_equal(df: DataFrame, **wanted: Any) -> DataFrame:
    """Equality filters; a None argument does not filter. Enumerated values are checked."""
    valid = {"job_type": JOB_TYPES, "status": JOB_STATUSES, "stage": STAGES}
    for name, value in wanted.items():
        if value is None:
            continue
        if name in valid and value not in valid[name]:
            raise ValueError(f"Unknown {name} {value!r}. Valid: {list(valid[name])}")
        df = df.where(F.col(name) == value)
    return df


def where_between(df: DataFrame, start: Column | None = None, end: Column | None = None, ts: str = "created_at") -> DataFrame:
    """Inclusive date range, open where a bound is missing."""
    if start is not None:
        df = df.where(F.col(ts) >= start)
    if end is not None:
        df = df.where(F.col(ts) <= end)
    return df


def by_key(df: DataFrame, value: Any, key: str = "id") -> DataFrame:
    """Point look-up; an empty result means not found."""
    return df.where(F.col(key) == value)


def newest_first(df: DataFrame, ts: str = "created_at", key: str = "id") -> DataFrame:
    return df.orderBy(F.col(ts).desc(), key)


def page(df: DataFrame, *, limit: int = 50, offset: int = 0, max_limit: int = 500, ts: str = "created_at") -> tuple[DataFrame, DataFrame]:
    """(items, total): one page, newest first, and the one-row count of everything that matches."""
    if not 1 <= limit <= max_limit:
        raise ValueError(f"limit must be between 1 and {max_limit}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    return newest_first(df, ts).offset(offset).limit(limit), df.agg(F.count(F.lit(1)).alias("total"))


def page_after(df: DataFrame, *, limit: int, after: tuple[Column, Any] | None = None, ts: str = "created_at", key: str = "id") -> DataFrame:
    """Keyset paging: the page that follows the (timestamp, key) of the last row seen.

    The filter is pushed to the scan and the rest is a top-k, so a deep page costs what the first
    one does.
    """
    if after is not None:
        last_ts, last_key = after
        df = df.where((F.col(ts) <= last_ts) & ((F.col(ts) < last_ts) | (F.col(key) > last_key)))
    return newest_first(df, ts, key).limit(limit)


def prediction_detail(predictions: DataFrame, versions: DataFrame) -> DataFrame:
    """Predictions with label and algorithm of the version that made them."""
    labels = versions.select(
        F.col("id").alias("model_version_id"), F.col("version_label").alias("model_version_label"), "algorithm"
    )
    return predictions.join(labels, "model_version_id", "left")


def candidates_by_job(versions: DataFrame) -> DataFrame:
    """(job_id, model_version_ids): sorted ids of the candidates each training job registered."""
    return (
        versions.where(F.col("training_job_id").isNotNull())
        .groupBy(F.col("training_job_id").alias("job_id"))
        .agg(F.sort_array(F.collect_list("id")).alias("model_version_ids"))
    )


def with_job_details(jobs: DataFrame, versions: DataFrame) -> DataFrame:
    """Jobs with record count and pinned version (batch jobs) or registered candidates (training jobs).

    A training job registers at most one candidate per algorithm, so the id list is short.
    """
    is_batch = F.col("job_type") == "batch_predict"
    pinned = versions.select(F.col("id").alias("_pinned"), F.col("version_label").alias("model_version"))
    made = candidates_by_job(versions).withColumnRenamed("job_id", "_made_by")
    records = F.when(is_batch, F.json_array_length(F.get_json_object("payload", "$.records")))
    return (
        jobs.withColumn("n_records", records)
        .withColumn("_version", F.when(is_batch, F.get_json_object("payload", "$.model_version_id")))
        .join(pinned, F.col("_version") == F.col("_pinned"), "left")
        .join(made, (F.col("job_type") == "train") & (F.col("id") == F.col("_made_by")), "left")
        .drop("_version", "_pinned", "_made_by")
    )


def partial_candidates(jobs: DataFrame, versions: DataFrame) -> DataFrame:
    """Candidates left behind by training jobs that failed part way."""
    failed = jobs.where((F.col("job_type") == "train") & (F.col("status") == "failed"))
    made = candidates_by_job(versions).withColumnRenamed("model_version_ids", "partial_candidate_model_version_ids")
    return made.join(failed.select(F.col("id").alias("job_id"), "error_message"), "job_id")


def with_dataset_name(df: DataFrame, datasets: DataFrame) -> DataFrame:
    """Adds `dataset_name`: file name, else the shortened id, else a dash."""
    names = datasets.select(F.col("id").alias("dataset_id"), F.col("filename").alias("_filename"))
    name = F.coalesce("_filename", F.when(F.col("dataset_id").isNotNull(), short_id(F.col("dataset_id"))), F.lit(DASH))
    return df.join(names, "dataset_id", "left").withColumn("dataset_name", name).drop("_filename")


def valid_datasets(datasets: DataFrame) -> DataFrame:
    return newest_first(datasets.where("is_valid").select(*DATASET_SUMMARY), "uploaded_at")
