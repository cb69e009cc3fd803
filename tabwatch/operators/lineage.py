"""Lineage from dataset to predictions, and the consistency checks along it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.text import integer_text, short_id
from tabwatch.schema import ACTIVE_STATUSES

NO_JOB = "None (trained outside a job)"


def lineage(versions: DataFrame, datasets: DataFrame, jobs: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row per model version: its dataset, training job, run and number of predictions.

    The prediction log is counted per version before the joins, so only registry-sized tables meet.
    """
    counts = predictions.groupBy(F.col("model_version_id").alias("id")).agg(F.count(F.lit(1)).alias("_n"))
    files = datasets.select(F.col("id").alias("dataset_id"), F.col("filename").alias("dataset_filename"))
    trained = jobs.select(F.col("id").alias("training_job_id"), F.col("status").alias("job_status"))
    return (
        versions.select("id", "version_label", "dataset_id", "training_job_id", "mlflow_run_id")
        .join(files, "dataset_id", "left")
        .join(trained, "training_job_id", "left")
        .join(counts, "id", "left")
        .withColumn("prediction_count", F.coalesce("_n", F.lit(0)).cast("bigint"))
        .drop("_n")
    )


def lineage_steps(chain: DataFrame) -> DataFrame:
    """(id, step, label, value): the chain as display rows, in order."""

    def step(i: int, label: str, value: Column) -> Column:
        return F.struct(F.lit(i).alias("step"), F.lit(label).alias("label"), value.alias("value"))

    steps = F.array(
        step(1, "Dataset", F.coalesce("dataset_filename", short_id(F.col("dataset_id")))),
        step(2, "Training job", F.when(F.col("training_job_id").isNull(), NO_JOB).otherwise(short_id(F.col("training_job_id"), 12))),
        step(3, "MLflow run", short_id(F.col("mlflow_run_id"), 16)),
        step(4, "Model version", F.col("version_label")),
        step(5, "Predictions", F.concat(integer_text(F.col("prediction_count")), F.lit(" recorded"))),
    )
    return chain.select("id", F.explode(steps).alias("_s")).select("id", "_s.step", "_s.label", "_s.value")


def lineage_mismatches(versions: DataFrame, jobs: DataFrame) -> DataFrame:
    """Versions whose own dataset differs from the dataset of the job that trained them."""
    trained = jobs.select(F.col("id").alias("training_job_id"), F.col("dataset_id").alias("job_dataset_id"))
    return versions.select("id", "dataset_id", "training_job_id").join(trained, "training_job_id").where(
        ~F.col("dataset_id").eqNullSafe(F.col("job_dataset_id"))
    )


def missing_training_datasets(versions: DataFrame, datasets: DataFrame) -> DataFrame:
    """Versions for which no reference distribution can be built: their dataset is gone."""
    known = datasets.select(F.col("id").alias("dataset_id"))
    return versions.join(known, "dataset_id", "left_anti")


def _request_key(payload: Column) -> list[Column]:
    """Configuration and algorithms of a training payload in canonical form.

    The configuration is compared as a map with sorted keys; an absent algorithm list equals a null one.
    """
    config = F.from_json(F.get_json_object(payload, "$.config"), "map<string,string>")
    return [
        F.to_json(F.array_sort(F.map_entries(config))).alias("_config"),
        F.get_json_object(payload, "$.algorithms").alias("_algorithms"),
    ]


def duplicate_requests(requests: DataFrame, jobs: DataFrame, *, how: str = "left_semi") -> DataFrame:
    """Training requests (dataset_id, payload) for which an equal job is still active.

    With `how="left_anti"` the requests that are new instead.
    """
    active = jobs.where((F.col("job_type") == "train") & F.col("status").isin(*ACTIVE_STATUSES)).select(
        F.col("dataset_id").alias("_dataset"), *[c.alias(f"{n}_j") for c, n in zip(_request_key(F.col("payload")), ("_config", "_algorithms"))]
    )
    asked = requests.select("*", *_request_key(F.col("payload")))
    same = (
        (F.col("dataset_id") == F.col("_dataset"))
        & F.col("_config").eqNullSafe(F.col("_config_j"))
        & F.col("_algorithms").eqNullSafe(F.col("_algorithms_j"))
    )
    return asked.join(active, same, how).select(*requests.columns)
