"""Batch scoring with a pinned model version into the prediction log."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.coerce import label_text
from tabwatch.operators.features import FeatureSpec, feature_rows
from tabwatch.operators.quality import row_violations, split_by_violations
from tabwatch.plans.train import score_rows
from tabwatch.session import new_workspace
from tabwatch.sources import tables


def records_of_jobs(jobs: DataFrame, contract) -> DataFrame:
    """One row per record of each batch job's payload: request_id, model_version_id, record_no, features."""
    fields = ", ".join(f"`{c}` string" for c in contract.features)
    payload = F.from_json("payload", f"struct<records: array<struct<{fields}>>, model_version_id: string>").alias("_p")
    return (
        jobs.where(F.col("job_type") == "batch_predict")
        .select(F.col("id").alias("request_id"), payload)
        .select("request_id", F.col("_p.model_version_id").alias("model_version_id"), F.posexplode("_p.records").alias("record_no", "_r"))
        .select("request_id", "model_version_id", "record_no", "_r.*")
    )


def score(
    records: DataFrame,
    model: PipelineModel,
    spec: FeatureSpec,
    *,
    model_version_id: str,
    request_id: str,
    record_key: Sequence[str],
    as_of: Column,
    integers: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(prediction rows without latency, rejected records).

    The version is an argument, fixed when the batch was submitted: a promotion meanwhile changes
    nothing. Row ids are digests of request and record, so scoring again gives the same ids.
    """
    contract = spec.contract
    checked = row_violations(records, contract, integers=integers, optional=contract.coercible_numeric_columns)
    accepted, rejected = split_by_violations(checked)
    typed = feature_rows(accepted, FeatureSpec(contract, {}), keep=record_key, target=False)
    scored = score_rows(model, typed)
    out = scored.select(
        F.md5(F.concat_ws("|", F.lit(request_id), *[F.col(c).cast("string") for c in record_key])).alias("id"),
        F.lit(request_id).alias("request_id"),
        F.lit(model_version_id).alias("model_version_id"),
        F.struct(*contract.features).alias("input_features"),
        label_text(F.col("prediction"), contract.positive_label, contract.negative_label).alias("prediction"),
        "probability",
        as_of.alias("created_at"),
    )
    return out, rejected


def staged(scored: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """Scored rows with `latency_ms`, and their number and that latency.

    The latency is the total divided by the number of rows, so it is only known afterwards: rows are
    staged in the shared folder first.
    """
    folder = new_workspace(scored.sparkSession, "scored")
    start = time.perf_counter()
    scored.write.parquet(folder)
    total_ms = (time.perf_counter() - start) * 1000
    rows = scored.sparkSession.read.schema(scored.schema).parquet(folder)
    n = rows.count()
    latency = total_ms / max(n, 1)
    return rows.withColumn("latency_ms", F.lit(latency)), {"n_processed": n, "latency_ms": latency}


def run_batch(scored: DataFrame, log_path: str, rejected: DataFrame | None = None, rejected_path: str | None = None) -> dict[str, float]:
    """Appends scored rows to the log, and refused records to a table of their own; returns number and latency of the rows."""
    rows, result = staged(scored)
    tables.append_predictions(rows, log_path)
    if rejected is not None and rejected_path is not None:
        tables.append(rejected, rejected_path)
    return result


def outcomes(log: DataFrame, rejected: DataFrame, record_key: str, labels: tuple[str, str]) -> DataFrame:
    """(id, record, request_id, scored, refused): every record of a request, scored or refused and why."""
    sound = F.col("prediction").isin(*labels) & F.col("probability").between(0, 1)
    accepted = log.select("id", F.lit(None).cast("string").alias("record"), "request_id", sound.alias("scored"), F.lit("").alias("refused"))
    return accepted.unionByName(rejected.select(
        F.lit(None).cast("string").alias("id"), F.col(record_key).cast("string").alias("record"), "request_id",
        F.lit(False).alias("scored"), F.array_join("violations", "; ").alias("refused"),
    ))


def batch_result(log: DataFrame) -> DataFrame:
    """(request_id, n_processed, prediction_id): the ids of each batch's predictions, one row each, beside its size.

    Ids are rows and not a list, as a batch has no bound; the size is counted apart and joined back.
    """
    sizes = log.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_processed"))
    return log.select("request_id", F.col("id").alias("prediction_id")).join(sizes, "request_id")
