"""Listing, look-up and lineage queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.functions import text
from tabwatch.operators import drift, listing
from tabwatch.operators import lineage as lin
from tabwatch.queries.tables import AS_OF, load, moment, r6, with_tables


def _iso(name: str):
    return text.iso(F.col(name)).alias(name)


def _prediction_row(df: DataFrame) -> DataFrame:
    return df.select("id", "request_id", "model_version_id", "prediction", *r6("probability"), _iso("created_at"))


def predictions_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of 50 of one version's predictions, newest first."""
    rows = listing.where_equal(load(spark, sf_dir, "predictions"), model_version_id="3").select(*listing.PREDICTION_SUMMARY)
    items, _ = listing.page(rows, limit=50, offset=50, max_limit=listing.MAX_PAGE["predictions"])
    return _prediction_row(items)


def predictions_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing.where_equal(load(spark, sf_dir, "predictions"), model_version_id="3")
    return listing.page(rows, limit=50)[1]


def predictions_keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 predictions that follow a known position in the whole log."""
    rows = load(spark, sf_dir, "predictions").select(*listing.PREDICTION_SUMMARY)
    return _prediction_row(listing.page_after(rows, limit=100, after=(moment("2000-06-01 00:00:00"), "5")))


def predictions_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing.where_between(
        load(spark, sf_dir, "predictions"), moment("2000-01-01 00:00:00"), moment("2000-03-31 00:00:00")
    )
    return _prediction_row(rows)


def predictions_last_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions per version in the preset windows."""
    return drift.window_sizes(load(spark, sf_dir, "predictions"), moment(AS_OF))


def prediction_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing.prediction_detail(load(spark, sf_dir, "predictions"), load(spark, sf_dir, "model_versions"))
    return rows.select("id", "model_version_id", "model_version_label", "algorithm", "prediction", *r6("probability", "latency_ms"))


def prediction_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All predictions of one request."""
    rows = listing.by_key(load(spark, sf_dir, "predictions"), "7", key="request_id")
    return _prediction_row(rows)


def jobs_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page of failed training jobs with their candidates."""
    jobs = listing.where_equal(load(spark, sf_dir, "jobs"), job_type="train", status="failed")
    items, _ = listing.page(jobs, limit=20, max_limit=listing.MAX_PAGE["jobs"])
    detailed = listing.with_job_details(items, load(spark, sf_dir, "model_versions"))
    return detailed.select("id", "status", "dataset_id", F.array_join("model_version_ids", ",").alias("model_version_ids"), _iso("created_at"))


def jobs_with_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    detailed = listing.with_job_details(load(spark, sf_dir, "jobs"), load(spark, sf_dir, "model_versions"))
    return detailed.where(F.col("model_version_ids").isNotNull()).select(
        "id", "job_type", "status", F.array_join("model_version_ids", ",").alias("model_version_ids")
    )


def jobs_pinned_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    detailed = listing.with_job_details(load(spark, sf_dir, "jobs"), load(spark, sf_dir, "model_versions"))
    return detailed.where("job_type = 'batch_predict'").select("id", F.col("n_records").cast("bigint").alias("n_records"), "model_version")


def failed_job_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = listing.partial_candidates(load(spark, sf_dir, "jobs"), load(spark, sf_dir, "model_versions"))
    return found.select("job_id", F.array_join("partial_candidate_model_version_ids", ",").alias("partial_ids"), "error_message")


def valid_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.valid_datasets(load(spark, sf_dir, "datasets")).select("id", "filename", "schema_name", "n_rows", "is_valid", _iso("uploaded_at"))


def dataset_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = listing.with_dataset_name(load(spark, sf_dir, "model_versions"), load(spark, sf_dir, "datasets"))
    return named.select("id", "dataset_id", "dataset_name")


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lin.lineage(*[load(spark, sf_dir, t) for t in ("model_versions", "datasets", "jobs", "predictions")])


def lineage_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lin.lineage_steps(lineage(spark, sf_dir))


def lineage_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lin.lineage_mismatches(load(spark, sf_dir, "model_versions"), load(spark, sf_dir, "jobs"))


def missing_training_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = lin.missing_training_datasets(load(spark, sf_dir, "model_versions"), load(spark, sf_dir, "datasets"))
    return gone.select("id", "version_label", "dataset_id")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every finished training job asked for again, configuration keys in another order."""
    jobs = load(spark, sf_dir, "jobs").where("job_type = 'train' AND status IN ('completed', 'failed')")
    return jobs.select("id", "dataset_id", F.regexp_replace("payload", ": ", ":").alias("payload"))


def duplicate_active_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lin.duplicate_requests(_requests(spark, sf_dir), load(spark, sf_dir, "jobs")).select("id", "dataset_id")


def new_training_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lin.duplicate_requests(_requests(spark, sf_dir), load(spark, sf_dir, "jobs"), how="left_anti").select("id", "dataset_id")


QUERIES = {
    f.__name__: f
    for f in (
        predictions_page, predictions_total, predictions_keyset_page, predictions_filtered, predictions_last_week,
        prediction_detail, prediction_lookup, jobs_page, jobs_with_candidates, jobs_pinned_version,
        failed_job_candidates, valid_datasets, dataset_name_lookup, lineage, lineage_steps, lineage_mismatch,
        missing_training_dataset, duplicate_active_jobs, new_training_requests,
    )
}

_TS = "strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS created_at"
_ROW = f"SELECT id, request_id, model_version_id, prediction, round(probability, 6) AS probability, {_TS} FROM"
_CANDIDATES = "(SELECT training_job_id, string_agg(id, ',' ORDER BY id) AS ids FROM model_versions WHERE training_job_id IS NOT NULL GROUP BY 1)"
_LINEAGE = """chain AS (
    SELECT m.training_job_id, m.dataset_id, m.id, m.version_label, m.mlflow_run_id, d.filename AS dataset_filename,
           j.status AS job_status, CAST(coalesce(p.n, 0) AS BIGINT) AS prediction_count
    FROM model_versions m LEFT JOIN datasets d ON d.id = m.dataset_id LEFT JOIN jobs j ON j.id = m.training_job_id
    LEFT JOIN (SELECT model_version_id, count(*) AS n FROM predictions GROUP BY 1) p ON p.model_version_id = m.id)"""
_SAME = """EXISTS (SELECT 1 FROM jobs a WHERE a.job_type = 'train' AND a.status IN ('queued', 'running')
    AND a.dataset_id = r.dataset_id AND a.payload = r.payload)"""
_LINEAGE_TABLES = ("model_versions", "datasets", "jobs", "predictions")

ORACLES = {
    "predictions_page": with_tables(
        f"{_ROW} (SELECT * FROM predictions WHERE model_version_id = '3' ORDER BY predictions.created_at DESC, id LIMIT 50 OFFSET 50) p", "predictions"
    ),
    "predictions_total": with_tables("SELECT CAST(count(*) AS BIGINT) AS total FROM predictions WHERE model_version_id = '3'", "predictions"),
    "predictions_keyset_page": with_tables(
        f"""{_ROW} (SELECT * FROM predictions WHERE created_at < TIMESTAMP '2000-06-01' OR (created_at = TIMESTAMP '2000-06-01' AND id > '5')
        ORDER BY predictions.created_at DESC, id LIMIT 100) p""", "predictions",
    ),
    "predictions_filtered": with_tables(
        f"{_ROW} predictions WHERE predictions.created_at BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2000-03-31'", "predictions"
    ),
    "predictions_last_week": with_tables(
        """SELECT model_version_id, CAST(count(*) AS BIGINT) AS n, w AS "window" FROM predictions,
        (VALUES ('24h', TIMESTAMP '2001-11-04'), ('7d', TIMESTAMP '2001-10-29'), ('30d', TIMESTAMP '2001-10-06'), ('all', TIMESTAMP '1900-01-01')) v(w, since)
        WHERE created_at >= since GROUP BY 1, 3""", "predictions",
    ),
    "prediction_detail": with_tables(
        """SELECT p.id, model_version_id, version_label AS model_version_label, algorithm, prediction,
           round(probability, 6) AS probability, round(latency_ms, 6) AS latency_ms
        FROM predictions p LEFT JOIN model_versions m ON m.id = p.model_version_id""", "predictions", "model_versions",
    ),
    "prediction_lookup": with_tables(f"{_ROW} predictions WHERE request_id = '7'", "predictions"),
    "jobs_page": with_tables(
        f"""SELECT j.id, j.status, j.dataset_id, c.ids AS model_version_ids, strftime(j.created_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS created_at
        FROM (SELECT * FROM jobs WHERE job_type = 'train' AND status = 'failed' ORDER BY created_at DESC, id LIMIT 20) j
        LEFT JOIN {_CANDIDATES} c ON c.training_job_id = j.id""", "jobs", "model_versions",
    ),
    "jobs_with_candidates": with_tables(
        f"SELECT j.id, job_type, status, ids AS model_version_ids FROM jobs j JOIN {_CANDIDATES} c ON c.training_job_id = j.id WHERE job_type = 'train'",
        "jobs", "model_versions",
    ),
    "jobs_pinned_version": with_tables(
        """SELECT j.id, CAST(json_array_length(payload, '$.records') AS BIGINT) AS n_records, m.version_label AS model_version
        FROM jobs j LEFT JOIN model_versions m ON m.id = json_extract_string(payload, '$.model_version_id') WHERE job_type = 'batch_predict'""",
        "jobs", "model_versions",
    ),
    "failed_job_candidates": with_tables(
        f"""SELECT j.id AS job_id, ids AS partial_ids, error_message FROM jobs j JOIN {_CANDIDATES} c ON c.training_job_id = j.id
        WHERE job_type = 'train' AND status = 'failed'""", "jobs", "model_versions",
    ),
    "valid_datasets": with_tables(
        "SELECT id, filename, schema_name, n_rows, is_valid, strftime(uploaded_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS uploaded_at FROM datasets WHERE is_valid", "datasets"
    ),
    "dataset_name_lookup": with_tables(
        """SELECT m.id, m.dataset_id, coalesce(d.filename, substring(m.dataset_id, 1, 8), '—') AS dataset_name
        FROM model_versions m LEFT JOIN datasets d ON d.id = m.dataset_id""", "model_versions", "datasets",
    ),
    "lineage": with_tables(f"WITH {_LINEAGE} SELECT * FROM chain", *_LINEAGE_TABLES),
    "lineage_steps": with_tables(
        f"""WITH {_LINEAGE}
        SELECT id, 1 AS step, 'Dataset' AS label, coalesce(dataset_filename, substring(dataset_id, 1, 8), '—') AS value FROM chain
        UNION ALL SELECT id, 2, 'Training job', coalesce(substring(training_job_id, 1, 12), 'None (trained outside a job)') FROM chain
        UNION ALL SELECT id, 3, 'MLflow run', substring(mlflow_run_id, 1, 16) FROM chain
        UNION ALL SELECT id, 4, 'Model version', version_label FROM chain
        UNION ALL SELECT id, 5, 'Predictions', format('{{:,}}', prediction_count) || ' recorded' FROM chain""", *_LINEAGE_TABLES,
    ),
    "lineage_mismatch": with_tables(
        """SELECT m.id, m.dataset_id, m.training_job_id, j.dataset_id AS job_dataset_id FROM model_versions m JOIN jobs j ON j.id = m.training_job_id
        WHERE m.dataset_id IS DISTINCT FROM j.dataset_id""", "model_versions", "jobs",
    ),
    "missing_training_dataset": with_tables(
        "SELECT m.id, version_label, dataset_id FROM model_versions m WHERE NOT EXISTS (SELECT 1 FROM datasets d WHERE d.id = m.dataset_id)",
        "model_versions", "datasets",
    ),
    "duplicate_active_jobs": with_tables(
        f"SELECT id, dataset_id FROM jobs r WHERE job_type = 'train' AND status IN ('completed', 'failed') AND {_SAME}", "jobs"
    ),
    "new_training_requests": with_tables(
        f"SELECT id, dataset_id FROM jobs r WHERE job_type = 'train' AND status IN ('completed', 'failed') AND NOT {_SAME}", "jobs"
    ),
}
