"""Usage, job and counter queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.functions import text
from tabwatch.operators import monitoring
from tabwatch.queries.tables import AS_OF, load, moment, r6, with_tables

JOBS_AS_OF = "2001-08-01 12:00:00"
# Records of a batch request that are still answered at once; the platform's own limit is 50, lines come in orders of up to 7.
INLINE_RECORDS = 3


def model_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = monitoring.usage(load(spark, sf_dir, "predictions"), load(spark, sf_dir, "model_versions"))
    return used.select(
        "model_version_id", "version_label", "algorithm", "stage", "prediction_count", *r6("percentage_of_total"),
        text.iso(F.col("first_prediction_at")).alias("first_prediction_at"),
        text.iso(F.col("last_prediction_at")).alias("last_prediction_at"),
    )


def usage_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.total_usage(monitoring.usage(load(spark, sf_dir, "predictions"), load(spark, sf_dir, "model_versions")))


def stale_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    stale = monitoring.stale_versions(load(spark, sf_dir, "predictions"), load(spark, sf_dir, "model_versions"))
    return stale.select("model_version_id", "version_label", "stage", text.iso(F.col("last_prediction_at")).alias("last_prediction_at"))


def job_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.job_stats(load(spark, sf_dir, "jobs")).withColumn(
        "average_training_duration_seconds", F.round("average_training_duration_seconds", 6)
    )


def job_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.with_duration(load(spark, sf_dir, "jobs")).select("id", "job_type", *r6("duration_seconds"))


def job_recent_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = monitoring.training_failures(load(spark, sf_dir, "jobs"))
    return failed.select(
        "job_id", "dataset_id", "error_message",
        text.iso(F.col("created_at")).alias("created_at"), text.iso(F.col("finished_at")).alias("finished_at"),
    )


def summary_recent_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = monitoring.recent_failures(load(spark, sf_dir, "jobs"), moment(JOBS_AS_OF))
    return failed.select("job_id", "job_type", "error_message", text.iso(F.col("created_at")).alias("created_at"))


def monitoring_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = load(spark, sf_dir, "access_log").where("status_code = 500")
    row = monitoring.summary(
        load(spark, sf_dir, "predictions"), load(spark, sf_dir, "jobs"), load(spark, sf_dir, "model_versions"),
        as_of=moment(JOBS_AS_OF), min_samples=100, errors=errors,
        batches=monitoring.batch_requests(load(spark, sf_dir, "predictions"), INLINE_RECORDS),
    )
    return row.select(
        F.col("current_production_model.version_label").alias("production_version"),
        "recent_window_hours", "recent_prediction_count", "prediction_error_count", "total_predictions", "drift_status",
        "active_training_jobs", F.array_join("recent_failed_jobs", ",").alias("recent_failed_jobs"),
        F.col("training_job_stats.total_jobs").alias("total_jobs"),
        F.round("training_job_stats.average_training_duration_seconds", 6).alias("average_duration"),
        "n_versions_used", "most_used_version", "total_batch_requests",
    )


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed requests of the access log with the reason of their failure."""
    failed = load(spark, sf_dir, "access_log").where("status_code >= 400")
    return failed.withColumn("reason", F.when(F.col("status_code") == 500, "model_unavailable").otherwise("validation"))


def error_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.counters(_errors(spark, sf_dir), ["reason"])


def batch_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for several records, by whether they are answered at once or by a job."""
    return monitoring.counters(monitoring.batch_requests(load(spark, sf_dir, "predictions"), INLINE_RECORDS), ["mode"])


def monitoring_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long form of the summary: all counters and their totals as rows, a version a row."""
    predictions = load(spark, sf_dir, "predictions")
    return monitoring.event_counters(predictions, _errors(spark, sf_dir), monitoring.batch_requests(predictions, INLINE_RECORDS))


def request_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.counters(load(spark, sf_dir, "access_log"), ["method", "endpoint", "status_code"])


def prediction_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions by (version label, algorithm), counted before the registry is attached."""
    used = monitoring.usage(load(spark, sf_dir, "predictions"), load(spark, sf_dir, "model_versions"))
    return monitoring.counters(used, ["version_label", "algorithm"], amount=F.col("prediction_count"))


def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = monitoring.latency_histogram(load(spark, sf_dir, "access_log"), ["method", "endpoint"], F.col("latency_s"))
    return wide.select("method", "endpoint", F.col("le").cast("string").alias("le"), "cumulative_count", *r6("latency_sum"), "latency_count")


def format_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display texts of every job: duration, age, identifiers and digests."""
    jobs = monitoring.with_duration(load(spark, sf_dir, "jobs"))
    as_of = moment(AS_OF)
    return jobs.select(
        "id",
        text.duration_text(F.col("duration_seconds")).alias("duration"),
        text.relative_time_text(F.col("finished_at"), as_of).alias("age"),
        text.iso(F.col("created_at")).alias("created"),
        text.short_id(F.col("dataset_id"), 3).alias("short_dataset"),
        text.error_text(F.repeat("error_message", 300)).alias("error_message"),
        F.sha2("payload", 256).alias("payload_sha256"),
        text.integer_text(F.floor("duration_seconds") * 1000).alias("milliseconds"),
        text.percent_text(F.col("duration_seconds") / 4096).alias("share"),
        text.number_text(F.col("duration_seconds") / 4096, 2).alias("number"),
        text.file_suffix(F.concat(F.lit("run.d/"), "id", F.lit(".Tar.CSV"))).alias("suffix"),
        text.s3_bucket(F.concat(F.lit("s3://landing/"), "job_type", F.lit("/"), "id")).alias("bucket"),
        text.s3_key(F.concat(F.lit("s3://landing/"), "job_type", F.lit("/"), "id")).alias("object_key"),
        text.attempt_key(F.concat(F.lit("  User"), "id", F.lit("@X.test ")), F.lit("10.0.0.1"), F.concat(F.lit(" 1.2.3."), "id", F.lit(", 9.9.9.9"))).alias("attempt"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        model_usage, usage_total, stale_models, job_stats, job_durations, job_recent_failures, summary_recent_failures,
        monitoring_summary, monitoring_counters, error_counters, batch_counters, request_counters, prediction_counters, latency_histogram, format_text,
    )
}

_ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


def _iso(c: str, alias: str | None = None) -> str:
    return f"{_ISO.format(c=c)} AS {alias or c}"


_USAGE = """usage AS (
    SELECT p.model_version_id, m.version_label, m.algorithm, m.stage, p.n AS prediction_count, p.f, p.l
    FROM (SELECT model_version_id, CAST(count(*) AS BIGINT) AS n, min(created_at) AS f, max(created_at) AS l FROM predictions GROUP BY 1) p
    LEFT JOIN model_versions m ON m.id = p.model_version_id)"""
_SECONDS = "(epoch_us(finished_at) - epoch_us(started_at)) / 1e6"

_ERRORS = "errors AS (SELECT CASE WHEN status_code = 500 THEN 'model_unavailable' ELSE 'validation' END AS reason FROM access_log WHERE status_code >= 400)"
_BATCHES = f"""batches AS (SELECT CASE WHEN count(*) <= {INLINE_RECORDS} THEN 'sync' ELSE 'async' END AS mode
    FROM predictions GROUP BY request_id HAVING count(*) > 1)"""

ORACLES = {
    "error_counters": with_tables(
        f"""WITH {_ERRORS} SELECT reason, CAST(count(*) AS BIGINT) AS n, FALSE AS is_total FROM errors GROUP BY 1
        UNION ALL SELECT NULL, CAST(count(*) AS BIGINT), TRUE FROM errors""", "access_log",
    ),
    "batch_counters": with_tables(
        f"""WITH {_BATCHES} SELECT mode, CAST(count(*) AS BIGINT) AS n, FALSE AS is_total FROM batches GROUP BY 1
        UNION ALL SELECT NULL, CAST(count(*) AS BIGINT), TRUE FROM batches""", "predictions",
    ),
    "monitoring_counters": with_tables(
        f"""WITH {_ERRORS}, {_BATCHES}, events AS (
          SELECT 'predictions' AS metric, model_version_id AS label FROM predictions
          UNION ALL SELECT 'prediction_errors', reason FROM errors UNION ALL SELECT 'batch_predictions', mode FROM batches)
        SELECT metric, label, CAST(count(*) AS BIGINT) AS n, FALSE AS is_total FROM events GROUP BY 1, 2
        UNION ALL SELECT metric, NULL, CAST(count(label) AS BIGINT), TRUE FROM (SELECT * FROM events UNION ALL
          VALUES ('predictions', NULL), ('prediction_errors', NULL), ('batch_predictions', NULL)) e GROUP BY 1""",
        "predictions", "access_log",
    ),
    "model_usage": with_tables(
        f"""WITH {_USAGE} SELECT model_version_id, version_label, algorithm, stage, prediction_count,
            round(100.0 * prediction_count / sum(prediction_count) OVER (), 6) AS percentage_of_total,
            {_iso('f', 'first_prediction_at')}, {_iso('l', 'last_prediction_at')} FROM usage""",
        "predictions", "model_versions",
    ),
    "usage_total": with_tables(
        "SELECT CAST(count(*) AS BIGINT) AS total_predictions, CAST(count(DISTINCT model_version_id) AS BIGINT) AS n_versions FROM predictions",
        "predictions",
    ),
    "stale_models": with_tables(
        f"""WITH {_USAGE} SELECT model_version_id, version_label, stage, {_iso('l', 'last_prediction_at')} FROM usage
        WHERE stage <> 'production' AND l >= (SELECT max(promoted_at) FROM model_versions WHERE stage = 'production')""",
        "predictions", "model_versions",
    ),
    "job_stats": with_tables(
        f"""SELECT CAST(count(*) AS BIGINT) AS total_jobs, CAST(count(*) FILTER (status = 'completed') AS BIGINT) AS completed_jobs,
            CAST(count(*) FILTER (status = 'failed') AS BIGINT) AS failed_jobs,
            CAST(count(*) FILTER (status IN ('queued', 'running')) AS BIGINT) AS active_jobs,
            round(avg({_SECONDS}) FILTER (status = 'completed'), 6) AS average_training_duration_seconds,
            CAST(count({_SECONDS}) FILTER (status = 'completed') AS BIGINT) AS n_durations_sampled
        FROM jobs WHERE job_type = 'train'""", "jobs",
    ),
    "job_durations": with_tables(f"SELECT id, job_type, round({_SECONDS}, 6) AS duration_seconds FROM jobs", "jobs"),
    "job_recent_failures": with_tables(
        f"""SELECT id AS job_id, dataset_id, error_message, {_iso('created_at')}, {_iso('finished_at')} FROM (
            SELECT * FROM jobs WHERE job_type = 'train' AND status = 'failed' ORDER BY jobs.created_at DESC, id LIMIT 5) j""", "jobs",
    ),
    "summary_recent_failures": with_tables(
        f"""SELECT id AS job_id, job_type, error_message, {_iso('created_at')} FROM (
            SELECT * FROM jobs WHERE status = 'failed' AND created_at >= TIMESTAMP '{JOBS_AS_OF}' - INTERVAL 24 HOUR
            ORDER BY jobs.created_at DESC, id LIMIT 5) j""", "jobs",
    ),
    "monitoring_summary": with_tables(
        f"""WITH {_USAGE}
        SELECT (SELECT version_label FROM model_versions WHERE stage = 'production') AS production_version, CAST(24 AS DOUBLE) AS recent_window_hours,
            (SELECT CAST(count(*) AS BIGINT) FROM predictions WHERE created_at >= TIMESTAMP '{JOBS_AS_OF}' - INTERVAL 24 HOUR) AS recent_prediction_count,
            (SELECT CAST(count(*) AS BIGINT) FROM access_log WHERE status_code = 500) AS prediction_error_count,
            (SELECT CAST(count(*) AS BIGINT) FROM predictions) AS total_predictions,
            CASE WHEN (SELECT prediction_count FROM usage WHERE stage = 'production') >= 100 THEN 'ok' ELSE 'insufficient_data' END AS drift_status,
            (SELECT CAST(count(*) AS BIGINT) FROM jobs WHERE job_type = 'train' AND status IN ('queued', 'running')) AS active_training_jobs,
            (SELECT coalesce(string_agg(id, ',' ORDER BY id), '') FROM (SELECT id FROM jobs WHERE status = 'failed'
               AND created_at >= TIMESTAMP '{JOBS_AS_OF}' - INTERVAL 24 HOUR ORDER BY created_at DESC, id LIMIT 5) f) AS recent_failed_jobs,
            (SELECT CAST(count(*) AS BIGINT) FROM jobs WHERE job_type = 'train') AS total_jobs,
            (SELECT round(avg({_SECONDS}), 6) FROM jobs WHERE job_type = 'train' AND status = 'completed') AS average_duration,
            (SELECT CAST(count(*) AS BIGINT) FROM usage) AS n_versions_used,
            (SELECT model_version_id FROM usage ORDER BY prediction_count DESC, model_version_id LIMIT 1) AS most_used_version,
            (SELECT CAST(count(*) AS BIGINT) FROM (SELECT request_id FROM predictions GROUP BY 1 HAVING count(*) > 1) b) AS total_batch_requests""",
        "predictions", "model_versions", "jobs", "access_log",
    ),
    "request_counters": with_tables(
        """WITH c AS (SELECT method, endpoint, status_code, CAST(count(*) AS BIGINT) AS n FROM access_log GROUP BY 1, 2, 3)
        SELECT *, FALSE AS is_total FROM c UNION ALL SELECT NULL, NULL, NULL, CAST(sum(n) AS BIGINT), TRUE FROM c""", "access_log",
    ),
    "prediction_counters": with_tables(
        f"""WITH {_USAGE}, c AS (SELECT version_label, algorithm, CAST(sum(prediction_count) AS BIGINT) AS n FROM usage GROUP BY 1, 2)
        SELECT *, FALSE AS is_total FROM c UNION ALL SELECT NULL, NULL, CAST(sum(n) AS BIGINT), TRUE FROM c""",
        "predictions", "model_versions",
    ),
    "latency_histogram": with_tables(
        """WITH b(le, bound) AS (VALUES """ + ", ".join(
            f"('{'Infinity' if b == float('inf') else b}', CAST('{b}' AS DOUBLE))" for b in monitoring.LATENCY_BOUNDS
        ) + """)
        SELECT method, endpoint, le, CAST(count(*) FILTER (latency_s <= bound) AS BIGINT) AS cumulative_count,
               round(sum(latency_s), 6) AS latency_sum, CAST(count(*) AS BIGINT) AS latency_count
        FROM access_log, b GROUP BY 1, 2, 3""", "access_log",
    ),
    "format_text": with_tables(
        f"""WITH j AS (SELECT *, {_SECONDS} AS s, round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(finished_at)) / 1e6) AS sec FROM jobs),
        k AS (SELECT *, round(sec / 60) AS mi FROM j), l AS (SELECT *, round(mi / 60) AS ho FROM k)
        SELECT id,
          CASE WHEN s IS NULL THEN '—' WHEN s < 60 THEN printf('%.1fs', s)
               ELSE CAST(floor(s / 60) AS INT) || 'm ' || CAST(round(s - floor(s / 60) * 60) AS INT) || 's' END AS duration,
          CASE WHEN finished_at IS NULL THEN '—' WHEN sec < 5 THEN 'just now' WHEN sec < 60 THEN CAST(sec AS INT) || 's ago'
               WHEN mi < 60 THEN CAST(mi AS INT) || 'm ago' WHEN ho < 24 THEN CAST(ho AS INT) || 'h ago'
               ELSE CAST(round(ho / 24) AS INT) || 'd ago' END AS age,
          {_iso('created_at', 'created')}, CASE WHEN dataset_id <> '' THEN substring(dataset_id, 1, 3) ELSE '—' END AS short_dataset,
          substring(repeat(error_message, 300), 1, 2000) AS error_message, sha256(payload) AS payload_sha256,
          CASE WHEN s IS NULL THEN '—' ELSE format('{{:,}}', CAST(floor(s) * 1000 AS BIGINT)) END AS milliseconds,
          CASE WHEN s IS NULL THEN '—' ELSE printf('%.1f', round(s / 4096 * 100, 1)) || '%' END AS share,
          CASE WHEN s IS NULL THEN '—' ELSE printf('%.2f', round(s / 4096, 2)) END AS "number",
          '.csv' AS suffix, 'landing' AS bucket, job_type || '/' || id AS object_key,
          'user' || id || '@x.test:1.2.3.' || id AS attempt
        FROM l""", "jobs",
    ),
}
