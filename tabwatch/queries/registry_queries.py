"""Registry queries over versions derived from the suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.functions import text
from tabwatch.operators import listing, registry
from tabwatch.queries.tables import load, moment, r6, with_tables

NOW = "2001-12-01 00:00:00"


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "model_versions")


def _verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with an artifact: suppliers that shipped anything."""
    return load(spark, sf_dir, "lineitem").select(F.concat(F.lit("run-"), F.col("l_suppkey").cast("string")).alias("run_id")).where(
        "l_linenumber = 7"
    ).distinct()


def _policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.promotion_policy(_versions(spark, sf_dir), load(spark, sf_dir, "datasets"), _verified(spark, sf_dir))


def _first_eligible(spark: SparkSession, sf_dir: str) -> str:
    return _policy(spark, sf_dir).where("eligible").agg(F.min("id")).head()[0]


def _state(versions: DataFrame) -> DataFrame:
    return versions.select("id", "version_label", "stage", text.iso(F.col("promoted_at")).alias("promoted_at"))


def _events(events: DataFrame) -> DataFrame:
    return events.select(
        "model_version_id", "action", "previous_stage", "new_stage", "triggered_by",
        F.element_at("event_metadata", "reason").alias("reason"), text.iso(F.col("created_at")).alias("created_at"), "seq",
    )


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every market segment's customers train one new candidate."""
    customers = load(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("balance")
    )
    metric = F.col("balance") / 10000
    metrics = F.struct(*[metric.alias(m) for m in ("accuracy", "precision", "recall", "f1", "roc_auc")])
    return customers.select(
        F.concat(F.lit("new-"), "c_mktsegment").alias("id"), F.lit("xgboost").alias("algorithm"),
        F.concat(F.lit("run-new-"), "c_mktsegment").alias("mlflow_run_id"), F.lit("1").alias("mlflow_experiment_id"),
        F.concat(F.lit("runs:/run-new-"), F.col("c_mktsegment"), F.lit("/model")).alias("artifact_uri"),
        F.lit("deadbeef").alias("git_commit"), F.lit("1").alias("dataset_id"), F.lit("1").alias("training_job_id"),
        metrics.alias("metrics"), F.col("n").alias("ordinal"),
    )


def registry_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions, _ = registry.register(_versions(spark, sf_dir), _candidates(spark, sf_dir), as_of=moment(NOW))
    return _state(versions)


def registry_register_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, events = registry.register(_versions(spark, sf_dir), _candidates(spark, sf_dir), as_of=moment(NOW))
    return _events(events)


def promotion_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _policy(spark, sf_dir).select("id", "eligible", "reason")


def registry_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions, _ = registry.promote(_versions(spark, sf_dir), _first_eligible(spark, sf_dir), _policy(spark, sf_dir), as_of=moment(NOW))
    return _state(versions)


def registry_promote_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, events = registry.promote(_versions(spark, sf_dir), _first_eligible(spark, sf_dir), _policy(spark, sf_dir), as_of=moment(NOW))
    return _events(events)


def registry_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(registry.rollback(_versions(spark, sf_dir), as_of=moment(NOW))[0])


def registry_rollback_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(registry.rollback(_versions(spark, sf_dir), as_of=moment(NOW), triggered_by="admin")[1])


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log of the whole registry: registration of each version and, if it ever went live, its promotion."""
    versions = _versions(spark, sf_dir)
    registered = versions.select(
        F.col("id").alias("model_version_id"), F.lit("registered").alias("action"), F.lit(None).cast("string").alias("previous_stage"),
        F.lit("candidate").alias("new_stage"), F.lit("system").alias("triggered_by"),
        F.lit(None).cast("map<string,string>").alias("event_metadata"), "created_at", F.lit(0).alias("seq"),
    )
    live = versions.where(F.col("promoted_at").isNotNull()).select(
        F.col("id").alias("model_version_id"), F.lit("promoted").alias("action"), F.lit("candidate").alias("previous_stage"),
        F.lit("production").alias("new_stage"), F.lit("api").alias("triggered_by"),
        F.lit(None).cast("map<string,string>").alias("event_metadata"), F.col("promoted_at").alias("created_at"), F.lit(3).alias("seq"),
    )
    return registered.unionByName(live)


def registry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(registry.event_history(_history(spark, sf_dir)))


def registry_stage_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.stages_from_events(_history(spark, sf_dir), _versions(spark, sf_dir))


def registry_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.violations(_versions(spark, sf_dir))


def production_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.production(_versions(spark, sf_dir)).select("id", "version_label", "algorithm", "stage")


def registry_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = listing.newest_first(listing.where_equal(_versions(spark, sf_dir), stage="candidate").select(*listing.MODEL_SUMMARY))
    return found.select(
        "id", "version_label", "algorithm", "stage", F.round("metrics.roc_auc", 6).alias("roc_auc"), "dataset_id", "training_job_id",
        text.iso(F.col("created_at")).alias("created_at"),
    )


def registry_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.metrics_rows(_versions(spark, sf_dir)).select("id", "metric", *r6("value"))


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best version per training dataset by ROC-AUC."""
    versions = _versions(spark, sf_dir).where("dataset_id IS NOT NULL").withColumn("ordinal", F.col("id").cast("bigint"))
    return registry.best_candidates(versions, "dataset_id").withColumn("best_test_roc_auc", F.round("best_test_roc_auc", 6))


QUERIES = {
    f.__name__: f
    for f in (
        registry_register, registry_register_events, promotion_policy, registry_promote, registry_promote_events,
        registry_rollback, registry_rollback_events, registry_events, registry_stage_from_events, registry_invariants,
        production_model, registry_listing, registry_metrics, best_model,
    )
}


def _sql(body: str, *more: str) -> str:
    return with_tables(body, "model_versions", *more)


def _iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


_NOW = f"TIMESTAMP '{NOW}'"
_NEW = """fresh AS (SELECT concat('new-', c_mktsegment) AS id, row_number() OVER (ORDER BY count(*), concat('new-', c_mktsegment)) AS rn
    FROM customer GROUP BY c_mktsegment)"""
_POLICY = """policy AS (
    SELECT m.*, CASE
      WHEN stage <> 'candidate' THEN concat('Model version ', m.id, ' is not a candidate (current stage: ', stage, '); only candidates can be promoted.')
      WHEN dataset_id IS NULL THEN 'Candidate has no linked training dataset.'
      WHEN NOT EXISTS (SELECT 1 FROM datasets d WHERE d.id = m.dataset_id AND d.is_valid) THEN 'Candidate''s training dataset is missing or failed validation.'
      WHEN m_f1 IS NULL THEN 'Candidate is missing required evaluation metric(s): [''f1''].'
      WHEN mlflow_run_id NOT IN (SELECT concat('run-', CAST(l_suppkey AS STRING)) FROM lineitem WHERE l_linenumber = 7)
        THEN concat('Candidate''s MLflow artifact could not be verified for run ', mlflow_run_id, '; refusing to promote an unverifiable model.')
      END AS reason FROM model_versions m),
    chosen AS (SELECT min(id) AS id FROM policy WHERE reason IS NULL)"""
_EVENT = "model_version_id, action, previous_stage, new_stage, triggered_by, reason, created_at, seq"
_HISTORY = """history AS (
    SELECT id AS model_version_id, 'registered' AS action, CAST(NULL AS VARCHAR) AS previous_stage, 'candidate' AS new_stage,
           'system' AS triggered_by, created_at AS happened, 0 AS seq FROM model_versions
    UNION ALL SELECT id, 'promoted', 'candidate', 'production', 'api', promoted_at, 3 FROM model_versions WHERE promoted_at IS NOT NULL)"""

ORACLES = {
    "registry_register": _sql(
        f"""WITH {_NEW} SELECT id, version_label, stage, {_iso('promoted_at')} AS promoted_at FROM model_versions
        UNION ALL SELECT id, concat('v', CAST(rn + (SELECT count(*) FROM model_versions) AS STRING)), 'candidate', NULL FROM fresh"""
    ),
    "registry_register_events": _sql(
        f"""WITH {_NEW} SELECT id AS model_version_id, 'registered' AS action, CAST(NULL AS VARCHAR) AS previous_stage, 'candidate' AS new_stage,
        'system' AS triggered_by, CAST(NULL AS VARCHAR) AS reason, {_iso(_NOW)} AS created_at, 0 AS seq FROM fresh"""
    ),
    "promotion_policy": _sql(f"WITH {_POLICY} SELECT id, reason IS NULL AS eligible, reason FROM policy", "datasets"),
    "registry_promote": _sql(
        f"""WITH {_POLICY} SELECT m.id, version_label,
          CASE WHEN m.id = c.id THEN 'production' WHEN stage = 'production' THEN 'previous' WHEN stage = 'previous' THEN 'archived' ELSE stage END AS stage,
          CASE WHEN m.id = c.id THEN {_iso(_NOW)} ELSE {_iso('promoted_at')} END AS promoted_at FROM model_versions m, chosen c""", "datasets",
    ),
    "registry_promote_events": _sql(
        f"""WITH {_POLICY}, why AS (SELECT concat('superseded by promotion of ', id) AS reason, {_iso(_NOW)} AS created_at FROM chosen)
        SELECT m.id AS model_version_id, 'archived' AS action, 'previous' AS previous_stage, 'archived' AS new_stage, 'api' AS triggered_by,
               reason, why.created_at, 1 AS seq FROM model_versions m, why WHERE stage = 'previous'
        UNION ALL SELECT m.id, 'demoted_to_previous', 'production', 'previous', 'api', reason, why.created_at, 2 FROM model_versions m, why WHERE stage = 'production'
        UNION ALL SELECT id, 'promoted', 'candidate', 'production', 'api', NULL, why.created_at, 3 FROM chosen, why""", "datasets",
    ),
    "registry_rollback": _sql(
        f"""SELECT id, version_label, CASE stage WHEN 'production' THEN 'previous' WHEN 'previous' THEN 'production' ELSE stage END AS stage,
        CASE WHEN stage = 'previous' THEN {_iso(_NOW)} ELSE {_iso('promoted_at')} END AS promoted_at FROM model_versions"""
    ),
    "registry_rollback_events": _sql(
        f"""SELECT id AS model_version_id, 'rolled_back' AS action, 'production' AS previous_stage, 'previous' AS new_stage, 'admin' AS triggered_by,
               concat('rolled back in favor of ', (SELECT id FROM model_versions WHERE stage = 'previous')) AS reason, {_iso(_NOW)} AS created_at, 1 AS seq
        FROM model_versions WHERE stage = 'production'
        UNION ALL SELECT id, 'rolled_back', 'previous', 'production', 'admin', NULL, {_iso(_NOW)}, 2 FROM model_versions WHERE stage = 'previous'"""
    ),
    "registry_events": _sql(
        f"""WITH {_HISTORY} SELECT model_version_id, action, previous_stage, new_stage, triggered_by, CAST(NULL AS VARCHAR) AS reason,
        {_iso('happened')} AS created_at, seq FROM history"""
    ),
    "registry_stage_from_events": _sql(
        f"""WITH {_HISTORY}, last AS (SELECT model_version_id, new_stage FROM history QUALIFY row_number() OVER (PARTITION BY model_version_id ORDER BY happened DESC, seq DESC) = 1)
        SELECT m.id, m.stage, new_stage AS event_stage, m.stage = new_stage AS consistent FROM model_versions m LEFT JOIN last ON model_version_id = m.id"""
    ),
    "registry_invariants": _sql(
        """SELECT 'one_' || stage AS rule, stage AS value, CAST(count(*) AS BIGINT) AS n FROM model_versions WHERE stage IN ('production', 'previous') GROUP BY stage HAVING count(*) > 1
        UNION ALL SELECT 'unique_run_id', mlflow_run_id, CAST(count(*) AS BIGINT) FROM model_versions GROUP BY mlflow_run_id HAVING count(*) > 1"""
    ),
    "production_model": _sql("SELECT id, version_label, algorithm, stage FROM model_versions WHERE stage = 'production'"),
    "registry_listing": _sql(
        f"""SELECT id, version_label, algorithm, stage, round(m_roc_auc, 6) AS roc_auc, dataset_id, training_job_id, {_iso('created_at')} AS created_at
        FROM model_versions WHERE stage = 'candidate'"""
    ),
    "registry_metrics": _sql(
        " UNION ALL ".join(
            f"SELECT id, 'test_{m}' AS metric, round(m_{m}, 6) AS value FROM model_versions WHERE m_{m} IS NOT NULL"
            for m in ("accuracy", "precision", "recall", "f1", "roc_auc")
        )
    ),
    "best_model": _sql(
        """SELECT dataset_id, id AS best_model_version_id, algorithm AS best_algorithm, round(m_roc_auc, 6) AS best_test_roc_auc FROM model_versions
        WHERE dataset_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY m_roc_auc DESC, CAST(id AS BIGINT)) = 1"""
    ),
}
