"""Training and scoring queries over the raw line-item dataset. Models are fitted: the SQL checks all but their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.plans import jobs as jobs_plan
from tabwatch.plans import scoring, train
from tabwatch.queries import feature_queries
from tabwatch.queries.feature_queries import _RAW, SPEC, raw_rows
from tabwatch.queries.tables import load, moment, with_tables
from tabwatch.schema import RUNS, TrainingConfig
from tabwatch.session import new_workspace

CONFIG = TrainingConfig(random_forest_n_estimators=10, random_forest_max_depth=6, xgboost_n_estimators=8, xgboost_max_depth=3)
NOW = "2001-12-01 00:00:00"
SPLIT_SQL = feature_queries.ORACLES["stratified_split"]


def _report(spark: SparkSession, sf_dir: str, algorithm: str) -> DataFrame:
    """Rows and positives of each held-out fold from the confusion matrix, and whether a signal was learned."""
    report = train.train_models(raw_rows(spark, sf_dir), SPEC, CONFIG, algorithms=[algorithm]).report
    positives = F.col("false_negative") + F.col("true_positive")
    return report.select(
        "algorithm", "split", (positives + F.col("true_negative") + F.col("false_positive")).alias("n_rows"),
        positives.alias("n_positive"), (F.col("roc_auc") > 0.6).alias("learned"),
    )


def train_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "logistic_regression")


def train_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "random_forest")


def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "xgboost")


def _registered(spark: SparkSession, sf_dir: str, root: str):
    versions = load(spark, sf_dir, "model_versions").withColumn("params", F.lit(None).cast("map<string,string>"))
    versions = versions.withColumn(
        "metrics",
        F.struct(
            *[F.col(f"metrics.{m}").alias(m) for m in ("accuracy", "precision", "recall", "f1", "roc_auc")],
            F.lit(None).cast("struct<true_negative:bigint,false_positive:bigint,false_negative:bigint,true_positive:bigint>").alias("confusion_matrix"),
        ),
    )
    return train.train_and_register(
        raw_rows(spark, sf_dir), versions, SPEC, CONFIG, root=root, dataset_id="1", content_hash="x", filename="lines.csv",
        as_of=moment(NOW), algorithms=["logistic_regression"], job_id="1",
    )


def train_and_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after one training job."""
    registered, _, _ = _registered(spark, sf_dir, new_workspace(spark, "train"))
    return registered.select("version_label", "algorithm", "stage", "dataset_id", "training_job_id")


def training_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs that a training job records, read back: what was trained on what, its metrics' names, its first input rows."""
    root = new_workspace(spark, "train")
    _registered(spark, sf_dir, root)
    runs = spark.read.schema(RUNS).parquet(f"{root}/runs")
    values = F.transform("input_sample", lambda m: F.array_join(F.array(*[m[c] for c in SPEC.contract.features]), "|", "-"))
    return runs.select(
        *[F.col("tags")[t].alias(t) for t in ("algorithm", "dataset_id", "dataset_content_hash", "schema_name", "training_job_id")],
        *[F.col("params")[p].cast("bigint").alias(p) for p in ("n_train_rows", "n_val_rows", "n_test_rows")],
        F.array_join(F.sort_array(F.map_keys("metrics")), ",").alias("metric_names"), F.array_join(values, ";").alias("input_sample"),
    )


def run_hyperparameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parameters recorded for each algorithm at the declared sizes, one row each; one follows from the training fold."""
    fold = feature_queries.stratified_rows(spark, sf_dir).where("split = 'train'")
    scale = train.ClassBalance.of(fold).scale_pos_weight
    rows = [(a, name, value) for a in train.ESTIMATORS for name, value in train.hyperparameters(a, TrainingConfig(), scale).items()]
    return spark.createDataFrame(rows, "algorithm string, name string, value string")


def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items scored by a freshly trained, saved and re-loaded model: the log read back, and the refused records."""
    root = new_workspace(spark, "score")
    _, _, candidates = _registered(spark, sf_dir, root)
    uri, version = candidates.select("artifact_uri", "id").head()
    scored, rejected = scoring.score(
        raw_rows(spark, sf_dir), train.load_model(spark, uri), SPEC, model_version_id=version, request_id="batch-1",
        record_key=["row_key"], as_of=moment(NOW), integers=["quantity"],
    )
    scoring.run_batch(scored, f"{root}/predictions", rejected.withColumn("request_id", F.lit("batch-1")), f"{root}/rejected")
    log, refused = spark.read.parquet(f"{root}/predictions"), spark.read.parquet(f"{root}/rejected")
    return scoring.outcomes(log, refused, "row_key", SPEC.contract.labels)


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "jobs").withColumn("result", F.lit(None).cast("string"))


def _stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is in the storage: some datasets' files are missing, some have changed."""
    return load(spark, sf_dir, "datasets").where("n_rows % 110 <> 0").selectExpr(
        "storage_path", "CASE WHEN n_rows % 70 = 0 THEN md5(content_hash) ELSE content_hash END AS sha256"
    )


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates left behind by jobs: an order's first lines, at most one for each algorithm."""
    return load(spark, sf_dir, "job_candidates").withColumn("metrics", F.struct("roc_auc"))


def _after_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs, candidates = _jobs(spark, sf_dir), _candidates(spark, sf_dir)
    steps = jobs_plan.training_steps(jobs, load(spark, sf_dir, "datasets"), _stored_files(spark, sf_dir), candidates)
    return jobs_plan.advance_training(jobs, steps, candidates, moment(NOW)).where("job_type = 'train'")


def _plain(field: str) -> F.Column:
    return F.translate(F.get_json_object("result", f"$.{field}"), '[]"', "").alias(field)


def _times() -> list:
    return [(F.col("started_at") == moment(NOW)).alias("just_started"), (F.col("finished_at") == moment(NOW)).alias("just_finished")]


def jobs_after_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training jobs that did not fail, after open ones were advanced by the candidates they left behind."""
    done = _after_training(spark, sf_dir).where("status <> 'failed'")
    fields = ("candidate_model_version_ids", "algorithms_trained", "best_algorithm", "best_model_version_id")
    auc = F.get_json_object("result", "$.best_test_roc_auc").cast("double").alias("best_test_roc_auc")
    return done.select("id", "status", *map(_plain, fields), auc, *_times())


def jobs_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed training jobs with the reason and the candidates left behind, those included that the check of files stops."""
    failed = _after_training(spark, sf_dir).where("status = 'failed'")
    return failed.select("id", "error_message", _plain("partial_candidate_model_version_ids"), *_times())


def jobs_after_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batch jobs, open ones advanced by what the prediction log holds of them."""
    done = jobs_plan.advance_scoring(_jobs(spark, sf_dir), load(spark, sf_dir, "model_versions"), load(spark, sf_dir, "predictions"), moment(NOW))
    return done.where("job_type = 'batch_predict'").select("id", "status", "result", "error_message", *_times())


def batch_prediction_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.batch_result(load(spark, sf_dir, "predictions"))


QUERIES = {
    f.__name__: f
    for f in (
        train_lr, train_rf, train_gbt, train_and_register, training_runs, run_hyperparameters, batch_score, jobs_after_training, jobs_after_failure, jobs_after_scoring,
        batch_prediction_ids,
    )
}


def outcome_sql(request: str) -> str:
    """Every raw row, scored or refused, by the rules of the input contract."""
    return f"""SELECT CASE WHEN refused = '' THEN md5(concat('{request}|', row_key)) END AS id, CASE WHEN refused <> '' THEN row_key END AS record,
        '{request}' AS request_id, refused = '' AS scored, refused
    FROM (SELECT row_key, concat_ws('; ', CASE WHEN flag IS NULL THEN 'flag: required' END,
              CASE WHEN total IN ('', 'n/k') THEN 'total: not a number' END, CASE WHEN unit IS NULL THEN 'unit: required' END) AS refused
          FROM ({_RAW.format(lineitem='lineitem')}) raw) r"""


_SCALARS = ("accuracy", "confusion_matrix_false_negative", "confusion_matrix_false_positive", "confusion_matrix_true_negative",
            "confusion_matrix_true_positive", "f1", "precision", "recall", "roc_auc")
_METRIC_NAMES = ",".join(f"{split}_{m}" for split in ("test", "val") for m in _SCALARS)
_VALUES = ", ".join(f"coalesce({c}, '-')" for c in SPEC.contract.features)
_NULLS_FIRST = ", ".join(f"{c} NULLS FIRST" for c in SPEC.contract.features)


def _report_sql(algorithm: str) -> str:
    return f"""SELECT '{algorithm}' AS algorithm, split, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive, TRUE AS learned
        FROM ({SPLIT_SQL}) s WHERE split <> 'train' GROUP BY split"""


def _advanced_sql(body: str) -> str:
    """Training jobs with the error that stops an open one and the candidates it has."""
    return with_tables(
        f"""WITH made AS (
            SELECT training_job_id AS job, string_agg(id, ',' ORDER BY ordinal, id) AS ids, string_agg(id, ',' ORDER BY id) AS ids_by_name,
                string_agg(algorithm, ',' ORDER BY ordinal, id) AS algorithms, count(DISTINCT algorithm) AS n_made,
                max(CASE WHEN algorithm = 'xgboost' THEN 1 ELSE 0 END) AS boosted, max(roc_auc) AS best_auc,
                first(algorithm ORDER BY roc_auc DESC, ordinal) AS best_algorithm, first(id ORDER BY roc_auc DESC, ordinal) AS best_id
            FROM job_candidates GROUP BY 1),
        advanced AS (
            SELECT j.id, j.error_message, m.*, CASE WHEN j.status IN ('queued', 'running') THEN 'open' ELSE j.status END AS now, j.status = 'queued' AS began,
                CASE WHEN j.payload LIKE '%null%' THEN 3 - coalesce(n_made, 0) ELSE 1 - coalesce(boosted, 0) END AS missing,
                CASE WHEN j.status NOT IN ('queued', 'running') THEN NULL
                    WHEN d.id IS NULL THEN concat('Dataset ', j.dataset_id, ' not found.')
                    WHEN NOT d.is_valid THEN concat('Dataset ', d.id, ' failed validation at ingestion and cannot be used for training.')
                    WHEN d.n_rows % 110 = 0 THEN concat('Dataset file is missing: ', d.storage_path)
                    WHEN d.n_rows % 70 = 0 THEN concat('Dataset ', d.id, ' content hash mismatch: recorded ', content_hash, ', file on disk now hashes to ',
                        md5(content_hash), '. The file may have been modified since ingestion — refusing to train on it.') END AS error
            FROM jobs j LEFT JOIN datasets d ON d.id = j.dataset_id LEFT JOIN made m ON m.job = j.id WHERE j.job_type = 'train')
        {body}""", "jobs", "datasets", "job_candidates",
    )


ORACLES = {
    "train_lr": _report_sql("logistic_regression"),
    "train_rf": _report_sql("random_forest"),
    "train_gbt": _report_sql("xgboost"),
    "train_and_register": with_tables(
        """SELECT version_label, algorithm, stage, dataset_id, training_job_id FROM model_versions
        UNION ALL SELECT concat('v', CAST(count(*) + 1 AS VARCHAR)), 'logistic_regression', 'candidate', '1', '1' FROM model_versions""",
        "model_versions",
    ),
    "training_runs": f"""SELECT 'logistic_regression' AS algorithm, '1' AS dataset_id, 'x' AS dataset_content_hash, '{SPEC.contract.name}' AS schema_name,
            '1' AS training_job_id, n_train_rows, n_val_rows, n_test_rows, '{_METRIC_NAMES}' AS metric_names, input_sample
        FROM (SELECT count(*) FILTER (split = 'train') AS n_train_rows, count(*) FILTER (split = 'val') AS n_val_rows,
                  count(*) FILTER (split = 'test') AS n_test_rows FROM ({SPLIT_SQL}) s) n,
             (SELECT string_agg(concat_ws('|', {_VALUES}), ';' ORDER BY place) AS input_sample
              FROM (SELECT *, row_number() OVER (ORDER BY row_key, {_NULLS_FIRST}) AS place FROM ({_RAW.format(lineitem='lineitem')}) r) WHERE place <= 3) f""",
    "run_hyperparameters": f"""SELECT * FROM (VALUES
            ('logistic_regression', 'C', '1.0'), ('logistic_regression', 'max_iter', '1000'), ('logistic_regression', 'class_weight', 'balanced'),
            ('random_forest', 'n_estimators', '300'), ('random_forest', 'max_depth', 'None'), ('random_forest', 'min_samples_leaf', '2'),
            ('random_forest', 'class_weight', 'balanced'), ('xgboost', 'n_estimators', '300'), ('xgboost', 'max_depth', '5'),
            ('xgboost', 'learning_rate', '0.1'), ('xgboost', 'subsample', '0.9')) v(algorithm, name, value)
        UNION ALL SELECT 'xgboost', 'scale_pos_weight', CAST(round(CAST(count(*) FILTER (label = 0) AS DOUBLE) / count(*) FILTER (label = 1), 4) AS VARCHAR)
        FROM ({SPLIT_SQL}) s WHERE split = 'train'""",
    "batch_score": outcome_sql("batch-1"),
    "jobs_after_training": _advanced_sql(
        """SELECT id, CASE WHEN now = 'open' THEN CASE WHEN missing = 0 THEN 'completed' ELSE 'running' END ELSE now END AS status,
            CASE WHEN complete THEN ids END AS candidate_model_version_ids, CASE WHEN complete THEN algorithms END AS algorithms_trained,
            CASE WHEN complete THEN best_algorithm END AS best_algorithm, CASE WHEN complete THEN best_id END AS best_model_version_id,
            CASE WHEN complete THEN best_auc END AS best_test_roc_auc,
            CASE WHEN now = 'queued' THEN NULL WHEN began THEN TRUE ELSE FALSE END AS just_started, CASE WHEN complete THEN TRUE WHEN now = 'completed' THEN FALSE END AS just_finished
        FROM (SELECT *, now = 'open' AND missing = 0 AS complete FROM advanced WHERE error IS NULL AND now <> 'failed') x"""
    ),
    "jobs_after_failure": _advanced_sql(
        """SELECT id, CASE WHEN now = 'failed' THEN error_message ELSE error END AS error_message,
            CASE WHEN now = 'open' THEN ids_by_name END AS partial_candidate_model_version_ids,
            CASE WHEN began THEN TRUE ELSE FALSE END AS just_started, now = 'open' AS just_finished
        FROM advanced WHERE now = 'failed' OR error IS NOT NULL"""
    ),
    "jobs_after_scoring": with_tables(
        f"""SELECT id, CASE WHEN NOT is_open THEN status WHEN gone THEN 'failed' WHEN n >= size THEN 'completed' ELSE 'running' END AS status,
            CASE WHEN is_open AND NOT gone AND n >= size THEN concat('{{"n_processed":', CAST(n AS VARCHAR), '}}') END AS result,
            CASE WHEN is_open AND gone THEN concat('Pinned model version ', version, ' no longer exists.') ELSE error_message END AS error_message,
            status = 'queued' AS just_started,
            CASE WHEN is_open THEN CASE WHEN gone OR n >= size THEN TRUE END ELSE FALSE END AS just_finished
        FROM (SELECT j.*, status IN ('queued', 'running') AS is_open, o_orderkey % 3 + 1 AS size, CAST(o_custkey % 120 AS VARCHAR) AS version,
                  CAST(o_custkey % 120 AS VARCHAR) NOT IN (SELECT id FROM model_versions) AS gone, p.n
              FROM jobs j JOIN orders ON j.id = CAST(o_orderkey AS VARCHAR)
              LEFT JOIN (SELECT request_id, count(*) AS n FROM predictions GROUP BY 1) p ON p.request_id = j.id
              WHERE job_type = 'batch_predict') x""", "jobs", "model_versions", "predictions",
    ),
    "batch_prediction_ids": with_tables(
        "SELECT request_id, id AS prediction_id, count(*) OVER (PARTITION BY request_id) AS n_processed FROM predictions", "predictions"
    ),
}
