"""Training: preprocessing pipeline, the three classifiers, evaluation and registration."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.functions.text import error_text
from tabwatch.operators import evaluate, registry
from tabwatch.operators.features import HASHED_POSITIONS, FeatureSpec, FittedStatistics, feature_rows, fit_statistics, hashed_position
from tabwatch.operators.split import class_weights, stratified_split
from tabwatch.plans.newton import NewtonLogisticRegression
from tabwatch.schema import ALGORITHMS, METRICS, RUNS, DatasetContract, TrainingConfig
from tabwatch.session import stored
from tabwatch.sources import tables

PREPROCESSING = "numeric: median-impute + standard-scale; categorical: most-frequent-impute + one-hot"  # fixed value
_DEEPEST = 30  # Spark's limit; stands for "unlimited"
#: A categorical column with more categories in the training fold is encoded by hashed positions.
MAX_CATEGORIES = 1024


@dataclass(frozen=True)
class ClassBalance:
    n_neg: int
    n_pos: int
    weight_neg: float
    weight_pos: float
    scale_pos_weight: float

    @classmethod
    def of(cls, train: DataFrame) -> ClassBalance:
        return cls(**class_weights(train).head().asDict())

    def balanced(self) -> Column:
        return F.when(F.col("label") == 1, self.weight_pos).otherwise(self.weight_neg)

    def positives_scaled(self) -> Column:
        return F.when(F.col("label") == 1, self.scale_pos_weight).otherwise(1.0)


def _logistic_regression(config: TrainingConfig, balance: ClassBalance):
    # The penalised sum of weighted losses, C * sum(loss) + |b|^2 / 2, in terms of the weighted mean.
    total_weight = balance.n_neg * balance.weight_neg + balance.n_pos * balance.weight_pos
    penalty = 1.0 / config.logistic_regression_c
    general = LogisticRegression(
        maxIter=config.logistic_regression_max_iter, elasticNetParam=0.0, tol=1e-8, standardization=False,
        regParam=penalty / total_weight, weightCol="_balanced",
    )
    if not (balance.n_neg and balance.n_pos):
        return general  # with one label only the best intercept is infinite, which Spark's solver knows
    return NewtonLogisticRegression(penalty, config.logistic_regression_max_iter, "_balanced", wide=general)


def _random_forest(config: TrainingConfig, balance: ClassBalance):
    return RandomForestClassifier(
        numTrees=config.random_forest_n_estimators, maxDepth=min(config.random_forest_max_depth or _DEEPEST, _DEEPEST),
        minInstancesPerNode=config.random_forest_min_samples_leaf, featureSubsetStrategy="sqrt",
        weightCol="_balanced", seed=config.random_state,
    )


def _boosted_trees(config: TrainingConfig, balance: ClassBalance):
    return GBTClassifier(
        maxIter=config.xgboost_n_estimators, maxDepth=config.xgboost_max_depth, stepSize=config.xgboost_learning_rate,
        subsamplingRate=config.xgboost_subsample, weightCol="_scaled", seed=config.random_state,
    )


# Name to estimator factory; add an entry to offer another algorithm.
ESTIMATORS: dict[str, Callable[[TrainingConfig, ClassBalance], Any]] = {
    "logistic_regression": _logistic_regression,
    "random_forest": _random_forest,
    "xgboost": _boosted_trees,
}


def hyperparameters(algorithm: str, config: TrainingConfig, scale_pos_weight: float) -> dict[str, str]:
    """The parameters recorded with a run, as text."""
    prefix = f"{algorithm}_"
    own = {k[len(prefix):]: v for k, v in config.as_dict().items() if k.startswith(prefix)}
    if algorithm == "logistic_regression":
        own["C"] = own.pop("c")
    if algorithm == "xgboost":
        own["scale_pos_weight"] = round(scale_pos_weight, 4)
    else:
        own["class_weight"] = "balanced"
    return {k: str(v) for k, v in own.items()}


def check_algorithms(algorithms: Sequence[str]) -> None:
    unknown = sorted(set(algorithms) - set(ESTIMATORS))
    if unknown or not algorithms:
        raise ValueError(f"Unknown algorithm(s): {unknown}. Valid: {list(ESTIMATORS)}")


def _literal(value: float | str) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({value!r} AS DOUBLE)"


def preprocessing(spec: FeatureSpec, stats: FittedStatistics) -> Pipeline:
    """Impute, scale and one-hot encode to a `features` vector.

    The numeric block is SQL with the fitted numbers written in, so a saved pipeline needs no code of
    ours. Categories unseen in training encode to an all-zero block. A column with more than MAX_CATEGORIES
    categories is not indexed, which would take its categories to the driver: they get hashed positions, which
    some share (operators.features.hashed_collisions counts them), unseen ones as well.
    """
    scaled = [
        f"(coalesce(`{c}`, {_literal(stats.median[c])}) - {_literal(stats.mean[c])}) / {_literal(stats.std[c])} AS `{c}__z`"
        for c in spec.numeric
        if c in stats.median and stats.median[c] is not None
    ]
    numeric = [c for c in spec.numeric if stats.median.get(c) is not None]
    categorical = [c for c in spec.categorical if c in stats.mode]
    filled = [f"coalesce(`{c}`, {_literal(stats.mode[c])}) AS `{c}__filled`" for c in categorical]
    stages: list[Any] = [SQLTransformer(statement=f"SELECT *, {', '.join([*scaled, *filled])} FROM __THIS__")]
    hashed = [c for c in categorical if stats.n_categories[c] > MAX_CATEGORIES]
    listed = [c for c in categorical if c not in hashed]
    if listed:
        stages.append(
            StringIndexer(
                inputCols=[f"{c}__filled" for c in listed], outputCols=[f"{c}__index" for c in listed],
                handleInvalid="keep", stringOrderType="alphabetAsc",
            )
        )
        stages.append(
            OneHotEncoder(inputCols=[f"{c}__index" for c in listed], outputCols=[f"{c}__hot" for c in listed], dropLast=True)
        )
    if hashed:
        places = [f"CAST({hashed_position(f'`{c}__filled`', HASHED_POSITIONS)} AS DOUBLE) AS `{c}__place`" for c in hashed]
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(places)} FROM __THIS__"))
        stages.append(
            OneHotEncoder(
                inputCols=[f"{c}__place" for c in hashed], outputCols=[f"{c}__hot" for c in hashed], dropLast=True, handleInvalid="keep"
            )
        )
    stages.append(
        VectorAssembler(
            inputCols=[*[f"{c}__z" for c in numeric], *[f"{c}__hot" for c in categorical]], outputCol="features"
        )
    )
    return Pipeline(stages=stages)


def engineering(spec: FeatureSpec) -> SQLTransformer:
    added = ", ".join(f"{sql} AS `{name}`" for name, sql in spec.engineered.items())
    return SQLTransformer(statement=f"SELECT *{', ' + added if added else ''} FROM __THIS__")


def score_rows(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds prediction (0/1) and the positive class's probability to typed contract features."""
    out = model.transform(rows)
    return out.select(
        *rows.columns, F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability"),
    )


@dataclass(frozen=True)
class TrainedModel:
    algorithm: str
    model: PipelineModel
    hyperparams: dict[str, str]


@dataclass(frozen=True)
class TrainingOutcome:
    """Fitted pipelines, one evaluation row per (algorithm, split), and the split sizes."""

    models: list[TrainedModel]
    report: DataFrame
    sizes: dict[str, int]


def train_models(
    raw: DataFrame,
    spec: FeatureSpec,
    config: TrainingConfig = TrainingConfig(),
    *,
    algorithms: Sequence[str] = ALGORITHMS,
    key: Sequence[str] | None = None,
) -> TrainingOutcome:
    """Splits, fits the preprocessing on the training fold only, trains and evaluates each algorithm.

    The typed, split rows are kept, on memory and disk, as every later step reads them. Held-out rows are encoded and
    scored once for the report, which is small and taken out before the rows are released.
    """
    check_algorithms(algorithms)
    key = list(key or [spec.contract.id_column])
    plain = FeatureSpec(spec.contract, {})
    rows = feature_rows(raw, plain, keep=key)
    parts = stratified_split(rows, key, test_size=config.test_size, val_size=config.val_size, seed=config.random_state)
    engineer = engineering(spec)
    parts = engineer.transform(parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train = parts.where(F.col("split") == "train")
        stats = fit_statistics(train, spec)
        balance = ClassBalance.of(train)
        prepare = preprocessing(spec, stats).fit(train)
        encoded = prepare.transform(parts).select(
            "label", "split", "features", balance.balanced().alias("_balanced"), balance.positives_scaled().alias("_scaled")
        )
        models, scored = [], None
        for algorithm in algorithms:
            classifier = ESTIMATORS[algorithm](config, balance).fit(encoded.where(F.col("split") == "train"))
            models.append(
                TrainedModel(
                    algorithm,
                    PipelineModel(stages=[engineer, *prepare.stages, classifier]),
                    hyperparameters(algorithm, config, balance.scale_pos_weight),
                )
            )
            held_out = classifier.transform(encoded.where(F.col("split") != "train")).select(
                F.lit(algorithm).alias("algorithm"), "split", "label", F.col("prediction").cast("int").alias("prediction"),
                vector_to_array("probability")[1].alias("probability"),
            )
            scored = held_out if scored is None else scored.unionByName(held_out)
        report = evaluate.evaluation_report(stored(scored, "held-out"), ["algorithm", "split"])
        # Two rows per algorithm: taken to the driver so that the result outlives the kept rows.
        fixed = raw.sparkSession.createDataFrame(report.collect(), report.schema)
        sizes = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    finally:
        parts.unpersist()
    return TrainingOutcome(models, fixed, sizes)


def input_sample(raw: DataFrame, contract: DatasetContract, key: Sequence[str], rows: int = 3) -> list[dict[str, str | None]]:
    """The raw features of the first rows by `key`, as a run records them. A table has no order of its own."""
    features = [F.col(c).cast("string").alias(c) for c in contract.features]
    return [r.asDict() for r in raw.orderBy(*key, *contract.features).limit(rows).select(*features).collect()]


def train_and_register(
    raw: DataFrame,
    versions: DataFrame,
    spec: FeatureSpec,
    config: TrainingConfig = TrainingConfig(),
    *,
    root: str,
    dataset_id: str,
    content_hash: str,
    filename: str,
    as_of: Column,
    algorithms: Sequence[str] = ALGORITHMS,
    job_id: str | None = None,
    git_commit: str = "unknown",
    key: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(registry with the new candidates, their events, the candidates).

    Each model is saved below `root`/artifacts and its run appended to `root`/runs before it is
    registered, so a failure leaves nothing registered without an artifact.
    """
    spark = raw.sparkSession
    outcome = train_models(raw, spec, config, algorithms=algorithms, key=key)
    flat = {
        (r["algorithm"], r["split"]): r["flat"]
        for split in ("val", "test")
        for r in evaluate.flat_metrics(outcome.report.where(F.col("split") == split), split).collect()
    }
    common = {"test_size": str(config.test_size), "val_size": str(config.val_size), "random_state": str(config.random_state), "preprocessing": PREPROCESSING}
    sizes = {f"n_{split}_rows": str(n) for split, n in outcome.sizes.items()}
    sample = input_sample(raw, spec.contract, key or [spec.contract.id_column])
    run_rows, candidate_rows = [], []
    for ordinal, trained in enumerate(outcome.models):
        run_id = uuid.uuid4().hex
        uri = f"{root}/artifacts/{run_id}/model"
        trained.model.write().overwrite().save(uri)
        tags = {
            "algorithm": trained.algorithm, "dataset_id": dataset_id, "dataset_content_hash": content_hash,
            "dataset_filename": filename, "schema_name": spec.contract.name, "git_commit": git_commit,
        }
        if job_id is not None:
            tags["training_job_id"] = job_id
        run_rows.append((run_id, tags, {**trained.hyperparams, **common, **sizes}, {**flat[trained.algorithm, "val"], **flat[trained.algorithm, "test"]}, sample))
        candidate_rows.append((uuid.uuid4().hex, trained.algorithm, run_id, "0", uri, git_commit, {**trained.hyperparams, **common}, dataset_id, job_id, ordinal))
    tables.append(spark.createDataFrame(run_rows, RUNS), f"{root}/runs")
    made = spark.createDataFrame(
        candidate_rows,
        "id string, algorithm string, mlflow_run_id string, mlflow_experiment_id string, artifact_uri string, git_commit string, "
        "params map<string,string>, dataset_id string, training_job_id string, ordinal int",
    )
    tested = evaluate.nested_metrics(outcome.report.where(F.col("split") == "test")).select("algorithm", F.col("metrics").cast(METRICS).alias("metrics"))
    candidates = made.join(F.broadcast(tested), "algorithm")
    registered, events = registry.register(versions, candidates, as_of=as_of)
    return registered, events, candidates


def finished_job(job: DataFrame, candidates: DataFrame, as_of: Column) -> DataFrame:
    """The job row marked completed, its result naming the candidates and the best one."""
    best = registry.best_candidates(candidates)
    made = candidates.groupBy("training_job_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "id", "algorithm"))), lambda c: F.struct(c.id.alias("id"), c.algorithm.alias("algorithm"))).alias("_c")
    )
    result = F.to_json(
        F.struct(
            F.col("_c.id").alias("candidate_model_version_ids"), F.col("_c.algorithm").alias("algorithms_trained"),
            "best_algorithm", "best_model_version_id", "best_test_roc_auc",
        )
    )
    joined = job.join(made.join(best, "training_job_id"), job["id"] == F.col("training_job_id"))
    return joined.select(
        *[
            F.lit("completed").alias(c) if c == "status" else result.alias(c) if c == "result"
            else as_of.alias(c) if c == "finished_at" else job[c]
            for c in job.columns
        ]
    )


def failed_job(job: DataFrame, versions: DataFrame, error: str | Column, as_of: Column) -> DataFrame:
    """Job rows marked failed, each result naming candidates that were registered before the error.

    The error is a text for all rows or a column of `job`; only the contract's columns of a job come back.
    """
    error = F.lit(error) if isinstance(error, str) else error
    made = versions.where(F.col("training_job_id").isNotNull()).groupBy("training_job_id").agg(F.sort_array(F.collect_list("id")).alias("_ids"))
    result = F.when(F.col("_ids").isNotNull(), F.to_json(F.struct(F.col("_ids").alias("partial_candidate_model_version_ids"))))
    joined = job.join(made, job["id"] == made["training_job_id"], "left")
    return joined.select(
        *[
            F.lit("failed").alias(c) if c == "status" else result.alias(c) if c == "result"
            else error_text(error).alias(c) if c == "error_message" else as_of.alias(c) if c == "finished_at" else job[c]
            for c in job.columns
        ]
    )


def load_model(spark: SparkSession, uri: str) -> PipelineModel:
    return PipelineModel.load(uri)
