import datetime
import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabwatch.operators import features
from tabwatch.operators.features import CHURN_FEATURES, FeatureSpec
from tabwatch.plans import newton, scoring, train
from tabwatch.schema import CHURN, ID, MODEL_VERSIONS, TARGET, ColumnSpec, DatasetContract, TrainingConfig, categories, numbers
from tabwatch.session import new_workspace
from tabwatch.sources import tables

FAST = TrainingConfig(random_forest_n_estimators=12, random_forest_max_depth=6, xgboost_n_estimators=8, xgboost_max_depth=3)


def now():
    return F.lit(datetime.datetime(2024, 1, 1))


def draw(name, n):
    """Uniform whole number below n, from the row number alone."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(f"7|{name}|"), "id")), 1, 8), 16, 10).cast("bigint"), F.lit(n))


def synthetic_churn(spark, n=600):
    tenure, cents = draw("tenure", 73), draw("monthly", 10200) + 1800
    score = (tenure < 12).cast("int") + (cents > 8000).cast("int")
    chance = F.when(score == 0, 3).when(score == 1, 30).otherwise(85)
    values = {"gender": ["Male", "Female"], "Contract": ["Month-to-month", "One year", "Two year"], "InternetService": ["DSL", "Fiber optic", "No"]}
    cats = [
        F.element_at(F.array(*[F.lit(v) for v in values.get(c, ["Yes", "No"])]), (draw(c, len(values.get(c, "xy"))) + 1).cast("int")).alias(c)
        for c in CHURN.categorical_columns
    ]
    return spark.range(n).select(
        F.concat(F.lit("SYN"), "id").alias("customerID"), tenure.cast("string").alias("tenure"), (cents / 100).cast("string").alias("MonthlyCharges"),
        F.when(tenure == 0, "").otherwise(F.round(cents * tenure / 100, 2).cast("string")).alias("TotalCharges"), *cats,
        F.when(draw("noise", 100) < chance, "Yes").otherwise("No").alias("Churn"),
    )


@pytest.fixture(scope="module")
def outcome(spark):
    return train.train_models(synthetic_churn(spark), CHURN_FEATURES, FAST)


def test_every_algorithm_learns_the_signal(outcome):
    rows = outcome.report.collect()
    assert {(r["algorithm"], r["split"]) for r in rows} == {(a, s) for a in train.ESTIMATORS for s in ("val", "test")}
    for r in rows:
        assert r["roc_auc"] > 0.6
        assert r["true_negative"] + r["false_positive"] + r["false_negative"] + r["true_positive"] == outcome.sizes[r["split"]]
    assert outcome.sizes == pytest.approx({"train": 420, "val": 90, "test": 90}, abs=2)


def test_training_is_repeatable(spark, outcome):
    again = train.train_models(synthetic_churn(spark).repartition(3), CHURN_FEATURES, FAST, algorithms=["logistic_regression"])
    first = outcome.report.where("algorithm = 'logistic_regression'").orderBy("split").collect()
    for a, b in zip(first, again.report.orderBy("split").collect()):
        assert a["roc_auc"] == pytest.approx(b["roc_auc"], abs=1e-6)


def test_unknown_algorithm(spark):
    with pytest.raises(ValueError, match="Unknown algorithm"):
        train.train_models(synthetic_churn(spark), CHURN_FEATURES, algorithms=["svm"])


def test_hyperparameters():
    record = train.hyperparameters("xgboost", TrainingConfig(), 2.76543)
    assert record == {"n_estimators": "300", "max_depth": "5", "learning_rate": "0.1", "subsample": "0.9", "scale_pos_weight": "2.7654"}
    assert train.hyperparameters("logistic_regression", TrainingConfig(), 1.0) == {"max_iter": "1000", "C": "1.0", "class_weight": "balanced"}


def test_logistic_regression_solves_the_balanced_penalised_problem(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2))
    y = (x @ [1.5, -1.0] + 1.0 + rng.normal(size=300) > 0).astype(int)
    contract = DatasetContract("n", (ColumnSpec("id", ID), *numbers("a", "b"), ColumnSpec("y", TARGET)), ("1", "No"))
    raw = spark.createDataFrame([(str(i), repr(float(p)), repr(float(q)), str(t)) for i, ((p, q), t) in enumerate(zip(x, y))], "id string, a string, b string, y string")
    model = train.train_models(raw, FeatureSpec(contract, {}), TrainingConfig(), algorithms=["logistic_regression"]).models[0].model
    from tabwatch.operators.features import feature_rows
    from tabwatch.operators.split import stratified_split

    parts = stratified_split(feature_rows(raw, FeatureSpec(contract, {}), keep=["id"]), ["id"], test_size=0.15, val_size=0.15, seed=42)
    fold = np.array([tuple(r) for r in parts.where("split = 'train'").select("a", "b", "label").collect()])
    z = (fold[:, :2] - fold[:, :2].mean(0)) / fold[:, :2].std(0)
    t = fold[:, 2]
    w = np.where(t == 1, len(t) / (2 * t.sum()), len(t) / (2 * (1 - t).sum()))
    design, beta = np.c_[z, np.ones(len(t))], np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (w * (p - t)) + np.r_[beta[:2], 0]
        hessian = design.T @ (design * (w * p * (1 - p))[:, None]) + np.diag([1, 1, 0])
        beta -= np.linalg.solve(hessian, gradient)
    fitted = model.stages[-1]
    assert np.r_[fitted.coefficients.toArray(), fitted.intercept] == pytest.approx(beta, abs=1e-6)


def test_newton_and_the_general_solver_agree(spark):
    """The wide-problem solver has the same objective; separable rows, a constant column and an odd number of tasks."""
    rng = np.random.default_rng(3)
    x = np.c_[rng.normal(size=(120, 3)) * [1, 30, 0.01], np.ones(120)]
    y = (x[:, 0] > 0.3).astype(float)
    rows = spark.createDataFrame([(float(t), 0.5 + float(t), Vectors.dense(r)) for r, t in zip(x, y)], ["label", "w", "features"]).repartition(7)
    plain = rows.select("label", "w", vector_to_array("features"))
    beta, passes = newton.solve(plain, 4, 0.2, 100)
    gradient = x.T @ ((0.5 + y) * (1 / (1 + np.exp(-(x @ beta[:4] + beta[4]))) - y)) + 0.2 * beta[:4]
    assert np.abs(gradient).max() < 1e-6 and passes < 25
    scored = newton.model_of(spark, beta).transform(rows).select("label", "prediction", vector_to_array("probability")[1].alias("p"), vector_to_array("features").alias("x")).collect()
    for r in scored:
        assert r["p"] == pytest.approx(1 / (1 + np.exp(-(np.dot(r["x"], beta[:4]) + beta[4]))), abs=1e-9)
    wide = NarrowOnly()
    assert newton.NewtonLogisticRegression(0.2, 100, "w", wide).fit(rows.limit(0)) is wide


class NarrowOnly:
    """Stands for the general solver: gives itself back."""

    def fit(self, rows):
        return self


def test_columns_of_many_categories_get_hashed_positions(spark, monkeypatch):
    monkeypatch.setattr(train, "MAX_CATEGORIES", 100)
    monkeypatch.setattr(train, "HASHED_POSITIONS", 512)
    contract = DatasetContract("n", (ColumnSpec("id", ID), *numbers("a"), *categories("few", "many"), ColumnSpec("y", TARGET)), ("1", "No"))
    raw = spark.range(600).select(
        F.col("id").cast("string").alias("id"), draw("a", 50).cast("string").alias("a"), draw("few", 3).cast("string").alias("few"),
        F.when(F.col("id") % 17 == 0, None).otherwise(F.concat(F.lit("it's "), draw("many", 400))).alias("many"),
        F.when(draw("many", 400) < 150, "1").otherwise("No").alias("y"),
    )
    outcome = train.train_models(raw, FeatureSpec(contract, {}), TrainingConfig(logistic_regression_max_iter=30), algorithms=["logistic_regression"])
    stages = outcome.models[0].model.stages
    indexed = [s.getInputCols() for s in stages if isinstance(s, StringIndexerModel)]
    assert indexed == [["few__filled"]]  # the vocabulary of `many` never came to the driver
    unseen = spark.createDataFrame([("x", 1.0, "0", "never seen"), ("y", None, None, None)], "id string, a double, few string, many string")
    assert train.score_rows(outcome.models[0].model, unseen).where("probability BETWEEN 0 AND 1").count() == 2
    assert all(r["roc_auc"] > 0.6 for r in outcome.report.collect())


def test_collisions_of_hashed_positions(spark):
    words = [f"c{k}" for k in range(300)]
    vocabulary = spark.createDataFrame([("f", w) for w in words] + [("g", "c1")], "feature string, value string")
    held = Counter(int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 256 for w in words)
    got = {r["feature"]: tuple(r)[1:] for r in features.hashed_collisions(vocabulary, 256).collect()}
    assert got == {"f": (300, len(held), sum(n for n in held.values() if n > 1)), "g": (1, 1, 0)}


def test_no_nulls_reach_the_classifier_and_unseen_categories_score(spark, outcome):
    records = synthetic_churn(spark, 20).withColumn("Contract", F.lit("never seen")).withColumn("gender", F.lit(None).cast("string")).withColumn("TotalCharges", F.lit(None).cast("string"))
    typed = train.feature_rows(records, FeatureSpec(CHURN, {}), keep=["customerID"], target=False)
    for trained in outcome.models:
        scored = train.score_rows(trained.model, typed)
        assert scored.where("probability IS NULL OR isnan(probability)").count() == 0 and scored.count() == 20


def test_register_save_load_score(spark):
    raw, root = synthetic_churn(spark), new_workspace(spark, "test-train")
    empty = spark.createDataFrame([], MODEL_VERSIONS)
    registered, events, candidates = train.train_and_register(
        raw, empty, CHURN_FEATURES, FAST, root=root, dataset_id="d", content_hash="h", filename="f.csv", as_of=now(),
        algorithms=["logistic_regression", "random_forest"], job_id="j",
    )
    assert [r["version_label"] for r in registered.orderBy("version_label").collect()] == ["v1", "v2"] and events.count() == 2
    runs = spark.read.parquet(f"{root}/runs").collect()
    assert all(r["tags"]["training_job_id"] == "j" and "test_roc_auc" in r["metrics"] and "val_f1" in r["metrics"] for r in runs)
    job = spark.createDataFrame([("j", "running", None, None, None)], "id string, status string, result string, error_message string, finished_at timestamp")
    done = train.finished_job(job, candidates, now()).head()
    assert done["status"] == "completed" and '"algorithms_trained":["logistic_regression","random_forest"]' in done["result"]
    failed = train.failed_job(job, registered, "x" * 5000, now()).head()
    assert failed["status"] == "failed" and len(failed["error_message"]) == 2000 and "partial_candidate_model_version_ids" in failed["result"]

    uri, version = candidates.select("artifact_uri", "id").head()
    model = train.load_model(spark, uri)
    records = raw.limit(50).union(raw.limit(1).withColumn("tenure", F.lit("-3")))
    scored, rejected = scoring.score(records, model, CHURN_FEATURES, model_version_id=version, request_id="r", record_key=["customerID"], as_of=now(), integers=["tenure"])
    done = scoring.run_batch(scored, f"{root}/predictions")
    log = spark.read.parquet(f"{root}/predictions")
    rows = log.collect()
    assert done["n_processed"] == len(rows) > 40 and rejected.count() >= 1
    assert {r["model_version_id"] for r in rows} == {version} and {r["latency_ms"] for r in rows} == {done["latency_ms"]}
    assert {r["prediction"] for r in rows} <= {"Yes", "No"} and all((r["prediction"] == "Yes") == (r["probability"] > 0.5) for r in rows)
    again, _ = scoring.score(records, model, CHURN_FEATURES, model_version_id=version, request_id="r", record_key=["customerID"], as_of=now(), integers=["tenure"])
    assert {r["id"] for r in again.collect()} == {r["id"] for r in rows}
    assert scoring.batch_result(log).head()["n_processed"] == len(rows)


def test_records_of_batch_jobs(spark):
    payload = '{"records": [{"tenure": 3, "gender": "Male"}, {"tenure": 4}], "model_version_id": "m"}'
    jobs = spark.createDataFrame([("j", "batch_predict", payload), ("t", "train", "{}")], "id string, job_type string, payload string")
    rows = scoring.records_of_jobs(jobs, CHURN).orderBy("record_no").collect()
    assert [(r["model_version_id"], r["tenure"], r["gender"]) for r in rows] == [("m", "3", "Male"), ("m", "4", None)]


def test_publish_and_latest(spark):
    root = new_workspace(spark, "test-publish")
    with pytest.raises(LookupError):
        tables.latest(spark, root)
    assert tables.publish(spark.range(3), root) == 1 and tables.publish(tables.latest(spark, root).where("id > 0"), root) == 2
    assert tables.latest(spark, root).count() == 2


def test_encoded_and_held_out_rows_are_made_once(spark, monkeypatch):
    """The passes of the solver and the steps of the report read stored rows; none repeats the encoding."""
    seen = {}

    def passes(rows, *a, solve=newton.solve):
        seen["encoded"] = rows
        return solve(rows, *a)

    def report(scored, *a, real=train.evaluate.evaluation_report):
        seen["held out"] = scored
        return real(scored, *a)

    monkeypatch.setattr(newton, "solve", passes)
    monkeypatch.setattr(train.evaluate, "evaluation_report", report)
    sizes = train.train_models(synthetic_churn(spark, 200), CHURN_FEATURES, FAST, algorithms=["logistic_regression"]).sizes
    assert seen["encoded"].count() == sizes["train"] and seen["held out"].count() == sizes["val"] + sizes["test"]
    for rows in seen.values():
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "Relation" in plan and "UDF" not in plan and "InMemoryRelation" not in plan
