import datetime
import json

import pytest
from pyspark.sql import functions as F
from test_training import FAST, synthetic_churn

from tabwatch.operators.features import CHURN_FEATURES
from tabwatch.plans import jobs, train
from tabwatch.schema import JOBS, METRICS, MODEL_VERSIONS
from tabwatch.session import new_workspace

NOW = datetime.datetime(2024, 1, 1)
BEFORE = datetime.datetime(2023, 1, 1)
DATASETS = "id string, filename string, storage_path string, content_hash string, is_valid boolean"
HASHES = "storage_path string, sha256 string"
CANDIDATES = "id string, algorithm string, training_job_id string, ordinal int, metrics struct<roc_auc:double>"


def job(k, status="queued", dataset="d", payload="{}", kind="train", started=None, error=None):
    return (k, kind, status, dataset, payload, None, error, BEFORE, started, None)


def after(spark, rows, made=(), datasets=(("d", "f.csv", "/d", "h", True),), hashes=(("/d", "h"),)):
    table = spark.createDataFrame(rows, JOBS)
    candidates = spark.createDataFrame(list(made), CANDIDATES)
    steps = jobs.training_steps(table, spark.createDataFrame(list(datasets), DATASETS), spark.createDataFrame(list(hashes), HASHES), candidates)
    out = jobs.advance_training(table, steps, candidates, F.lit(NOW))
    assert out.columns == table.columns
    return {r["id"]: r for r in out.collect()}


def test_datasets_are_checked_before_training(spark):
    datasets = [("ok", "f", "/ok", "h", True), ("bad", "f", "/bad", "h", False), ("gone", "f", "/gone", "h", True), ("other", "f", "/other", "h", True)]
    rows = [job(k, dataset=k) for k in ("ok", "bad", "gone", "other", "unknown")] + [job("none", dataset=None)]
    got = after(spark, rows, datasets=datasets, hashes=[("/ok", "h"), ("/bad", "h"), ("/other", "x")])
    assert got["ok"]["status"] == "running" and got["ok"]["started_at"] == NOW and got["ok"]["finished_at"] is None
    assert {k for k, r in got.items() if r["status"] == "failed"} == {"bad", "gone", "other", "unknown", "none"}
    assert got["gone"]["error_message"] == "Dataset file is missing: /gone" and got["unknown"]["error_message"] == "Dataset unknown not found."
    assert "recorded h, file on disk now hashes to x" in got["other"]["error_message"]
    assert all(r["finished_at"] == NOW and r["result"] is None for k, r in got.items() if k != "ok")


def test_jobs_advance_by_their_candidates(spark):
    two = '{"algorithms": ["random_forest", "xgboost"]}'
    rows = [
        job("whole", payload=two), job("part", "running", payload=two, started=BEFORE), job("all"), job("broken", dataset="?"),
        job("done", "completed"), job("failed", "failed", error="boom"), job("other", kind="ingest"), job("null", payload=None),
    ]
    made = [("a", "random_forest", "whole", 0, (0.7,)), ("b", "xgboost", "whole", 1, (0.7,)), ("c", "xgboost", "part", 0, (0.9,)),
            ("e", "xgboost", "broken", 0, (0.9,)), ("f", "xgboost", None, 0, (0.9,)), ("g", "xgboost", "failed", 0, (0.9,))]
    got = after(spark, rows, made)
    assert {k: r["status"] for k, r in got.items()} == {
        "whole": "completed", "part": "running", "all": "running", "broken": "failed", "done": "completed", "failed": "failed", "other": "queued", "null": "running",
    }
    assert json.loads(got["whole"]["result"]) == {
        "candidate_model_version_ids": ["a", "b"], "algorithms_trained": ["random_forest", "xgboost"],
        "best_algorithm": "random_forest", "best_model_version_id": "a", "best_test_roc_auc": 0.7,  # the first of a tie
    }
    assert got["part"]["started_at"] == BEFORE and json.loads(got["broken"]["result"]) == {"partial_candidate_model_version_ids": ["e"]}
    assert got["failed"]["error_message"] == "boom" and got["failed"]["result"] is None and got["done"]["finished_at"] is None
    assert after(spark, []) == {}


def test_batch_jobs_advance_by_the_log(spark):
    def payload(version, n):
        return json.dumps({"records": [{"x": 1}] * n, "model_version_id": version})

    rows = [job(k, kind="batch_predict", payload=p, status=s) for k, p, s in (
        ("whole", payload("v", 2), "queued"), ("part", payload("v", 3), "running"), ("gone", payload("w", 2), "queued"), ("empty", payload("v", 0), "queued"),
        ("old", payload("v", 2), "failed"), ("null", None, "queued"))] + [job("train")]
    table = spark.createDataFrame(rows, JOBS)
    log = spark.createDataFrame([(k,) for k in ("whole", "whole", "part", "gone", "old", "old")], "request_id string")
    got = {r["id"]: r for r in jobs.advance_scoring(table, spark.createDataFrame([("v",)], "id string"), log, F.lit(NOW)).collect()}
    assert {k: (r["status"], r["result"]) for k, r in got.items()} == {
        "whole": ("completed", '{"n_processed":2}'), "part": ("running", None), "gone": ("failed", None), "empty": ("completed", '{"n_processed":0}'),
        "old": ("failed", None), "null": ("failed", None), "train": ("queued", None),
    }
    assert got["gone"]["error_message"] == "Pinned model version w no longer exists." and got["part"]["started_at"] == NOW


def test_a_stopped_job_goes_on_with_what_is_missing(spark, monkeypatch):
    raw, root = synthetic_churn(spark), new_workspace(spark, "test-jobs")
    table = spark.createDataFrame([job("j", payload='{"algorithms": ["logistic_regression", "xgboost"]}')], JOBS)
    common = {
        "datasets": spark.createDataFrame([("d", "f.csv", "/d", "h", True)], DATASETS), "hashes": spark.createDataFrame([("/d", "h")], HASHES),
        "root": root, "as_of": F.lit(NOW),
    }
    none = spark.createDataFrame([], CANDIDATES.replace("struct<roc_auc:double>", METRICS))

    def broken(config, balance):
        raise MemoryError("out of memory")

    whole = train.ESTIMATORS["xgboost"]
    monkeypatch.setitem(train.ESTIMATORS, "xgboost", broken)
    failed, versions, made = jobs.run_training_job(table, raw, spark.createDataFrame([], MODEL_VERSIONS), none, CHURN_FEATURES, FAST, **common)
    first = made.head()["id"]
    row = failed.head()
    assert row["status"] == "failed" and row["error_message"] == "out of memory" and versions.count() == 1
    assert json.loads(row["result"]) == {"partial_candidate_model_version_ids": [first]}

    monkeypatch.setitem(train.ESTIMATORS, "xgboost", whole)
    done, versions, made = jobs.run_training_job(table, raw, versions, made, CHURN_FEATURES, FAST, **common)
    result = json.loads(done.head()["result"])
    assert done.head()["status"] == "completed" and versions.count() == 2
    assert result["candidate_model_version_ids"][0] == first and result["algorithms_trained"] == ["logistic_regression", "xgboost"]
    assert [r["tags"]["algorithm"] for r in spark.read.parquet(f"{root}/runs").collect()].count("logistic_regression") == 1
    same, _, _ = jobs.run_training_job(done, raw, versions, made, CHURN_FEATURES, FAST, **common)
    assert same.head() == done.head()
    refused, _, _ = jobs.run_training_job(table, raw, versions, none, CHURN_FEATURES, FAST, **(common | {"hashes": common["hashes"].limit(0)}))
    assert refused.head()["error_message"] == "Dataset file is missing: /d"


@pytest.mark.parametrize("text", ["x" * 5000, "é" * 2500])
def test_long_errors_are_cut(spark, text):
    table = spark.createDataFrame([job("j", "running")], JOBS)
    row = train.failed_job(table, spark.createDataFrame([], CANDIDATES), text, F.lit(NOW)).head()
    assert row["error_message"] == text[:2000]
