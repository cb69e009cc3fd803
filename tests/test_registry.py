import datetime

import pytest
from pyspark.sql import functions as F

from tabwatch.operators import registry
from tabwatch.schema import METRICS, MODEL_VERSIONS, MonitorConfig

T0, NOW = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 2, 1)
GOOD = {"accuracy": 0.8, "precision": 0.55, "recall": 0.7, "f1": 0.61, "roc_auc": 0.84, "confusion_matrix": None}


def versions(spark, *rows):
    full = []
    for i, (vid, stage, *rest) in enumerate(rows):
        over = rest[0] if rest else {}
        row = {
            "id": vid, "version_label": f"v{i + 1}", "algorithm": "xgboost", "mlflow_run_id": f"run-{vid}", "mlflow_experiment_id": "1",
            "artifact_uri": "u", "git_commit": "c", "stage": stage, "metrics": GOOD, "params": {"C": "1.0"}, "dataset_id": "ds",
            "training_job_id": None, "created_at": T0, "promoted_at": None, **over,
        }
        full.append(row)
    return spark.createDataFrame(full, MODEL_VERSIONS)


def datasets(spark):
    return spark.createDataFrame([("ds", True), ("bad", False)], "id string, is_valid boolean")


def runs(spark, *ids):
    return spark.createDataFrame([(f"run-{i}",) for i in ids], "run_id string")


def policy(spark, vs, *verified):
    return registry.promotion_policy(vs, datasets(spark), runs(spark, *verified))


def promote(spark, vs, vid):
    return registry.promote(vs, vid, policy(spark, vs, "a", "b", "c"), as_of=F.lit(NOW))


def stages(vs):
    return {r["id"]: r["stage"] for r in vs.collect()}


def test_register_numbers_and_records(spark):
    vs = versions(spark, ("a", "production"), ("b", "archived"))
    new = spark.createDataFrame(
        [("x", "random_forest", "r1", "1", "u", "c", {}, "ds", "j", GOOD, 1), ("w", "xgboost", "r2", "1", "u", "c", {}, "ds", "j", GOOD, 0)],
        "id string, algorithm string, mlflow_run_id string, mlflow_experiment_id string, artifact_uri string, git_commit string, "
        f"params map<string,string>, dataset_id string, training_job_id string, metrics {METRICS}, ordinal int",
    )
    after, events = registry.register(vs, new, as_of=F.lit(NOW))
    assert {r["id"]: r["version_label"] for r in after.collect()} == {"a": "v1", "b": "v2", "w": "v3", "x": "v4"}
    assert [(e["action"], e["new_stage"], e["triggered_by"]) for e in events.collect()] == [("registered", "candidate", "system")] * 2


def test_promote_into_empty_registry(spark):
    after, events = promote(spark, versions(spark, ("a", "candidate")), "a")
    row = after.head()
    assert row["stage"] == "production" and row["promoted_at"] == NOW
    assert [e["action"] for e in events.collect()] == ["promoted"]


def test_promote_shifts_the_others(spark):
    vs = versions(spark, ("a", "candidate"), ("b", "production"), ("c", "previous"), ("d", "candidate"))
    after, events = promote(spark, vs, "a")
    assert stages(after) == {"a": "production", "b": "previous", "c": "archived", "d": "candidate"}
    told = [(e["model_version_id"], e["action"], (e["event_metadata"] or {}).get("reason")) for e in events.orderBy("seq").collect()]
    because = "superseded by promotion of a"
    assert told == [("c", "archived", because), ("b", "demoted_to_previous", because), ("a", "promoted", None)]


@pytest.mark.parametrize(("change", "verified", "text"), [
    ({"dataset_id": None}, "a", "no linked training dataset"),
    ({"dataset_id": "bad"}, "a", "missing or failed validation"),
    ({"dataset_id": "gone"}, "a", "missing or failed validation"),
    ({"metrics": {**GOOD, "f1": None, "recall": None}}, "a", r"metric\(s\): \['recall', 'f1'\]"),
    ({}, "z", "could not be verified for run run-a"),
])
def test_policy_names_the_first_failure(spark, change, verified, text):
    vs = versions(spark, ("a", "candidate", change))
    with pytest.raises(registry.InvalidTransition, match=text):
        registry.promote(vs, "a", policy(spark, vs, verified), as_of=F.lit(NOW))


def test_only_candidates_and_known_ids(spark):
    vs = versions(spark, ("a", "archived"))
    with pytest.raises(registry.InvalidTransition, match="not a candidate"):
        promote(spark, vs, "a")
    with pytest.raises(LookupError):
        promote(spark, vs, "nope")


def test_without_artifact_probe_nothing_is_eligible(spark):
    vs = versions(spark, ("a", "candidate"))
    assert not registry.promotion_policy(vs, datasets(spark)).head()["eligible"]
    assert registry.promotion_policy(vs, datasets(spark), config=MonitorConfig(require_artifact=False)).head()["eligible"]


def test_rollback_swaps(spark):
    vs = versions(spark, ("a", "production"), ("b", "previous"), ("c", "archived"))
    after, events = registry.rollback(vs, as_of=F.lit(NOW))
    assert stages(after) == {"a": "previous", "b": "production", "c": "archived"}
    assert {r["id"]: r["promoted_at"] for r in after.collect()} == {"a": None, "b": NOW, "c": None}
    told = [(e["model_version_id"], e["action"], e["previous_stage"], e["new_stage"]) for e in events.orderBy("seq").collect()]
    assert told == [("a", "rolled_back", "production", "previous"), ("b", "rolled_back", "previous", "production")]


def test_rollback_without_production_or_previous(spark):
    _, events = registry.rollback(versions(spark, ("b", "previous")), as_of=F.lit(NOW))
    assert events.count() == 1
    with pytest.raises(registry.InvalidTransition, match="No previous production model"):
        registry.rollback(versions(spark, ("a", "production")), as_of=F.lit(NOW))


def test_invariants(spark):
    fine = versions(spark, ("a", "production"), ("b", "previous"), ("c", "archived"), ("d", "archived"))
    registry.require_consistent(fine)
    broken = versions(spark, ("a", "production"), ("b", "production"), ("c", "archived", {"mlflow_run_id": "run-a"}))
    assert {(r["rule"], r["n"]) for r in registry.violations(broken).collect()} == {("one_production", 2), ("unique_run_id", 2)}
    with pytest.raises(registry.ConflictingState):
        registry.require_consistent(broken)


def test_broken_registry_is_refused(spark):
    two = versions(spark, ("a", "production"), ("b", "production"), ("c", "candidate"), ("d", "previous"))
    with pytest.raises(registry.ConflictingState, match="one_production"):
        promote(spark, two, "c")
    with pytest.raises(registry.ConflictingState, match="one_production"):
        registry.rollback(two, as_of=F.lit(NOW))
    known = versions(spark, ("a", "candidate"))
    with pytest.raises(registry.ConflictingState, match="unique_run_id"):
        registry.register(known, known.withColumn("ordinal", F.lit(0)), as_of=F.lit(NOW))


def test_stage_follows_from_events(spark):
    vs = versions(spark, ("a", "candidate"), ("b", "production"))
    first = vs.select(
        F.col("id").alias("model_version_id"), F.lit("registered").alias("action"), F.lit(None).cast("string").alias("previous_stage"),
        F.col("stage").alias("new_stage"), F.lit("system").alias("triggered_by"), F.lit(None).cast("map<string,string>").alias("event_metadata"),
        F.col("created_at"), F.lit(0).alias("seq"),
    )
    after, events = promote(spark, vs, "a")
    again, more = registry.rollback(after, as_of=F.lit(NOW + datetime.timedelta(days=1)))
    rebuilt = registry.stages_from_events(first.unionByName(events).unionByName(more), again).collect()
    assert all(r["consistent"] for r in rebuilt) and {r["id"]: r["stage"] for r in rebuilt} == {"a": "previous", "b": "production"}


def test_best_candidate_first_wins_a_tie(spark):
    vs = versions(spark, *[(i, "candidate", {"training_job_id": "j"}) for i in "abc"]).withColumn(
        "ordinal", F.when(F.col("id") == "c", 0).when(F.col("id") == "a", 1).otherwise(2)
    )
    assert registry.best_candidates(vs).head()["best_model_version_id"] == "c"


def test_metrics_are_flattened(spark):
    full = {**GOOD, "confusion_matrix": {"true_negative": 1, "false_positive": 2, "false_negative": 3, "true_positive": 4}}
    rows = {r["metric"]: r["value"] for r in registry.metrics_rows(versions(spark, ("a", "candidate", {"metrics": full}))).collect()}
    assert rows["test_roc_auc"] == 0.84 and rows["test_confusion_matrix_true_positive"] == 4.0 and len(rows) == 9


def test_production_is_at_most_one(spark):
    rows = [("a", "production"), ("b", "candidate")]
    one = registry.production(spark.createDataFrame(rows, "id string, stage string"))
    assert [tuple(r) for r in one.collect()] == [("a", "production")]
    assert registry.production(spark.createDataFrame(rows[1:], "id string, stage string")).count() == 0
    with pytest.raises(Exception, match="more than one version"):
        registry.production(spark.createDataFrame([*rows, ("c", "production")], "id string, stage string")).collect()
