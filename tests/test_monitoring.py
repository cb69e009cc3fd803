import datetime

import pytest
from pyspark.sql import functions as F

from tabwatch.operators import lineage, listing, monitoring
from tabwatch.schema import JOBS

NOW = datetime.datetime(2024, 6, 1)


def log(spark, *groups):
    rows = [(f"{v}-{i}", v, at) for v, n, at in groups for i in range(n)]
    return spark.createDataFrame(rows, "id string, model_version_id string, created_at timestamp")


def registry(spark, *rows):
    return spark.createDataFrame(
        [(i, f"label-{i}", "xgboost", stage, promoted) for i, stage, promoted in rows],
        "id string, version_label string, algorithm string, stage string, promoted_at timestamp",
    )


def job(i, job_type="train", status="completed", *, start=None, end=None, created=NOW, payload="{}", dataset="d", error=None):
    return (i, job_type, status, dataset, payload, None, error, created, start, end)


def jobs(spark, *rows):
    return spark.createDataFrame(list(rows), JOBS)


def test_usage_shares(spark):
    used = monitoring.usage(log(spark, ("a", 3, NOW), ("b", 7, NOW)), registry(spark, ("a", "previous", None), ("b", "production", NOW))).collect()
    assert [(r["version_label"], r["percentage_of_total"]) for r in used] == [("label-b", 70.0), ("label-a", 30.0)]


def test_usage_of_unknown_version_and_of_nothing(spark):
    assert monitoring.usage(log(spark, ("zz", 2, NOW)), registry(spark, ("a", "production", NOW))).head()["version_label"] is None
    assert monitoring.usage(log(spark), registry(spark)).count() == 0


def test_stale_version_is_visible(spark):
    later = NOW + datetime.timedelta(hours=1)
    stale = monitoring.stale_versions(
        log(spark, ("old", 2, later), ("gone", 2, NOW - datetime.timedelta(days=9)), ("new", 10, later)),
        registry(spark, ("old", "previous", None), ("gone", "archived", None), ("new", "production", NOW)),
    )
    assert [r["model_version_id"] for r in stale.collect()] == ["old"]


def test_job_stats(spark):
    row = monitoring.job_stats(jobs(
        spark, job("1", start=NOW, end=NOW + datetime.timedelta(seconds=10)), job("2", status="failed", error="boom"),
        job("3", status="queued"), job("4", "batch_predict", "failed"), job("5", start=None, end=NOW),
    )).head()
    assert (row["total_jobs"], row["completed_jobs"], row["failed_jobs"], row["active_jobs"]) == (4, 2, 1, 1)
    assert row["average_training_duration_seconds"] == 10.0 and row["n_durations_sampled"] == 1


def test_job_stats_without_jobs(spark):
    row = monitoring.job_stats(jobs(spark)).head()
    assert row["total_jobs"] == 0 and row["average_training_duration_seconds"] is None


def test_two_kinds_of_recent_failures(spark):
    old = NOW - datetime.timedelta(days=3)
    table = jobs(spark, job("1", "train", "failed", created=old), job("2", "batch_predict", "failed"), job("3", "ingest", "failed", created=old))
    assert [r["job_id"] for r in monitoring.training_failures(table).collect()] == ["1"]
    assert [r["job_id"] for r in monitoring.recent_failures(table, F.lit(NOW)).collect()] == ["2"]


def test_summary_of_an_idle_system(spark):
    row = monitoring.summary(log(spark), jobs(spark), registry(spark), as_of=F.lit(NOW), min_samples=100).head()
    assert row["current_production_model"] is None and row["drift_status"] == "no_production_model"
    assert row["recent_prediction_count"] == 0 and row["total_predictions"] == 0 and (row["n_versions_used"], row["most_used_version"]) == (0, None)


def test_summary(spark):
    row = monitoring.summary(
        log(spark, ("a", 5, NOW - datetime.timedelta(hours=48)), ("a", 3, NOW)),
        jobs(spark, job("1", status="running"), job("2", status="failed")), registry(spark, ("a", "production", NOW)),
        as_of=F.lit(NOW), min_samples=8,
    ).head()
    assert row["recent_prediction_count"] == 3 and row["drift_status"] == "ok" and row["active_training_jobs"] == 1
    assert row["current_production_model"]["version_label"] == "label-a" and row["recent_failed_jobs"] == ["2"]


def test_histogram_bounds_are_inclusive_and_cumulative(spark):
    df = spark.createDataFrame([("GET", 0.005), ("GET", 0.3), ("GET", 99.0)], "method string, s double")
    rows = {r["le"]: r["cumulative_count"] for r in monitoring.latency_histogram(df, ["method"], F.col("s")).collect()}
    assert rows[0.005] == 1 and rows[0.25] == 1 and rows[0.5] == 2 and rows[10.0] == 2 and rows[float("inf")] == 3


def test_counter_total_row(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "label string")
    assert {(r["label"], r["n"], r["is_total"]) for r in monitoring.counters(df, ["label"]).collect()} == {("a", 2, False), ("b", 1, False), (None, 3, True)}


def test_paging_checks_and_covers_everything(spark):
    df = log(spark, ("a", 25, NOW))
    for bad in ({"limit": 0}, {"limit": 501}, {"offset": -1}):
        with pytest.raises(ValueError):
            listing.page(df, **bad)
    seen = [r["id"] for o in (0, 10, 20) for r in listing.page(df, limit=10, offset=o)[0].collect()]
    assert len(seen) == len(set(seen)) == 25 and listing.page(df)[1].head()["total"] == 25
    after, keyset = None, []
    while True:
        rows = listing.page_after(df, limit=10, after=after).collect()
        if not rows:
            break
        keyset += [r["id"] for r in rows]
        after = (F.lit(rows[-1]["created_at"]), rows[-1]["id"])
    assert keyset == seen


def test_filters(spark):
    table = jobs(spark, job("1"), job("2", "ingest"), job("3", status="failed"))
    assert {r["id"] for r in listing.where_equal(table, job_type="train", status=None).collect()} == {"1", "3"}
    with pytest.raises(ValueError, match="Unknown status"):
        listing.where_equal(table, status="done")


def test_job_details(spark):
    vs = spark.createDataFrame([("m1", "v1", "1"), ("m0", "v0", "1"), ("m2", "v2", None)], "id string, version_label string, training_job_id string")
    table = jobs(spark, job("1"), job("2", "batch_predict", payload='{"records": [{}, {}], "model_version_id": "m2"}'), job("3"))
    rows = {r["id"]: r for r in listing.with_job_details(table, vs).collect()}
    assert rows["1"]["model_version_ids"] == ["m0", "m1"] and rows["1"]["n_records"] is None
    assert rows["2"]["n_records"] == 2 and rows["2"]["model_version"] == "v2" and rows["2"]["model_version_ids"] is None
    assert rows["3"]["model_version_ids"] is None


def test_duplicate_request_ignores_key_order_and_finished_jobs(spark):
    same = '{"config": {"b": 2, "a": 1}, "algorithms": null}'
    asked = spark.createDataFrame([("d", '{"algorithms":null,"config":{"a":1,"b":2}}'), ("d", '{"config":{"a":2}}'), ("e", same)], "dataset_id string, payload string")
    active = jobs(spark, job("1", status="running", payload=same), job("2", status="completed", dataset="e", payload=same))
    assert [r["dataset_id"] for r in lineage.duplicate_requests(asked, active).collect()] == ["d"]
    assert lineage.duplicate_requests(asked, active, how="left_anti").count() == 2


def test_event_counters_count_labels_and_totals_in_one_pass(spark):
    log = spark.createDataFrame([("r1", "v"), ("r1", "w"), ("r2", "v"), ("r3", "v"), ("r3", "v"), ("r3", None)], "request_id string, model_version_id string")
    batches = monitoring.batch_requests(log, 2)
    assert {(r["request_id"], r["n_records"], r["mode"]) for r in batches.collect()} == {("r1", 2, "sync"), ("r3", 3, "async")}
    errors = spark.createDataFrame([], "reason string")
    got = {(r["metric"], r["label"], r["is_total"]): r["n"] for r in monitoring.event_counters(log, errors, batches).collect()}
    assert got == {
        ("predictions", "v", False): 4, ("predictions", "w", False): 1, ("predictions", None, False): 1, ("predictions", None, True): 6,
        ("prediction_errors", None, True): 0, ("batch_predictions", "sync", False): 1, ("batch_predictions", "async", False): 1,
        ("batch_predictions", None, True): 2,
    }
