import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwatch.functions import stats
from tabwatch.operators import drift
from tabwatch.schema import ID, TARGET, ColumnSpec, DatasetContract, MonitorConfig, categories, numbers

CONTRACT = DatasetContract("c", (ColumnSpec("id", ID), *numbers("tenure"), *categories("plan"), ColumnSpec("y", TARGET)), ("Yes", "No"))


def numeric(spark, values, name):
    df = spark.createDataFrame([(float(v),) for v in values], "tenure double")
    return drift.numeric_counts(df, ["tenure"], [], name)


def brute_ks(a, b):
    grid = np.unique(np.concatenate([a, b]))
    a, b = np.sort(a), np.sort(b)
    return np.max(np.abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b)))


@pytest.mark.parametrize("case", ["same", "shift", "disjoint", "ties"])
def test_ks_equals_brute_force(spark, case):
    rng = np.random.default_rng(1)
    a, b = {
        "same": (rng.normal(50, 10, 1000), rng.normal(50, 10, 1000)),
        "shift": (rng.normal(50, 10, 1000), rng.normal(80, 10, 1000)),
        "disjoint": (rng.uniform(0, 1, 500), rng.uniform(100, 200, 500)),
        "ties": (rng.integers(0, 6, 400), rng.integers(2, 9, 300)),
    }[case]
    plain = drift.ks_by_feature(numeric(spark, a, "ref_n"), numeric(spark, b, "prod_n")).head()
    shared = drift.ks_against_reference(numeric(spark, a, "ref_n"), numeric(spark, b, "prod_n"), [], []).head()
    expected = brute_ks(a, b)
    assert plain["score"] == pytest.approx(expected, abs=1e-12)
    assert shared["score"] == pytest.approx(expected, abs=1e-12)
    assert (shared["reference_n"], shared["production_n"]) == (len(a), len(b))
    assert (plain["score"] >= 0.1) == (case != "same")
    assert (plain["p_value"] > 0.05) if case == "same" else (plain["p_value"] < 0.01)


def test_ks_many_groups_on_shared_references(spark):
    rng = np.random.default_rng(5)
    refs = {d: rng.normal(i, 1, 300).round(1) for i, d in enumerate("de")}
    groups = {(d, f"{d}{j}"): rng.normal(j, 1, 50 * (j + 1)).round(1) for d in "de" for j in range(3)}
    ref = spark.createDataFrame([(d, float(v)) for d, vs in refs.items() for v in vs], "ds string, tenure double")
    prod = spark.createDataFrame([(d, g, float(v)) for (d, g), vs in groups.items() for v in vs], "ds string, g string, tenure double")
    out = drift.ks_against_reference(
        drift.numeric_counts(ref, ["tenure"], ["ds"], "ref_n"), drift.numeric_counts(prod, ["tenure"], ["ds", "g"], "prod_n"),
        ["ds"], ["g"],
    ).collect()
    got = {(r["ds"], r["g"]): r["score"] for r in out}
    assert got == pytest.approx({k: brute_ks(refs[k[0]], v) for k, v in groups.items()}, abs=1e-12)


def psi(spark, reference, production):
    ref = spark.createDataFrame([("plan", k, n) for k, n in reference.items()], "feature string, value string, ref_n bigint")
    prod = spark.createDataFrame([("plan", k, n) for k, n in production.items()], "feature string, value string, prod_n bigint")
    return drift.psi_against_reference(ref, prod).head()["score"]


@pytest.mark.parametrize(("reference", "production", "expected"), [
    ({"A": 5, "B": 3, "C": 2}, {"A": 500, "B": 300, "C": 200}, 0.0),
    ({"A": 5, "B": 3, "C": 2}, {"A": 100, "B": 100, "C": 800}, 1.6952742393791966),
    ({"A": 10}, {"A": 900, "new": 100}, 0.7006208039360982),
    ({"X": 9, "Y": 1}, {"X": 100, "Y": 900}, 3.515559323737951),
])
def test_psi_values(spark, reference, production, expected):
    assert psi(spark, reference, production) == pytest.approx(expected, abs=1e-9)


def test_psi_category_missing_from_production(spark):
    floor = 1e-4
    expected = (1.0 - 0.6) * np.log(1.0 / 0.6) + (floor - 0.4) * np.log(floor / 0.4)
    assert psi(spark, {"A": 6, "B": 4}, {"A": 10}) == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize(("score", "band"), [(0.0999, "none"), (0.10, "warning"), (0.2499, "warning"), (0.25, "critical"), (None, None)])
def test_severity_bands(spark, score, band):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(stats.severity(F.col("s"), MonitorConfig())).head()[0] == band


def log(spark, rows):
    return spark.createDataFrame(rows, "id string, model_version_id string, created_at timestamp, tenure double, plan string")


NOW = datetime.datetime(2024, 6, 1)


def predictions(version, n, *, days_old=0, tenure=lambda i: i % 72, plan=lambda i: "ab"[i % 2]):
    at = NOW - datetime.timedelta(days=days_old, minutes=5)
    return [(f"{version}-{days_old}-{i}", version, at, None if tenure(i) is None else float(tenure(i)), plan(i)) for i in range(n)]


def training(spark, dataset="d", n=300):
    return spark.createDataFrame([(dataset, float(i % 73), "ab"[i % 2]) for i in range(n)], "dataset_id string, tenure double, plan string")


def versions(spark, *pairs):
    return spark.createDataFrame([(v, f"label-{v}", d, None) for v, d in pairs], "model_version_id string, version_label string, dataset_id string, training_job_id string")


def run(spark, vs, rows, train, **options):
    header, results = drift.drift_report(vs, train, log(spark, rows), CONTRACT, as_of=F.lit(NOW), **options)
    return {r["model_version_id"]: r for r in header.collect()}, {(r["model_version_id"], r["feature"]): r for r in results.collect()}


def test_gate(spark):
    header, results = run(spark, versions(spark, ("v", "d")), predictions("v", 10), training(spark), config=MonitorConfig(min_samples=50))
    assert header["v"]["status"] == "insufficient_data" and header["v"]["sample_size"] == 10 and results == {}
    header, results = run(spark, versions(spark, ("v", "d")), predictions("v", 25), training(spark), config=MonitorConfig(min_samples=25))
    assert header["v"]["status"] == "ok" and len(results) == 2 and header["v"]["reference_n_rows"] == 300


def test_no_drift_and_drift(spark):
    _, same = run(spark, versions(spark, ("v", "d")), predictions("v", 144), training(spark))
    assert not same["v", "tenure"]["drift_detected"] and not same["v", "plan"]["drift_detected"]
    moved = predictions("v", 144, tenure=lambda i: 70 + i % 3, plan=lambda i: "a")
    header, results = run(spark, versions(spark, ("v", "d")), moved, training(spark))
    assert results["v", "tenure"]["drift_detected"] and results["v", "plan"]["severity"] in ("warning", "critical")
    assert header["v"]["drift_detected"]


def test_versions_are_kept_apart_with_their_own_reference(spark):
    rows = predictions("v", 144) + predictions("w", 140, tenure=lambda i: 500 + i)
    train = training(spark, "d").unionByName(training(spark, "e").withColumn("tenure", F.col("tenure") + 500))
    header, results = run(spark, versions(spark, ("v", "d"), ("w", "e")), rows, train)
    assert (header["v"]["sample_size"], header["w"]["sample_size"]) == (144, 140)
    assert not results["v", "tenure"]["drift_detected"]
    assert results["w", "tenure"]["score"] == pytest.approx(brute_ks(np.arange(300) % 73 + 500, np.arange(140) + 500))


def test_window(spark):
    rows = predictions("v", 30, days_old=10) + predictions("v", 25)
    config = MonitorConfig(min_samples=20)
    assert run(spark, versions(spark, ("v", "d")), rows, training(spark), config=config)[0]["v"]["sample_size"] == 55
    assert run(spark, versions(spark, ("v", "d")), rows, training(spark), window="24h", config=config)[0]["v"]["sample_size"] == 25
    with pytest.raises(ValueError, match="Unknown window"):
        run(spark, versions(spark, ("v", "d")), rows, training(spark), window="1y")
    with pytest.raises(ValueError, match="Unknown feature"):
        run(spark, versions(spark, ("v", "d")), rows, training(spark), features=["nope"])


def test_empty_side_has_a_note_and_no_score(spark):
    _, results = run(spark, versions(spark, ("v", "d")), predictions("v", 120, tenure=lambda i: None), training(spark))
    row = results["v", "tenure"]
    assert row["score"] is None and row["p_value"] is None and not row["drift_detected"] and row["note"] == drift.NO_VALUES_NOTE


def test_empty_category_counts_but_null_does_not(spark):
    _, results = run(spark, versions(spark, ("v", "d")), predictions("v", 120, plan=lambda i: ["", None][i % 2]), training(spark))
    assert results["v", "plan"]["production_n"] == 60


def test_newest_rows_only(spark):
    rows = predictions("v", 100, days_old=3, tenure=lambda i: 1000) + predictions("v", 100)
    config = MonitorConfig(max_sample=100)
    header, results = run(spark, versions(spark, ("v", "d")), rows, training(spark), config=config)
    assert header["v"]["sample_size"] == 200 and header["v"]["n_sampled_for_computation"] == 100
    assert results["v", "tenure"]["production_n"] == 100
    assert results["v", "tenure"]["score"] == pytest.approx(brute_ks(np.arange(300) % 73, np.arange(100) % 72))


def test_production_version_or_none(spark):
    rows = predictions("v", 120)
    args = (training(spark), log(spark, rows), CONTRACT)
    staged = versions(spark, ("v", "d"), ("w", "d")).withColumn("stage", F.when(F.col("model_version_id") == "v", "production").otherwise("candidate"))
    header, results = drift.version_drift(staged, *args, as_of=F.lit(NOW))
    assert [(r["model_version_id"], r["status"], r["sample_size"]) for r in header.collect()] == [("v", "ok", 120)]
    assert {r["model_version_id"] for r in results.collect()} == {"v"}
    none, nothing = drift.version_drift(staged.where("stage = 'candidate'"), *args, as_of=F.lit(NOW))
    assert [(r["model_version_id"], r["status"]) for r in none.collect()] == [(None, "no_production_model")] and nothing.count() == 0
    unknown, _ = drift.version_drift(staged, *args, model_version_id="x", as_of=F.lit(NOW))
    assert [(r["model_version_id"], r["status"]) for r in unknown.collect()] == [("x", "unknown_version")]


def test_all_windows_in_one_pass_equal_single_reports(spark):
    rows = predictions("v", 30, days_old=40, tenure=lambda i: 200) + predictions("v", 30, days_old=5) + predictions("v", 30)
    config = MonitorConfig(min_samples=20)
    vs = versions(spark, ("v", "d"))
    found = drift.drift_by_window(vs, training(spark), log(spark, rows), CONTRACT, as_of=F.lit(NOW), config=config).collect()
    got = {(r["window"], r["feature"]): r["score"] for r in found}
    for window in ("24h", "7d", "30d", None):
        _, single = run(spark, vs, rows, training(spark), window=window, config=config)
        for (_, feature), row in single.items():
            assert got[window or "all", feature] == pytest.approx(row["score"], abs=1e-12)
    assert len(got) == 8


def test_unrounded_score_decides(spark):
    results = spark.createDataFrame([("f", 0.09996, 0.1, False, None)], "feature string, score double, threshold double, drift_detected boolean, severity string")
    shown = drift.displayed(results.withColumn("p_value", F.lit(0.5))).head()
    assert shown["score"] == 0.1 and not shown["drift_detected"] and shown["status_text"] == "No drift"


def brute_psi(reference, production, floor=1e-4):
    total = 0.0
    for c in set(reference) | set(production):
        r = reference.get(c, 0) / sum(reference.values()) or floor
        p = production.get(c, 0) / sum(production.values()) or floor
        total += (p - r) * np.log(p / r)
    return total


def test_report_equals_brute_force(spark):
    """Values below, inside, between and above the reference's, ties, new and missing categories, several versions."""
    rng = np.random.default_rng(8)
    train = {d: (rng.normal(i, 1, 3000).round(3), rng.choice(list("abcdef"), 3000)) for i, d in enumerate("de")}
    logged = {v: (rng.normal(j / 2, 2, 400).round(1 + j % 3), rng.choice(list("adxyz")[j % 3 :], 400)) for j, v in enumerate("uvwx")}
    rows = [(f"{v}{i}", v, NOW, float(t), str(p)) for v, (ts, ps) in logged.items() for i, (t, p) in enumerate(zip(ts, ps))]
    frame = spark.createDataFrame([(d, float(t), str(p)) for d, (ts, ps) in train.items() for t, p in zip(ts, ps)], "dataset_id string, tenure double, plan string")
    of = {"u": "d", "v": "d", "w": "e", "x": "e"}
    _, got = run(spark, versions(spark, *of.items()), rows, frame)
    counted = lambda xs: dict(zip(*np.unique(xs, return_counts=True)))
    for v, d in of.items():
        assert got[v, "tenure"]["score"] == pytest.approx(brute_ks(train[d][0], logged[v][0]), abs=1e-12)
        assert got[v, "plan"]["score"] == pytest.approx(brute_psi(counted(train[d][1]), counted(logged[v][1])), abs=1e-9)
        assert (got[v, "plan"]["reference_n"], got[v, "plan"]["production_n"]) == (3000, 400)


def test_second_report_reads_no_training_rows(spark, tmp_path):
    """Kept by content: a later report gives the same although the training rows are gone; new content is added."""
    vs = versions(spark, ("v", "d"), ("w", "d2")).withColumn("content_hash", F.lit("same"))
    rows = predictions("v", 144) + predictions("w", 144, tenure=lambda i: 3 * i)
    first = run(spark, vs, rows, training(spark), kept=str(tmp_path))
    read = []

    def gone(*_):
        read.append(1)
        raise AssertionError("training rows were read")

    unread = training(spark).limit(0)  # no rows: a report that counted it would find nothing
    assert run(spark, vs, rows, unread, kept=str(tmp_path)) == first and first[0]["v"]["reference_n_rows"] == 300
    from tabwatch.operators import reference

    keyed = vs.withColumn(reference.KEY, reference.content_key(F.col("content_hash"), CONTRACT))
    reference.ensure(str(tmp_path), keyed, training(spark), gone)
    assert read == []
    other = versions(spark, ("v", "e")).withColumn("content_hash", F.lit("other"))
    moved = training(spark, "e").withColumn("tenure", F.col("tenure") + 500)
    assert run(spark, other, rows, moved, kept=str(tmp_path))[1]["v", "tenure"]["score"] == 1.0
    assert run(spark, vs, rows, unread, kept=str(tmp_path)) == first


def test_dataset_without_rows_is_counted_once(spark, tmp_path):
    vs = versions(spark, ("v", "none")).withColumn("content_hash", F.lit("empty"))
    for _ in range(2):
        header, results = run(spark, vs, predictions("v", 120), training(spark), kept=str(tmp_path))
        assert header["v"]["reference_n_rows"] in (0, None) and results["v", "tenure"]["note"] == drift.NO_VALUES_NOTE
