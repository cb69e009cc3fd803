import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwatch.operators import evaluate, features, split
from tabwatch.operators.features import CHURN_FEATURES, FeatureSpec
from tabwatch.schema import CHURN, ID, TARGET, ColumnSpec, DatasetContract, categories, numbers

SMALL = FeatureSpec(DatasetContract("s", (ColumnSpec("id", ID), *numbers("a"), *categories("c"), ColumnSpec("y", TARGET)), ("Yes", "No")), {})


def churn_rows(spark, rows):
    cells = [{c: "x" for c in CHURN.categorical_columns} | {"customerID": str(i), "Churn": "No"} | r for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r.get(c) for c in CHURN.required) for r in cells], CHURN.raw_struct())


def test_average_spend(spark):
    raw = churn_rows(spark, [
        {"tenure": "10", "TotalCharges": "500", "MonthlyCharges": "60"}, {"tenure": "0", "TotalCharges": "", "MonthlyCharges": "75"},
        {"tenure": "5", "TotalCharges": " ", "MonthlyCharges": "60"}, {"tenure": None, "TotalCharges": "9", "MonthlyCharges": "8"},
    ])
    rows = features.feature_rows(raw, CHURN_FEATURES)
    assert rows.columns == [*CHURN.features, "label", "AvgMonthlySpend"]
    assert [r["AvgMonthlySpend"] for r in rows.collect()] == [50.0, 75.0, None, 8.0]


def test_numeric_statistics_match_numpy(spark):
    values = [3.0, None, 1.0, 1.0, 10.0, None, 7.5]
    df = spark.createDataFrame([(v, 4.0) for v in values], "a double, constant double")
    out = {r["feature"]: r for r in features.numeric_statistics(df, ["a", "constant"]).collect()}
    present = np.array([v for v in values if v is not None])
    filled = np.array([np.median(present) if v is None else v for v in values])
    a = out["a"]
    assert (a["n"], a["n_missing"], a["median"]) == (7, 2, np.median(present))
    assert a["mean"] == pytest.approx(filled.mean()) and a["std"] == pytest.approx(filled.std())
    assert out["constant"]["std"] == 1.0 and out["constant"]["mean"] == 4.0


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "c string")
    out = {r["value"]: (r["n"], r["is_mode"]) for r in features.category_statistics(df, ["c"]).collect()}
    assert out == {"a": (2, True), "b": (2, False), "c": (1, False)}


def test_statistics_come_from_the_training_fold_only(spark):
    df = spark.range(40).select(F.col("id").cast("double").alias("a"), F.when(F.col("id") < 20, "train").otherwise("test").alias("split"))
    fitted = features.fit_statistics(df.where("split = 'train'"), FeatureSpec(DatasetContract("s", (ColumnSpec("id", ID), *numbers("a"), ColumnSpec("y", TARGET)), ("Yes", "No")), {}))
    assert fitted.mean["a"] == np.arange(20).mean() and fitted.median["a"] == 9.5


def test_one_hot_unseen_and_null(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    new = spark.createDataFrame([(1, "b"), (2, "zzz"), (3, None)], "id int, c string")
    out = {r["id"]: r["category"] for r in features.one_hot(new, features.category_statistics(train, ["c"]), ["c"], ["id"]).collect()}
    assert out == {1: "b", 3: "a"}


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    first = split.stratified_split(df, ["id"], test_size=0.2, val_size=0.1, seed=7)
    sizes = {(r["split"], r["label"]): r["n_rows"] for r in split.split_sizes(first).collect()}
    assert sizes == {("test", 1): 50, ("val", 1): 25, ("train", 1): 175, ("test", 0): 150, ("val", 0): 75, ("train", 0): 525}
    again = split.stratified_split(df.repartition(5, F.rand(1)), ["id"], test_size=0.2, val_size=0.1, seed=7)
    assert first.exceptAll(again).count() == 0
    other = split.stratified_split(df, ["id"], test_size=0.2, val_size=0.1, seed=8)
    assert first.exceptAll(other).count() > 0
    with pytest.raises(ValueError):
        split.stratified_split(df, ["id"], test_size=0.6, val_size=0.5, seed=1)


def test_class_weights(spark):
    row = split.class_weights(spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")).head()
    assert (row["weight_neg"], row["weight_pos"], row["scale_pos_weight"]) == (8 / 12, 8 / 4, 3.0)
    none = split.class_weights(spark.createDataFrame([(0,)], "label int")).head()
    assert none["scale_pos_weight"] == 1.0


def scored(spark, y, p, s):
    return spark.createDataFrame(list(zip(["k"] * len(y), y, p, s)), "k string, label int, prediction int, probability double")


def test_metrics_perfect(spark):
    r = evaluate.evaluation_report(scored(spark, [0, 0, 1, 1], [0, 0, 1, 1], [0.1, 0.2, 0.9, 0.95]), ["k"]).head()
    assert [r[m] for m in (*evaluate.SCORES, "roc_auc")] == [1.0] * 5 and (r["true_negative"], r["true_positive"]) == (2, 2)


def test_metrics_mixed(spark):
    r = evaluate.evaluation_report(scored(spark, [0, 0, 1, 1], [0, 1, 0, 1], [0.2, 0.6, 0.4, 0.8]), ["k"]).head()
    assert [r[c] for c in evaluate.CELLS] == [1, 1, 1, 1] and r["precision"] == r["recall"] == 0.5 and r["roc_auc"] == 0.75


def test_metrics_no_positive_predictions_or_one_class(spark):
    r = evaluate.evaluation_report(scored(spark, [0, 0, 1, 1], [0, 0, 0, 0], [0.1, 0.2, 0.3, 0.4]), ["k"]).head()
    assert r["precision"] == r["recall"] == r["f1"] == 0.0
    one = evaluate.evaluation_report(scored(spark, [1, 1], [1, 0], [0.1, 0.2]), ["k"]).head()
    assert one["roc_auc"] is None


def test_auc_with_ties_equals_all_pairs(spark):
    rng = np.random.default_rng(2)
    y, s = rng.integers(0, 2, 500), rng.integers(0, 40, 500) / 40
    pos, neg = s[y == 1], s[y == 0]
    expected = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    df = scored(spark, y.tolist(), y.tolist(), s.tolist())
    assert evaluate.roc_auc(df).head()["roc_auc"] == pytest.approx(expected, abs=1e-12)


def test_flat_metrics(spark):
    report = evaluate.evaluation_report(scored(spark, [0, 1], [0, 1], [0.1, 0.9]), ["k"])
    flat = evaluate.flat_metrics(report, "val").head()["flat"]
    assert flat["val_accuracy"] == 1.0 and flat["val_confusion_matrix_true_positive"] == 1.0 and len(flat) == 9
