"""Classification metrics from scored rows, grouped by any keys in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.stats import ratio_or_zero
from tabwatch.operators.ordered import global_cumsum

SCORES = ("accuracy", "precision", "recall", "f1")
CELLS = ("true_negative", "false_positive", "false_negative", "true_positive")


def confusion_matrix(scored: DataFrame, keys: Sequence[str] = (), *, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return scored.groupBy(*keys).agg(
        F.count_if(~y & ~p).alias("true_negative"),
        F.count_if(~y & p).alias("false_positive"),
        F.count_if(y & ~p).alias("false_negative"),
        F.count_if(y & p).alias("true_positive"),
    )


def with_scores(matrix: DataFrame) -> DataFrame:
    """Adds accuracy, precision, recall and F1; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    return matrix.select(
        "*",
        ratio_or_zero(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_auc(
    scored: DataFrame, keys: Sequence[str] = (), *, label: str = "label", probability: str = "probability"
) -> DataFrame:
    """(keys, roc_auc): exact area with ties counted half; null when a class is absent.

    Scored rows are reduced to counts per distinct score first, then each score's positives are set
    against the negatives below it through the global running total.
    """
    keys = list(keys) or ["_all"]
    rows = scored.withColumn("_all", F.lit(0)) if keys == ["_all"] else scored
    counts = rows.groupBy(*keys, F.col(probability).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    run = global_cumsum(counts, keys, "score", ["pos", "neg"], strata=[])
    below = F.col("cum_neg") - F.col("neg")
    area = F.sum(F.col("pos").cast("double") * (below + F.col("neg") * 0.5))
    pairs = F.first("total_pos").cast("double") * F.first("total_neg")
    out = run.groupBy(*keys).agg(F.try_divide(area, pairs).alias("roc_auc"))
    return out.drop("_all")


def evaluation_report(
    scored: DataFrame, keys: Sequence[str], *, label: str = "label", prediction: str = "prediction", probability: str = "probability"
) -> DataFrame:
    """One row per keys: confusion matrix, the four scores and the area under the ROC curve."""
    matrix = with_scores(confusion_matrix(scored, keys, label=label, prediction=prediction))
    return matrix.join(roc_auc(scored, keys, label=label, probability=probability), list(keys), "left")


def nested_metrics(report: DataFrame) -> DataFrame:
    """Replaces the flat columns by one `metrics` struct, as the registry stores it."""
    keep = [c for c in report.columns if c not in (*SCORES, *CELLS, "roc_auc")]
    return report.select(
        *keep, F.struct(*SCORES, "roc_auc", F.struct(*CELLS).alias("confusion_matrix")).alias("metrics")
    )


def flat_metrics(report: DataFrame, prefix: str) -> DataFrame:
    """Adds `flat`, a map of `<prefix>_<metric>` to double with the confusion matrix flattened."""
    pairs = [(f"{prefix}_{m}", F.col(m)) for m in (*SCORES, "roc_auc")]
    pairs += [(f"{prefix}_confusion_matrix_{c}", F.col(c)) for c in CELLS]
    entries = [x for name, value in pairs for x in (F.lit(name), value.cast("double"))]
    return report.withColumn("flat", F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull()))
