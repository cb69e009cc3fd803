"""Penalised logistic regression by Newton's method: one aggregate over the rows for each step.

A step needs the loss, its gradient and its curvature, sums over the rows whose size is the number of columns
squared. Tasks add them up in batches and give one set of sums each; Spark adds those up by place. What reaches
the driver depends on the number of columns alone, which MAX_COLUMNS bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import Identifiable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.session import stored

#: Wider problems are left to Spark's own solver of the same problem: sums of a task would be above 1 MB.
MAX_COLUMNS = 256
#: Steps stop when the loss has no more than this part of itself left to gain, the last one taken.
GAIN = 1e-12


def _task_sums(beta: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    size = len(beta)
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, curvature = 0.0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            label, weight = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size - 1)
            x = np.column_stack([values, np.ones(batch.num_rows)])
            margin = x @ beta
            chance = 0.5 * (1 + np.tanh(margin / 2))
            loss += float(weight @ (np.logaddexp(0, margin) - label * margin))
            gradient += x.T @ (weight * (chance - label))
            curvature += x.T @ (x * (weight * chance * (1 - chance))[:, None])
        sums = np.concatenate([[loss], gradient, curvature[upper]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums)], ["place", "value"])

    return run


def _sums(rows: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    added = rows.mapInArrow(_task_sums(beta), "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    size = len(beta)
    sums = np.zeros(1 + size + size * (size + 1) // 2)
    for place, value in added.collect():
        sums[place] = value
    curvature = np.zeros((size, size))
    curvature[np.triu_indices(size)] = sums[1 + size:]
    return sums[0], sums[1:1 + size], curvature + np.triu(curvature, 1).T


def solve(rows: DataFrame, n_columns: int, penalty: float, max_iter: int) -> tuple[np.ndarray, int]:
    """The coefficients, the intercept last, and the number of passes over `rows` (label, weight, features array).

    Minimises sum(weight * loss) + penalty * |b|^2 / 2, the intercept not penalised. A step that makes the loss
    larger is halved. Both labels must occur and have weight, otherwise the intercept has no finite best value.
    """
    ridge = np.r_[np.full(n_columns, penalty), 0.0]
    beta, step, best = np.zeros(n_columns + 1), np.zeros(n_columns + 1), np.inf
    passes = 0
    while passes < max_iter:
        passes += 1
        loss, gradient, curvature = _sums(rows, beta + step)
        total = loss + float(ridge @ (beta + step) ** 2) / 2
        if total > best * (1 + GAIN):
            step = step / 2
            continue
        beta, best = beta + step, total
        gradient = gradient + ridge * beta
        step = -np.linalg.lstsq(curvature + np.diag(ridge), gradient, rcond=None)[0]
        if -float(gradient @ step) / 2 <= GAIN * best:
            return beta + step, passes
    return beta, passes


def model_of(spark: SparkSession, beta: np.ndarray) -> LogisticRegressionModel:
    """Spark's own model with these coefficients, so that it is saved, loaded and applied like any other."""
    from pyspark.ml.common import _py2java

    uid = Identifiable()._randomUID().replace("Identifiable", "LogisticRegression")
    coefficients = _py2java(spark.sparkContext, Vectors.dense(beta[:-1]))
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(uid, coefficients, float(beta[-1]))
    return LogisticRegressionModel(java)


class NewtonLogisticRegression:
    """Estimator over (label, features, weight) rows; `wide` fits problems that have more than MAX_COLUMNS columns."""

    def __init__(self, penalty: float, max_iter: int, weight: str, wide) -> None:
        self.penalty, self.max_iter, self.weight, self.wide = penalty, max_iter, weight, wide

    def fit(self, rows: DataFrame) -> LogisticRegressionModel:
        first = rows.select("features").head()
        if first is None or not 0 < first["features"].size <= MAX_COLUMNS:
            return self.wide.fit(rows)
        plain = rows.select(F.col("label").cast("double"), F.col(self.weight).cast("double").alias("weight"), vector_to_array("features").alias("features"))
        plain = stored(plain, "encoded")  # encoding a row takes longer than a pass over it
        return model_of(rows.sparkSession, solve(plain, first["features"].size, self.penalty, self.max_iter)[0])
