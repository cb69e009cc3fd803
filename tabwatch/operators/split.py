"""Reproducible stratified splitting and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.stats import ratio_or_zero
from tabwatch.operators.ordered import hash_rank


def fingerprint(seed: int, key: Sequence[str]) -> Column:
    """Hex digest that orders rows the same way on any partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))


def stratified_split(
    df: DataFrame, key: Sequence[str], *, label: str = "label", test_size: float, val_size: float, seed: int
) -> DataFrame:
    """Adds `split` (train / val / test) with exact per-class sizes.

    Rows of each class are ranked by the fingerprint of their key; the first test_size of them are
    test, the next val_size of the *original* count are val. `key` must identify a row.
    """
    if not (0 < test_size < 1 and 0 < val_size < 1 and test_size + val_size < 1):
        raise ValueError("test_size and val_size must be positive and add up to less than 1")
    ranked = hash_rank(df.withColumn("_fp", fingerprint(seed, key)), "_fp", [label], rank="_r", total="_t")
    # Half-up, written out: both borders are the same arithmetic on every engine.
    n_test = F.floor(F.col("_t") * test_size + 0.5)
    n_val = F.floor(F.col("_t") * val_size + 0.5)
    split = F.when(F.col("_r") <= n_test, "test").when(F.col("_r") <= n_test + n_val, "val").otherwise("train")
    return ranked.withColumn("split", split).drop("_fp", "_r", "_t")


def split_sizes(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy("split", label).agg(F.count(F.lit(1)).alias("n_rows"))


def class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """One row: class counts, balanced weights n/(2*n_c), and negatives per positive (1 without positives)."""
    counts = train.agg(
        F.count_if(F.col(label) == 0).alias("n_neg"), F.count_if(F.col(label) == 1).alias("n_pos")
    )
    total = (F.col("n_neg") + F.col("n_pos")).cast("double")
    return counts.select(
        "n_neg",
        "n_pos",
        ratio_or_zero(total, 2 * F.col("n_neg")).alias("weight_neg"),
        ratio_or_zero(total, 2 * F.col("n_pos")).alias("weight_pos"),
        F.when(F.col("n_pos") > 0, F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos").cast("double")))
        .otherwise(1.0).alias("scale_pos_weight"),
    )
