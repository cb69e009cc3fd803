"""From raw text columns to model inputs: engineered columns, fitted statistics, scaled and coded values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.coerce import binary_label, to_numeric
from tabwatch.operators.ordered import exact_median
from tabwatch.schema import CHURN, DatasetContract
from tabwatch.session import stored


#: Places of a column with too many categories to list. Spark keeps a name for each place of a vector in the plan,
#: so this stays in the thousands.
HASHED_POSITIONS = 1 << 13


@dataclass(frozen=True)
class FeatureSpec:
    """A contract plus its engineered numeric columns.

    `engineered` maps a new column to a SQL expression over the typed columns. Expressions see one
    row only, so they can run before the split without leaking anything, and as text they persist
    with a saved pipeline.
    """

    contract: DatasetContract
    engineered: Mapping[str, str]

    @property
    def numeric(self) -> tuple[str, ...]:
        return (*self.contract.numeric_columns, *self.engineered)

    @property
    def categorical(self) -> tuple[str, ...]:
        return self.contract.categorical_columns


def average_spend(total: str, periods: str, current: str) -> str:
    """Total per period; without a positive number of periods the current amount stands in."""
    return f"CASE WHEN `{periods}` > 0 THEN `{total}` / `{periods}` ELSE `{current}` END"


CHURN_FEATURES = FeatureSpec(CHURN, {"AvgMonthlySpend": average_spend("TotalCharges", "tenure", "MonthlyCharges")})


def feature_rows(df: DataFrame, spec: FeatureSpec, *, keep: Sequence[str] = (), target: bool = True) -> DataFrame:
    """Typed contract features in contract order, the engineered columns and, if asked, `label` 0/1.

    Columns outside the contract are dropped, apart from `keep`.
    """
    contract = spec.contract
    numeric = [to_numeric(F.col(f"`{c}`")).alias(c) for c in contract.numeric_columns]
    columns = [*[F.col(c) for c in keep], *numeric, *[F.col(f"`{c}`") for c in contract.categorical_columns]]
    if target:
        columns.append(binary_label(F.col(f"`{contract.target_column}`"), contract.positive_label).alias("label"))
    typed = df.select(*columns)
    return typed.withColumns({name: F.expr(sql) for name, sql in spec.engineered.items()}) if spec.engineered else typed


def _long_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("_e")).select("_e.feature", "_e.value")


def numeric_statistics(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n, n_missing, median, mean, std) of the training fold.

    Mean and population deviation are taken after imputation with the exact interpolated median. They
    follow from the moments of the present values and the number of missing ones, so the data is
    aggregated once, to value counts, for all columns together. A zero deviation becomes 1.
    """
    counts = _long_numeric(train, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "numeric-counts")  # medians, then moments: the rows and what made them are read once
    present = counts.where("value IS NOT NULL")
    median = exact_median(present, ["feature"], "value", "n", strata=["feature"])
    centre = F.first("median")
    weight = F.when(F.col("value").isNotNull(), F.col("n"))
    # Deviations are taken from the median: numerically stable, and missing values contribute zero.
    shift = F.col("value") - F.col("median")
    moments = (
        counts.join(F.broadcast(median), "feature", "left")
        .groupBy("feature")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_missing"),
            centre.alias("median"),
            F.coalesce(F.sum(weight * shift), F.lit(0.0)).alias("_s1"),
            F.coalesce(F.sum(weight * shift * shift), F.lit(0.0)).alias("_s2"),
        )
    )
    mean_shift = F.col("_s1") / F.col("n")
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("_s2") / F.col("n") - mean_shift * mean_shift))
    return moments.select(
        "feature", "n", "n_missing", "median",
        (F.col("median") + mean_shift).alias("mean"),
        F.when(std > 0, std).otherwise(1.0).alias("std"),
    )


def category_statistics(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n, is_mode): the vocabulary of the training fold; ties go to the smallest value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value")) for c in columns])
    counts = (
        train.select(F.explode(pairs).alias("_e")).where(F.col("_e.value").isNotNull())
        .groupBy("_e.feature", "_e.value").agg(F.count(F.lit(1)).alias("n"))
    )
    top = counts.where(F.col("n") > 0).groupBy("feature").agg(
        F.min(F.struct((-F.col("n")).alias("o"), F.col("value").alias("mode"))).alias("_m")
    )
    return counts.where(F.col("n") > 0).join(F.broadcast(top), "feature").select(
        "feature", "value", "n", (F.col("value") == F.col("_m.mode")).alias("is_mode")
    )


@dataclass(frozen=True)
class FittedStatistics:
    """Imputation and scaling parameters: a handful of numbers per column, held on the driver."""

    median: dict[str, float]
    mean: dict[str, float]
    std: dict[str, float]
    mode: dict[str, str]
    n_categories: dict[str, int]


def fit_statistics(train: DataFrame, spec: FeatureSpec) -> FittedStatistics:
    """Collects one row per column of the contract; nothing here grows with the data."""
    numeric = {r["feature"]: r for r in numeric_statistics(train, spec.numeric).collect()} if spec.numeric else {}
    columns = {}
    if spec.categorical:
        summary = category_statistics(train, spec.categorical).groupBy("feature").agg(
            F.max(F.when(F.col("is_mode"), F.col("value"))).alias("mode"), F.count(F.lit(1)).alias("n_categories")
        )
        columns = {r["feature"]: r for r in summary.collect()}
    return FittedStatistics(
        median={f: r["median"] for f, r in numeric.items()},
        mean={f: r["mean"] for f, r in numeric.items()},
        std={f: r["std"] for f, r in numeric.items()},
        mode={f: r["mode"] for f, r in columns.items()},
        n_categories={f: r["n_categories"] for f, r in columns.items()},
    )


def standardized(df: DataFrame, stats: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep, feature, z): median-imputed, standardised values in long form.

    `stats` has one row per column and is broadcast.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    long = df.select(*keep, F.explode(pairs).alias("_e")).select(*keep, "_e.feature", "_e.value")
    z = (F.coalesce("value", "median") - F.col("mean")) / F.col("std")
    return long.join(F.broadcast(stats.select("feature", "median", "mean", "std")), "feature").select(*keep, "feature", z.alias("z"))


def hashed_position(value: str, positions: int) -> str:
    """SQL of the place among `positions` that stands for a category: the first 32 bits of its MD5, modulo `positions`."""
    return f"CAST(conv(substring(md5({value}), 1, 8), 16, 10) AS BIGINT) % {positions}"


def hashed_collisions(vocabulary: DataFrame, positions: int = HASHED_POSITIONS) -> DataFrame:
    """(feature, n_categories, n_positions, n_collided): how many categories share their hashed position with another.

    `vocabulary` is a table as of category_statistics; it stays distributed, whatever the number of categories.
    """
    placed = vocabulary.groupBy("feature", F.expr(hashed_position("value", positions)).alias("position")).agg(F.count(F.lit(1)).alias("n"))
    return placed.groupBy("feature").agg(
        F.sum("n").alias("n_categories"), F.count(F.lit(1)).alias("n_positions"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("n_collided"),
    )


def one_hot(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep, feature, category): the single set position of each one-hot block.

    Null takes the training mode. A value unseen in training has no row: its block is all zeros.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value")) for c in columns])
    long = df.select(*keep, F.explode(pairs).alias("_e")).select(*keep, "_e.feature", "_e.value")
    # One row per column, so small whatever the vocabulary; the vocabulary itself is joined by size.
    modes = vocabulary.where("is_mode").select("feature", F.col("value").alias("_mode"))
    filled = long.join(F.broadcast(modes), "feature").withColumn("category", F.coalesce("value", "_mode"))
    known = vocabulary.select("feature", F.col("value").alias("category"))
    return filled.join(known, ["feature", "category"], "left_semi").select(*keep, "feature", "category")
