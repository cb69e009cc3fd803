"""Value counts of training data, prepared once for a dataset and looked up by every drift report.

A reference has two tables, both keyed by the columns `by` and the feature:

* values: one row per distinct value with its bucket, count and, for numbers, the running count inside the bucket;
* summary: the upper bounds of the buckets (`edges`), the counts before each bucket (`before`), the count of usable
  values and what the population stability index sums to if no category of the reference occurs.

Edges are a sample of the distinct values as a function of the data alone: of each of 1024 hash slots the value with the
least hash, and the ends of the range. Buckets only balance the work; results do not depend on them.

`ensure` keeps references in a folder under their content address. Only absent ones are computed, each into its own
directory; the summary is written last and marks a reference as whole, so a build that broke off is simply repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.schema import DatasetContract
from tabwatch.session import stored

SLOTS = 1024
_BITS = 11  # buckets are found in a binary search over up to 2**_BITS - 1 edges
#: Buckets of values outside the range of the reference, and of categories, where order does not matter.
SPREAD, ABOVE = 256, 1 << 20
KEY = "ref_key"
_VALUES = "feature string, bucket int, num double, cat string, n bigint, run bigint"
_SUMMARY = (
    "feature string, edges array<double>, before array<bigint>, total bigint, categories bigint, "
    "sum_ln double, sum_n_ln double"
)


@dataclass(frozen=True)
class Reference:
    values: DataFrame
    summary: DataFrame
    by: tuple[str, ...]


def with_bucket(rows: DataFrame) -> DataFrame:
    """Adds `bucket` to rows with num, cat and the `edges` of their feature.

    For numbers the count of edges below; outside of the edges and for categories a hash. The search halves its range
    step by step; each step names the one before it as a lateral column alias, inside generated code.
    """
    columns, steps, found = [f"`{c}`" for c in rows.columns], [], "0"
    for bit in reversed(range(_BITS)):
        step = 1 << bit
        steps.append(f"{found} + IF(get(edges, {found} + {step - 1}) < num, {step}, 0) AS _b{bit}")
        found = f"_b{bit}"
    outside = f"CAST(pmod(xxhash64(num), {SPREAD}) AS INT)"
    bucket = f"""CASE WHEN num IS NULL THEN coalesce(CAST(pmod(xxhash64(cat), {SPREAD}) AS INT), 0)
        WHEN num < get(edges, 0) THEN -1 - {outside} WHEN num > get(edges, size(edges) - 1) THEN {ABOVE} + {outside} ELSE {found} END"""
    return rows.selectExpr(*columns, *steps).selectExpr(*columns, f"{bucket} AS bucket")


def _edges(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    num, drawn = F.col("num"), F.xxhash64("num")
    slots = (
        counts.where(F.when(F.col("n") > 0, num).isNotNull())
        .groupBy(*by, "feature", F.pmod(drawn, F.lit(SLOTS)).alias("_slot"))
        .agg(F.min(F.struct(drawn.alias("h"), num.alias("v"))).alias("_s"), F.min(num).alias("_lo"), F.max(num).alias("_hi"))
    )
    ends = F.array(F.min("_lo"), F.max("_hi"))
    return slots.groupBy(*by, "feature").agg(F.array_sort(F.array_distinct(F.concat(F.collect_list("_s.v"), ends))).alias("edges"))


def values_of(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The values table of counts (by, feature, num, cat, n)."""
    bucketed = with_bucket(counts.join(_edges(counts, by), [*by, "feature"], "left")).drop("edges")
    upto = Window.partitionBy(*by, "feature", "bucket").orderBy("num").rowsBetween(Window.unboundedPreceding, 0)
    run = F.when(F.col("num").isNotNull(), F.sum("n").over(upto))
    return bucketed.select(*by, "feature", "bucket", "num", "cat", "n", run.alias("run"))


def summary_of(values: DataFrame, by: Sequence[str]) -> DataFrame:
    n = F.col("n").cast("double")
    buckets = values.groupBy(*by, "feature", "bucket").agg(
        F.max("num").alias("_edge"), F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_k"),
        F.sum(F.ln(n)).alias("_l"), F.sum(n * F.ln(n)).alias("_m"),
    )
    earlier = Window.partitionBy(*by, "feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    rows = F.array_sort(F.collect_list(F.when(F.col("_edge").isNotNull(), F.struct("bucket", "_edge", "_before"))))
    return buckets.groupBy(*by, "feature").agg(
        rows.alias("_r"), F.sum("_n").alias("total"), F.sum("_k").alias("categories"), F.sum("_l").alias("sum_ln"), F.sum("_m").alias("sum_n_ln")
    ).select(*by, "feature", F.col("_r._edge").alias("edges"), F.col("_r._before").alias("before"), "total", "categories", "sum_ln", "sum_n_ln")


def lazy(counts: DataFrame, by: Sequence[str]) -> Reference:
    """A reference that is computed where it is used."""
    values = values_of(counts, by)
    return Reference(values, summary_of(values, by), tuple(by))


def temporary(counts: DataFrame, by: Sequence[str]) -> Reference:
    """A reference for one report, written once to the shared folder."""
    values = stored(values_of(counts, by), "reference-values")
    return Reference(values, stored(summary_of(values, by), "reference-summary"), tuple(by))


def all_absent(floor: float) -> str:
    """PSI of a summary's categories if none occurs in production: the sum of (f - r) ln(f / r) over shares r = n / total."""
    f = f"{floor!r}D"
    sum_ln_r, sum_r_ln_r = "(sum_ln - categories * ln(total))", "(sum_n_ln / total - ln(total))"
    return f"categories * {f} * ln({f}) - {f} * {sum_ln_r} - ln({f}) + {sum_r_ln_r}"


def content_key(content: Column, contract: DatasetContract) -> Column:
    """Content address of a reference: the dataset's content and the features counted, with their kinds."""
    kinds = ",".join(f"{c}:{'n' if c in contract.numeric_columns else 'c'}" for c in contract.features)
    return F.sha2(F.concat_ws("|", F.lit(hashlib.sha256(kinds.encode()).hexdigest()), content.cast("string")), 256)


def _kept(spark, path: str) -> Reference | None:
    try:
        values, summary = (
            spark.read.schema(f"{ddl}, {KEY} string").parquet(f"{path}/{name}")
            for name, ddl in (("values", _VALUES), ("summary", _SUMMARY))
        )
    except AnalysisException:  # nothing was written yet
        return None
    return Reference(values, summary, (KEY,))


def ensure(
    path: str, wanted: DataFrame, training_rows: DataFrame, count: Callable[[DataFrame, list[str]], DataFrame], *, ref: str = "dataset_id",
) -> Reference:
    """The references kept below `path`, with those of `wanted` (ref, ref_key) among them.

    `count(rows, keys)` makes the value counts of training rows; it is called, and the rows are read, only for keys that
    are not there yet. Datasets of equal content are counted once. A dataset without rows has a summary without values.
    """
    spark = wanted.sparkSession
    kept = _kept(spark, path)
    missing = wanted.select(ref, KEY).where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min(ref).alias(ref))
    if kept is not None:
        missing = missing.join(kept.summary.select(KEY).distinct(), KEY, "left_anti")
    new = missing.collect()  # a row for each new dataset of the registry
    missing = spark.createDataFrame(new, missing.schema)
    if not new:
        return kept if kept is not None else lazy(count(training_rows.limit(0).withColumn(KEY, F.lit("")), [KEY]), [KEY])
    counts = stored(count(training_rows.join(F.broadcast(missing), ref), [KEY]), "reference-counts")

    def write(df: DataFrame, name: str) -> None:
        dealt = df.hint("rebalance", KEY)
        dealt.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(KEY).parquet(f"{path}/{name}")

    write(values_of(counts, [KEY]), "values")
    values = spark.read.schema(f"{_VALUES}, {KEY} string").parquet(f"{path}/values")
    mine = values.where(F.col(KEY).isin([r[KEY] for r in new]))
    nothing = missing.join(counts.select(KEY).distinct(), KEY, "left_anti").select(KEY, F.lit("").alias("feature"), F.lit(0).cast("bigint").alias("total"))
    write(summary_of(mine, [KEY]).unionByName(nothing, allowMissingColumns=True), "summary")
    return _kept(spark, path)
