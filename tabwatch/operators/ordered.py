"""Order statistics over data that is too large for one sorted partition.

The one primitive is `global_cumsum`: an exact running total in value order for every key. A window
over (key) alone would pull a large key's whole value range into one task, so values are always cut into
buckets and the window runs inside (key, bucket), whatever the size:

* the input has one row per (key, value), so a heavily repeated value is one row already;
* bucket edges are a sample of a stratum's values (for example a feature's): of each of 4096 hash slots the
  value with the least hash. The sample is a function of the data alone, so every use and every
  recomputation gives the same edges. They only balance the work; results do not depend on them;
* bucket totals are accumulated and joined back on the columns that the window partitioned by, so
  the large side is shuffled once.

Everything is one lazy plan; its branches read the same counts, whose shuffle Spark reuses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BITS = 12  # a stratum has at most 2**_BITS edges


def _bucket_edges(df: DataFrame, keys: Sequence[str], strata: Sequence[str], value: str) -> DataFrame:
    """One sorted array of at most 2**_BITS edges per stratum; its size does not depend on the data."""
    drawn = F.xxhash64(*keys, value)
    slots = df.select(*strata, F.pmod(drawn, F.lit(1 << _BITS)).alias("_slot"), F.struct(drawn.alias("h"), F.col(value).cast("double").alias("v")).alias("_s"))
    firsts = slots.groupBy(*strata, "_slot").agg(F.min("_s").alias("_s"))
    return firsts.groupBy(*strata).agg(F.sort_array(F.collect_list("_s.v")).alias("_edges"))


def with_bucket(df: DataFrame, value: str, keys: Sequence[str], strata: Sequence[str]) -> DataFrame:
    """Adds `_bucket`: the number of edges of the row's stratum below its value.

    `strata` has few distinct combinations whatever the data, such as the feature names of a contract, so the
    edges are broadcast; empty strata are one. The search halves its range step by step; each step names the one
    before it as a lateral column alias, which becomes a chain of projections inside generated code.
    """
    strata, columns = list(strata), [f"`{c}`" for c in df.columns]
    by = strata or ["_whole"]
    rows = df if strata else df.withColumn("_whole", F.lit(0))
    searched = rows.join(F.broadcast(_bucket_edges(rows, keys, by, value)), by, "left").selectExpr(*columns, "_edges")
    steps, found = [], "0"
    for bit in reversed(range(_BITS)):
        step = 1 << bit
        steps.append(f"{found} + IF(get(_edges, {found} + {step - 1}) < CAST(`{value}` AS DOUBLE), {step}, 0) AS _b{bit}")
        found = f"_b{bit}"
    return searched.selectExpr(*columns, *steps).selectExpr(*columns, f"{found} AS _bucket")


def bucket_offsets(bucketed: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per (keys, bucket): `_before_<m>`, the sum over earlier buckets, and `total_<m>` over all."""
    per_key = Window.partitionBy(*keys)
    before = per_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        bucketed.groupBy(*keys, "_bucket")
        .agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
        .select(
            *keys,
            "_bucket",
            *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
            *[F.sum(f"_sum_{m}").over(per_key).alias(f"total_{m}") for m in measures],
        )
    )


def global_cumsum(counts: DataFrame, keys: Sequence[str], value: str, measures: Sequence[str], *, strata: Sequence[str]) -> DataFrame:
    """Adds `cum_<m>` (inclusive running sum in value order per keys) and `total_<m>` per keys.

    `counts` has one row per (keys, value) with a numeric, non-null value and non-null keys.
    `strata` is a subset of `keys` as `with_bucket` takes it. Measures are non-negative counts.
    """
    keys = list(keys)
    # Rows without any count contribute nothing.
    bucketed = with_bucket(counts.where(sum((F.col(m) for m in measures), F.lit(0)) > 0), value, keys, strata)
    running = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = bucketed.select("*", *[F.sum(m).over(running).alias(f"_run_{m}") for m in measures])
    joined = local.join(bucket_offsets(bucketed, keys, measures), [*keys, "_bucket"])
    return joined.select(
        *counts.columns,
        *[(F.col(f"_run_{m}") + F.col(f"_before_{m}")).alias(f"cum_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def exact_median(counts: DataFrame, keys: Sequence[str], value: str, measure: str, *, strata: Sequence[str]) -> DataFrame:
    """Interpolated median per keys from value counts: the one or two middle ranks, averaged.

    A histogram over the buckets tells which one or two of them hold the middle ranks; only these are sorted.
    """
    keys = list(keys)
    bucketed = with_bucket(counts.where(F.col(measure) > 0), value, keys, strata)
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = bucketed.groupBy(*keys, "_bucket").agg(F.sum(measure).alias("_sum")).select(
        *keys, "_bucket", "_sum", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"), F.sum("_sum").over(per_key).alias("_n"),
    )
    lower, upper = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)
    middle = sums.where((F.col("_before") < upper) & (F.col("_before") + F.col("_sum") >= lower)).drop("_sum")
    running = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    rows = bucketed.join(middle, [*keys, "_bucket"]).withColumn("_last", F.sum(measure).over(running) + F.col("_before"))
    last = F.col("_last")
    first, v = last - F.col(measure) + 1, F.col(value).cast("double")
    return rows.groupBy(*keys).agg(
        ((F.max(F.when((first <= lower) & (last >= lower), v)) + F.max(F.when((first <= upper) & (last >= upper), v))) / 2).alias("median")
    )


def hash_rank(df: DataFrame, key: str, strata: Sequence[str], *, rank: str = "rank", total: str = "total") -> DataFrame:
    """Exact 1-based rank of each row by a uniform hex fingerprint `key` within its stratum.

    The first four hex digits are 65 536 even buckets, so ranks need no sampling: a window inside
    (stratum, bucket) plus bucket offsets, joined on the columns the window partitioned by. Equal
    fingerprints have no order between them, so the fingerprint must come from a unique key.
    """
    strata = list(strata)
    bucketed = df.withColumn("_bucket", F.substring(key, 1, 4))
    inside = Window.partitionBy(*strata, "_bucket").orderBy(key)
    per_stratum = Window.partitionBy(*strata)
    offsets = (
        bucketed.groupBy(*strata, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *strata,
            "_bucket",
            F.coalesce(
                F.sum("_n").over(per_stratum.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
            F.sum("_n").over(per_stratum).alias(total),
        )
    )
    return (
        bucketed.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, [*strata, "_bucket"])
        .withColumn(rank, F.col("_rank") + F.col("_before"))
        .drop("_bucket", "_rank", "_before")
    )


def newest_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, *, salt_by: str, salts: int = 64
) -> DataFrame:
    """The first n rows of each group in the given order.

    A hot group is first cut to n rows inside each of its salted slices, so no single task ever sorts
    the whole group; the second cut sees at most salts*n rows per group.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
    first = Window.partitionBy(*keys, "_salt").orderBy(*order)
    second = Window.partitionBy(*keys).orderBy(*order)
    return (
        salted.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= n)
        .withColumn("_rn", F.row_number().over(second)).where(F.col("_rn") <= n)
        .drop("_salt", "_rn")
    )
