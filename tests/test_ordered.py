import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwatch.operators import ordered


def skewed_counts(spark, rng):
    """One key holds most rows; some values repeat across keys; one value is extremely frequent."""
    rows = []
    for key, n in (("hot", 3000), ("warm", 200), ("cold", 1)):
        values = np.unique(np.round(rng.lognormal(0, 3, n), 3))
        for v in values:
            rows.append((key, "f", float(v), int(rng.integers(0, 5)), int(rng.integers(0, 3))))
    rows.append(("hot", "f", -1.0, 10**6, 0))
    rows.append(("warm", "f", float("inf"), 2, 2))
    return rows


def test_running_total_is_exact(spark):
    rows = skewed_counts(spark, np.random.default_rng(3))
    df = spark.createDataFrame(rows, "key string, feature string, v double, a bigint, b bigint").repartition(7)
    out = ordered.global_cumsum(df, ["key", "feature"], "v", ["a", "b"], strata=["feature"]).collect()
    got = {(r["key"], r["v"]): (r["cum_a"], r["cum_b"], r["total_a"], r["total_b"]) for r in out}
    expected = {}
    for key in ("hot", "warm", "cold"):
        mine = sorted(r[2:] for r in rows if r[0] == key)
        ta, tb = sum(m[1] for m in mine), sum(m[2] for m in mine)
        ca = cb = 0
        for v, a, b in mine:
            ca, cb = ca + a, cb + b
            if a + b > 0:
                expected[key, v] = (ca, cb, ta, tb)
    assert got == expected


def test_split_groups_spread_over_many_buckets(spark):
    df = spark.range(20000).select(F.lit("f").alias("feature"), F.exp(F.col("id") / 500.0).alias("v"))
    sizes = ordered.with_bucket(df, "v", ["feature"], ["feature"]).groupBy("_bucket").count()
    top, n = sizes.agg(F.max("count"), F.count("*")).head()
    assert n > 2000 and top < 200


def test_edges_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).select(F.lit("f").alias("feature"), F.sqrt("id").alias("v"))
    one = ordered.with_bucket(df.coalesce(1), "v", ["feature"], ["feature"])
    many = ordered.with_bucket(df.repartition(13), "v", ["feature"], ["feature"])
    assert one.exceptAll(many).count() == 0


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0, 4.0], [5.0], [1.0, 1.0, 1.0, 9.0], [0.0, 10.0], list(range(101))])
def test_exact_median(spark, values):
    df = spark.createDataFrame([("f", float(v)) for v in values], "feature string, v double")
    counts = df.groupBy("feature", "v").agg(F.count("*").alias("n"))
    out = ordered.exact_median(counts, ["feature"], "v", "n", strata=["feature"]).head()
    assert out["median"] == float(np.median(values))


def test_hash_rank_equals_one_big_window(spark):
    df = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("fp"), (F.col("id") % 3 == 0).alias("s"))
    out = ordered.hash_rank(df, "fp", ["s"]).collect()
    for stratum in (True, False):
        mine = sorted((r["fp"], r["rank"]) for r in out if r["s"] == stratum)
        assert [m[1] for m in mine] == list(range(1, len(mine) + 1))
        assert {r["total"] for r in out if r["s"] == stratum} == {len(mine)}


def test_newest_per_group_with_hot_group(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, "a").otherwise("b").alias("g"), (F.col("id") % 100).alias("t"), "id")
    out = ordered.newest_per_group(df, ["g"], [F.col("t").desc(), F.col("id")], 7, salt_by="id").collect()
    for g, ids in (("a", range(1500)), ("b", range(1500, 2000))):
        expected = sorted(ids, key=lambda i: (-(i % 100), i))[:7]
        assert sorted(r["id"] for r in out if r["g"] == g) == sorted(expected)
