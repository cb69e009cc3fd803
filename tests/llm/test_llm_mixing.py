import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import WORD, documents, empty, frame, prose
from pyspark.sql import functions as F

from tabwatch.llm import mixing


def goals(sizes):
    """sizes: Counter by source -> target of each, as the definition goes: share, stop, share the rest again."""
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    budget, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        left, total = budget - sum(target.values()), sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


def test_mix(spark):
    docs = documents(150)
    size = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for d in docs:
        sizes[d[3]] += size(d[1])
    target = goals(sizes)
    rows = mixing.mix(frame(spark, docs)).collect()
    assert sorted(((r["doc_id"], r["size"]) for r in rows), key=str) == sorted(((d[0], size(d[1])) for d in docs), key=str)
    source = {d[0]: d[3] for d in docs if d[0] is not None}
    taken = Counter()
    for r in rows:
        s = source.get(r["doc_id"])
        assert r["source_size"] == sizes[s] and abs(r["target"] - target[s]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    again = mixing.mix(frame(spark, docs).repartition(3)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, rows), key=str)
    assert mixing.mix(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = Counter({f"s{k}": rng.choice([0, 1, 10, 500, 10_000]) for k in range(rng.randint(1, 9))} | {None: 77})
    table = spark.createDataFrame([(k, n) for k, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(table).collect()}
    want = goals(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_quotas_are_exact(spark):
    quotas = {"a": 1000, "b": 1, "c": 0, None: 333, "d": 50}
    rows = mixing.split_quotas(spark.createDataFrame(list(quotas.items()), "source string, n long"), 8).collect()
    by_source, by_shard = Counter(), Counter()
    for r in rows:
        assert r["n"] >= 0
        by_source[r["source"]] += r["n"]
        by_shard[r["shard"]] += r["n"]
    assert by_source == Counter(quotas) + Counter() and max(by_shard.values()) - min(by_shard.values()) <= 1


def test_hypergeometric_distribution(spark):
    """Inversion over a fine grid of uniform numbers gives the exact probabilities."""
    from math import comb

    population, marked, draws = 40, 17, 13
    grid = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"), *[F.lit(v).cast("long").alias(n) for n, v in (("p", population), ("m", marked), ("d", draws))])
    rows = grid.select(mixing.hypergeometric(F.col("p"), F.col("m"), F.col("d"), F.col("u")).alias("x")).groupBy("x").count().collect()
    for r in rows:
        exact = comb(marked, r["x"]) * comb(population - marked, draws - r["x"]) / comb(population, draws)
        assert abs(r["count"] / 4000 - exact) < 0.001


def test_draws_are_disjoint_and_follow_the_quotas(spark):
    docs = documents(150)
    sizes = mixing.document_sizes(frame(spark, docs)).cache()
    target = mixing.targets(sizes).cache()
    rows = mixing.draw(sizes, target, block_words=16, shards=4).collect()
    taken = Counter((r["key"], r["copy"], r["block"], r["pass_no"]) for r in rows)
    assert max(taken.values()) == 1 and {r["shard"] for r in rows} <= set(range(4))
    per_shard = Counter(r["shard"] for r in rows)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1


def test_whole_documents(spark):
    rng = random.Random(5)
    docs = [(k, prose(rng, "en", 40), "en", "ab"[k % 2], 0, *["x"] * 9) for k in range(80)] + [(500, prose(rng, "en", 40), "en", "a", 0, *["x"] * 9)] * 2
    out = mixing.mixed_documents(frame(spark, docs))
    rows = out.collect()
    times = Counter(r["doc_id"] for r in rows)
    texts = {d[0]: d[1] for d in docs}
    assert out.columns == frame(spark, docs).columns
    assert all(r["text"] == texts[r["doc_id"]] for r in rows) and all(n <= (4 if k == 500 else 2) for k, n in times.items())
    words = defaultdict(int)
    for r in rows:
        words[r["source"]] += 40
    sizes = Counter()
    for d in docs:
        sizes[d[3]] += 40
    assert all(abs(words[s] - t) <= 40 for s, t in goals(sizes).items())
    assert mixing.mixed_documents(empty(spark)).count() == 0
    assert np.isfinite(sum(words.values()))
