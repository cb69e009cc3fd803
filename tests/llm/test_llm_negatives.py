import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwatch.llm import negatives

DDL = "vec_id long, label int, embedding array<float>, copy string, vector string, part int"


def brute(rows):
    kept = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        scaled = [max(-negatives.LIMIT, min(negatives.LIMIT, math.floor(256 * float(np.float32(x))))) for x in vector]
        kept.append((vec_id, label, tuple(scaled)))
    out = []
    for anchor in set(k for k in kept if k[0] % 50 == 0):
        scores = [(-sum(a * b for a, b in zip(anchor[2], k[2])), k[0], k[1]) for k in kept]
        positives = sorted(s for s in scores if s[2] == anchor[1] and s[1] != anchor[0])[:5]
        for p, positive_id, _ in positives:
            fits = sorted(s[:2] for s in scores if s[2] != anchor[1] and 50 * -p <= 100 * -s[0] <= 95 * -p)[:3]
            out += [(anchor[0], positive_id, rank + 1, n, -p, -s) for rank, (s, n) in enumerate(fits)]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "c", "v", 1) for r in rows], DDL).repartition(3)
    return sorted(tuple(r) for r in negatives.mine(negatives.prepared(df)).collect())


def vectors(n=330, seed=3, dims=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    rows = []
    for k in range(n):
        v = centres[k % 4] * 0.6 + rng.normal(size=dims) * 0.5
        rows.append((k, int(k % 4 if k % 3 else rng.integers(0, 4)), [float(x) for x in v]))
    return rows


def test_equals_brute_force_with_small_tiles(spark, monkeypatch):
    for name, value in (("TILE", 17), ("ANCHORS", 2), ("GROUP", 2), ("PART", 2), ("LEAF", 2)):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors()
    assert found(spark, rows) == brute(rows) != []


def test_odd_rows(spark):
    rows = vectors(120)
    rows += [(200, None, [0.1] * 12), (250, 1, None), (300, 1, [0.1, None]), (350, 1, [float("nan")] * 12), (400, 2, [float("inf")] * 12)]
    rows += [(None, 1, [0.5] * 12), (450, 1, []), (451, 1, [0.5]), (452, 2, [0.25] * 20), (500, 3, [3e38] * 12), (501, 3, [-3e38] * 12)]
    rows += [rows[50], rows[50], (50, 9, [0.2] * 12), rows[7], (0, 3, [0.0] * 12)]  # repeated, and one id with two contents
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_ties_and_hot_label(spark):
    rows = [(k, 1 if k % 5 else 2, [0.5, 0.25, 0.0]) for k in range(260)] + [(1000 + k, 2, [0.3, 0.25, 0.0]) for k in range(40)]
    got = found(spark, rows)
    assert got == brute(rows) and len(got) > 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 70), st.integers(0, 70), st.integers(0, 70), st.integers(0, 1 << 30))
def test_strassen(m, k, n, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-1 << 26, 1 << 26, (m, k)), rng.integers(-1 << 26, 1 << 26, (k, n))
    kept, negatives.LEAF = negatives.LEAF, 3
    try:
        assert (negatives.strassen(a, b) == a @ b).all()
    finally:
        negatives.LEAF = kept


@given(st.integers(-(1 << 61), 1 << 61))
def test_bounds(p):
    low, high = (int(x[0]) for x in negatives.bounds(np.array([p])))
    for n in (low, high):
        if low <= high:
            assert 50 * p <= 100 * n <= 95 * p
    assert not (50 * p <= 100 * (low - 1)) and not (100 * (high + 1) <= 95 * p)


@pytest.mark.parametrize("cut", [1, 5, 40])
def test_heaps_merge(cut):
    rng = np.random.default_rng(cut)
    scores, ids = rng.integers(-3, 3, (6, 40)), np.arange(40)
    heap = negatives.Heaps(6, 5)
    for start in range(0, 40, cut):
        heap.push(scores[:, start : start + cut], ids[start : start + cut])
    for i in range(6):
        want = sorted((-s, j) for j, s in enumerate(scores[i].tolist()))[:5]
        assert list(zip((-heap.scores[i]).tolist(), heap.ids[i].tolist())) == want
