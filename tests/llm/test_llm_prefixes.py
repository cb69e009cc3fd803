import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tabwatch.llm import prefixes, running

DDL = "conv_id long, turn long, role string, text string, node string, depth int, place int, part int"


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    for c in convs:
        convs[c].sort()
    built = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = [t[1:] for t in convs.get(c - c % 5, [])[:h]] + [t[1:] for t in convs[c][h:]]
    members, children = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[j] for j in children[k]) if children[k] else 1
        saved[k] = (len(members[k]) - 1) * len(k[-1][1].encode() if k else b"") + sum(saved[j] for j in children[k])
        ends = ",".join(str(c) for c in members[k] if len(built[c]) == len(k))
        parent = members[k[:-1]][0] if k else None
        out.append((members[k][0], len(k), parent, len(members[k]), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "n", 1, 2, 3) for r in rows], DDL).repartition(4)
    nodes = prefixes.trie(prefixes.regrouped(prefixes.ordered_turns(df))).collect()
    assert len({r["node"] for r in nodes}) == len(nodes)
    owners = {r["node"]: r["conv_id"] for r in nodes}
    assert all(owners.get(r["parent"]) == r["parent_conv_id"] for r in nodes)
    return sorted((tuple(r)[2:] for r in nodes), key=str)


def conversations(n=60, seed=1):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "hello there", "ünïcode", ""]))
            for c in range(n) for t in range(rng.randint(1, 12))]


@pytest.mark.parametrize("shard", [1 << 18, 7])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(prefixes, "SHARD_ROWS", shard)
    monkeypatch.setattr(prefixes, "CHUNK_BYTES", 60)
    rows = conversations()
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(5, None, None, None), (5, 2, "user", None), (5, 2, "user", "b"), (5, 2, "assistant", "b"), (6, 1, None, "x"), (6, None, "u", "y")]
    rows += [(None, 1, "user", "nobody"), (7, 1, "user", "same"), (7, 1, "user", "same"), (7, 1, "user", "same"), (11, -4, "a", "long " * 50_000)]
    rows += [(c, 1, "user", "hi") for c in (20, 21, 22, 1_000_000_007)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_hot_prefix_and_long_conversation(spark):
    rows = [(c, t, "user", "the same" if t < 3 else f"{c}") for c in range(0, 300, 5) for t in range(4)]
    rows += [(1003, t, "user", f"turn {t % 17}") for t in range(3000)] + [(1010, t, "user", f"turn {t % 17}") for t in range(3000)]
    assert found(spark, rows) == brute(rows)


def test_one_key_over_many_tasks(spark):
    rows = [(1, k, k % 5) for k in range(500)] + [(2, 0, 3), (3, 1, 1), (3, 0, 2)] + [(4, k, 1) for k in range(400)]
    random.Random(1).shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running.running(spark.createDataFrame(rows, "k long, o long, v long").repartition(3), "k", ["o"], ["o"], ["v"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = []
    for key in (1, 2, 3, 4):
        total = 0
        for place, (_, o, v) in enumerate(sorted(r for r in rows if r[0] == key)):
            total += v
            want.append((key, o, place + 1, total))
    assert sorted((r["k"], r["o"], r["place"], r["run_v"]) for r in out) == want


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_slots_are_minimal_and_verified(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, (2, n), np.uint64)
    table = prefixes.SlotTable(*keys)
    assert sorted(table.find(*keys).tolist()) == list(range(n))
    others = np.random.default_rng(n + 1).integers(0, 1 << 63, (2, 500), np.uint64)
    assert (table.find(*others) == -1).all()


def test_equal_digests_of_different_prefixes_are_refused():
    with pytest.raises(RuntimeError):
        prefixes._scattered(np.array([1, 2]), np.array([0, 0]), 1)


def test_whole_paths_keep_conversations_together():
    import pyarrow as pa

    depth = np.concatenate([np.arange(n) for n in (3, 9, 1, 1, 4, 12, 2)])
    conv = np.repeat(np.arange(7), [3, 9, 1, 1, 4, 12, 2])
    batches = [pa.RecordBatch.from_arrays([pa.array(depth[a : a + 5]), pa.array(conv[a : a + 5])], names=["depth", "conv_id"]) for a in range(0, len(depth), 5)]
    for most in (1, 4, 6, 100):
        runs = list(prefixes._whole_paths(iter(batches), most))
        assert np.concatenate([r["conv_id"] for r in runs]).tolist() == conv.tolist()
        assert all(r["depth"][0] == 0 for r in runs)
