import random

import numpy as np
import xxhash
from llm_fixtures import WORD, documents, empty, frame, prose

from tabwatch.llm import simhash


def print_of(text, k=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, ids, bits=3):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                parent[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(prints))]


def test_against_all_pairs(spark):
    docs = documents()
    prints = [print_of(d[1]) for d in docs]
    wanted = sorted(((d[0], f"{p:016x}", c) for d, p, c in zip(docs, prints, groups(prints, [d[0] for d in docs]))), key=str)
    rows = simhash.near_duplicates(frame(spark)).collect()
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows), key=str) == wanted
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_links_lose_no_pair(spark, monkeypatch):
    """Random and clustered fingerprints, also with keys cut into tiles."""
    from pyspark.sql import functions as F

    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(120)]
    for _ in range(260):
        near = rng.choice(prints)
        for _ in range(rng.randint(1, 3)):
            near ^= 1 << rng.randrange(64)
        prints.append(near)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "w0 long").withColumn("node", F.col("w0"))
    keyed = table.select("node", "w0", F.inline(simhash._keys(F.col("w0"), 3)))
    wanted = groups(prints, range(len(prints)))
    for tile in (4096, 8):
        monkeypatch.setattr(simhash, "TILE", tile)
        place = {p: k for k, p in enumerate(signed)}
        stars = {r["node"]: r["root"] for r in simhash.stars(simhash.links(keyed, 3)).collect()}
        roots = [place[stars.get(p, p)] for p in signed]
        assert len(set(roots)) == len(set(wanted))
        assert len({(a, b) for a, b in zip(roots, wanted)}) == len(set(wanted))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    rows = {r["node"]: r["root"] for r in simhash.stars(edges).collect()}
    assert rows == {**{k: 0 for k in range(1, 41)}, 101: 100}


def test_one_of_each_group(spark):
    """Of texts linked by fingerprints, as all pairs give them, the least id stays; of equal rows one."""
    rng = random.Random(9)
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(600)]
        rows.append((10 * k, " ".join(words)))
        if k % 2:
            words[-1] = "edit"
            rows.append((10 * k + 1, " ".join(words)))
        if k % 3 == 0:
            rows += [(10 * k + 2, rows[-1][1]), (10 * k + 2, rows[-1][1]), (None, rows[-1][1])]
    rows.append((None, "alone and without an id"))
    docs = frame(spark, [(i, t, "en", "a", 0, *["x"] * 9) for i, t in rows])
    prints = [print_of(t) for _, t in rows]
    least = groups(prints, [i for i, _ in rows])
    assert any(i is not None and g is not None and g < i for (i, _), g in zip(rows, least))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted({(i, t) for (i, t), g in zip(rows, least) if i == g}, key=str)
    odd = simhash.one_of_each(frame(spark))
    assert odd.where("text is null or trim(text) = ''").count() == 1  # texts without words are alike
    assert simhash.one_of_each(empty(spark)).count() == 0
