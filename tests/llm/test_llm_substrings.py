import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from llm_fixtures import documents, empty, frame

from tabwatch.llm import substrings
from tabwatch.llm.suffix import common_prefixes, suffix_array


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(120):
        n, letters = int(rng.integers(0, 90)), int(rng.integers(1, 4))
        for kind in (np.uint8, np.int64):
            codes = rng.integers(0, letters, n).astype(kind)
            array = suffix_array(codes)
            suffixes = [tuple(codes[i:].tolist()) for i in array]
            assert suffixes == sorted(suffixes) and sorted(array.tolist()) == list(range(n))
            for depth in (1, 5, 50):
                found = common_prefixes(codes, array, depth)
                for k in range(1, n):
                    shared = 0
                    while shared < min(depth, len(suffixes[k]), len(suffixes[k - 1])) and suffixes[k][shared] == suffixes[k - 1][shared]:
                        shared += 1
                    assert found[k] == shared


def removed(rows):
    """rows: (doc_id, bytes). What the definition removes, as bytes -> results per row."""
    first = {}
    for doc, text in rows:
        for i in range(len(text) - 49):
            s = text[i : i + 50]
            first[s] = min(first.get(s, doc), doc)
    out = []
    for doc, text in rows:
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - 49):
            if first[text[i : i + 50]] < doc:
                gone[i : i + 50] = True
        gone = gone[: len(text)]
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int(np.sum(gone[1:] & ~gone[:-1]) + (gone[0] if len(gone) else 0))
        out.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compare(spark, rows, **options):
    got = substrings.remove_repeats(frame(spark, rows), **options).collect()
    least = -(1 << 63)
    known = [(r[0] if r[0] is not None else least, (r[1] or "").encode()) for r in rows]
    wanted = sorted((doc, *w) for (doc, _), w in zip(known, removed(known)))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else least, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == wanted
    assert any(w[2] for w in wanted)


def test_against_definition(spark):
    compare(spark, [r for r in documents() if r[1] is None or len(r[1]) < 5000])


def test_shards_are_merged(spark):
    """Shards of a few strings: the answer comes from the binary search across them."""
    compare(spark, [r for r in documents(60, 8) if r[1] is None or len(r[1]) < 5000], shard_bytes=300)


def test_repeated_strings_across_shards():
    rng = random.Random(4)
    base = bytes(rng.choice(b"ab") for _ in range(300))
    texts = [base[a : a + 80] for a in (0, 10, 40, 0, 200, 150, 33)]
    data, lengths = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    docs = np.array([5, 3, 4, 9, 1, 1, 7])
    whole = substrings.repeated_strings(data, lengths, docs)
    assert whole.tolist() == sorted(substrings.repeated_strings(data, lengths, docs, 100).tolist())


def test_crowded_anchors_and_long_texts(spark, monkeypatch):
    """Very many pieces around one passage, and texts read in several stretches."""
    monkeypatch.setattr(substrings, "CROWD", 2)
    monkeypatch.setattr(substrings, "_STRETCH", 700)
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = [(k, noise(30) + passage + noise(rng.randint(0, 2500)), "en", "a", 0, *["x"] * 9) for k in range(25)]
    compare(spark, rows)


def test_empty(spark):
    assert substrings.remove_repeats(empty(spark)).count() == 0


def dealt(batches):
    """All parcels as one task gets them, in batches of a few."""
    table = pa.Table.from_batches(batches, substrings.PARCEL).sort_by([("bucket", "ascending"), ("kind", "descending")])
    return table.to_batches(max_chunksize=8)


def peak(run, batches):
    """What a task returns, and the bytes it held beside its input at most, less the output it had given."""
    out, most, given = [], 0, 0
    tracemalloc.start()
    for batch in run(iter(batches)):
        most = max(most, tracemalloc.get_traced_memory()[1] - given)
        out.append(batch)
        given = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
    most = max(most, tracemalloc.get_traced_memory()[1] - given)
    tracemalloc.stop()
    return out, most


def texts_of(seed, n):
    """Passages of a few hundred bytes that several documents share, with other text around them."""
    rng = np.random.default_rng(seed)
    common = [rng.integers(97, 123, 300).astype(np.uint8).tobytes() for _ in range(n // 4)]
    noise = lambda: rng.integers(97, 123, int(rng.integers(20, 60))).astype(np.uint8).tobytes()
    return [(k, (noise() + common[int(rng.integers(len(common)))] + noise()).decode()) for k in range(n)]


def as_batch(rows):
    ids = [k for k, _ in rows]
    return pa.RecordBatch.from_pydict({
        "rank": pa.array(ids, pa.int64()), "null_id": [False] * len(rows), "row": pa.array([k * 7919 for k in ids], pa.int64()), "text": [t for _, t in rows],
    })


def test_a_task_holds_a_bucket_and_not_its_share(monkeypatch):
    """One task gets all parcels of a table, and of one eight times as large: what it holds stays about the same."""
    for name, value in (("_GATHERED", 40_000), ("_RECORDS", 40_000), ("_HELD", 40_000), ("_STRETCH", 20_000)):
        monkeypatch.setattr(substrings, name, value)
    held = {}
    for n in (400, 3200):
        rows, anchors, by_row = texts_of(3, n), n, n // 8  # buckets of the same size
        cut = list(substrings._cut(anchors, by_row)(iter([as_batch(rows)])))
        texts = [b for a in range(0, n, 100) for b in substrings._texts(by_row)(iter([as_batch(rows[a : a + 100])]))]
        compared, in_compare = peak(substrings._compare(by_row), dealt(cut))
        fetch = [b.filter(pa.compute.equal(b["kind"], substrings.FETCH)) for b in compared]
        strings, in_extract = peak(substrings._extract(anchors), dealt([*fetch, *texts]))
        searched, in_search = peak(substrings._search(by_row, 20_000), dealt(strings))
        gone = [b.filter(pa.compute.equal(b["kind"], substrings.REMOVED)) for b in [*compared, *searched]]
        finished, in_finish = peak(substrings._finish(False), dealt([*gone, *texts]))
        wanted = removed([(k, t.encode()) for k, t in rows])
        got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for b in finished for r in b.to_pylist())
        assert got == [(k, *w) for k, w in enumerate(wanted)]
        held[n] = in_compare, in_extract, in_search, in_finish
    assert all(large < 2 * small for small, large in zip(held[400], held[3200], strict=True)), held


def test_copies_in_rows_of_one_document(spark):
    """Rows of one id with the same text, and null ids, beside a smaller document with parts of them."""
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = [(1, text[90:250]), *[(5, text)] * 3, (5, text[60:]), *[(None, text[300:])] * 2, (7, text[:150] + "x" + text[150:])]
    compare(spark, [(*r, "en", "a", 0, *["x"] * 9) for r in rows], shard_bytes=200)
