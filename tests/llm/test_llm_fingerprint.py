import hashlib

import numpy as np
from llm_fixtures import documents, empty, frame

from tabwatch.llm import fingerprint


def test_signature_follows_the_definition():
    """The two least occurrence-numbered k-mers of each function, in text order, from plain loops."""
    text = ("abracadabra " * 9 + "xyz").encode()
    kmers = fingerprint._kmers(text)
    values = fingerprint._numbered(kmers)
    assert len(set(values.tolist())) == len(values)  # repeated k-mers are told apart
    slots = fingerprint.signature(text)
    for j in range(fingerprint.FUNCTIONS):
        hashed = [int((np.uint32(v) ^ fingerprint._XOR[j, 0]) * fingerprint._TIMES[j, 0]) for v in values]
        chosen = sorted(sorted(range(len(hashed)), key=lambda i: hashed[i])[:2])
        slot = np.zeros(1, np.uint64)
        for i in chosen:
            slot = fingerprint.mix(slot * np.uint64(3) + kmers[i])
        assert int(slot[0] >> np.uint64(48)) == slots[j]


def test_likeness_falls_with_edits_and_order():
    rng = np.random.default_rng(1)
    words = [bytes(rng.choice(list(b"abcdefghij"), 6).tolist()) for _ in range(400)]
    text = b" ".join(words)
    one = words.copy()
    one[200] = b"changed"
    half = words[:200] + [bytes(rng.choice(list(b"klmnop"), 6).tolist()) for _ in range(200)]
    swapped = words[200:] + words[:200]
    base = fingerprint.signature(text)
    near, middle, moved = (fingerprint.likeness(base, fingerprint.signature(b" ".join(w))) for w in (one, half, swapped))
    assert near > 0.8 and 0 < middle < 0.5 and moved < 0.9 and fingerprint.likeness(base, base) == 1


def expected(rows):
    order = sorted(((i if i is not None else -(1 << 63), t or "", i) for i, t in rows), key=lambda r: (-r[0], r[1]))
    out = []
    for k, (_, text, i) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        out.append((i, len(text), hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_edited_texts(spark):
    # nulls sort before empty texts, which are the same here
    docs = [(d[0], d[1]) for d in documents() if d[1] is not None or d[0] is not None]
    rows = fingerprint.edited_likeness(frame(spark, [d for d in documents() if d[1] is not None or d[0] is not None])).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=str) == expected(docs)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    by_text = {}
    texts = dict(docs)
    for r in rows:
        if r["doc_id"] is not None:
            assert by_text.setdefault(texts[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"]


def test_one_and_none(spark):
    one = fingerprint.edited_likeness(frame(spark, documents()[:1])).collect()
    text = documents()[0][1]
    cut = len(text) // 3
    assert [r["edited_sha256"] for r in one] == [hashlib.sha256((text[: len(text) - cut] + text[:cut]).encode()).hexdigest()]
    assert fingerprint.edited_likeness(empty(spark)).count() == 0
    assert fingerprint.fingerprints(frame(spark)).count() == len(documents())
