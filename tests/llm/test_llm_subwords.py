import random
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_fixtures import WORD, documents, empty, frame, prose

from tabwatch.llm import subwords
from tabwatch.llm.hashing import Substrings

SHIFT = np.uint64(64 - subwords.TABLE_BITS)


def one(data: bytes):
    array = np.frombuffer(data, np.uint8)
    return Substrings(array).of(np.array([0]), np.array([len(data)]))


def grams(text):
    """Slots of a text's grams, one by one."""
    text = text or ""
    words = [one(w.encode()) for w in WORD.findall(text)]
    out = [w for w in words]
    out += [np.array([subwords._TWICE]) if a == b else subwords.mix(a * np.uint64(3) + subwords.mix(b)) for a, b in zip(words, words[1:])]
    out += [subwords.mix(one(text[i : i + 4].encode()) + np.uint64(4)) for i in range(len(text) - 3)]
    return Counter(int(x[0] >> SHIFT) for x in out)


def test_grams_of_words_and_characters():
    texts = ["one two two three", None, "", "日本語 wörld é", "abc", "x" * 10, " \n "]
    slots, offsets = subwords.slots(pa.array(texts))
    assert [Counter(slots[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])] == [grams(t) for t in texts]


def model(seed=1):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-1 << 22, 1 << 22, (1 << subwords.TABLE_BITS, subwords.DIMENSIONS)).astype(np.int32)
    return subwords.Model(vectors, rng.normal(size=(subwords.DIMENSIONS, 2)), rng.normal(size=2))


def test_scores_equal_plain_averages(spark, monkeypatch):
    monkeypatch.setattr(subwords, "LOOKUP", 1000)  # texts are cut and sums go on
    m = model()
    docs = [d for d in documents(40) if len(d[1] or "") < 5000]
    rows = subwords.judge(frame(spark, docs), m).collect()
    want = []
    for d in docs:
        counts = grams(d[1])
        n = sum(counts.values())
        total = sum((m.vectors[s].astype(object) * c for s, c in counts.items()), np.zeros(subwords.DIMENSIONS, object))
        average = np.array([int(t) for t in total]) / (max(1, n) * float(1 << subwords.POINT))
        e = np.exp(average @ m.layer + m.bias)
        want.append((d[0], e[1] / e.sum()))
    got = sorted(((r["doc_id"], r["score"]) for r in rows), key=str)
    want.sort(key=str)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want])
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert subwords.judge(empty(spark), m).count() == 0


def test_cuts_do_not_change_scores(monkeypatch):
    m, texts = model(), [prose(random.Random(3), "en", 900), "", "a few words", None, prose(random.Random(4), "de", 400)]
    slots, offsets = subwords.slots(pa.array(texts))
    whole = m.documents(slots, offsets)
    for most in (1, 77, 5000):
        monkeypatch.setattr(subwords, "LOOKUP", most)
        assert (m.documents(slots, offsets) == whole).all()


def test_learns_from_labels_that_are_not_held_out(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(400):
        good = k % 4 > 0
        text = prose(rng, "en", 80)
        text = text if good else rng.choice([" ".join(w + "***" for w in text.split()), text.upper(), " ".join([text.split()[0]] * 80)])
        rows.append((k, text, "en", "a", 0, *["x"] * 9))
        labels.append((k, int(good) if k % 50 else None, 0))
    labels += [(None, 1, 0), (10_000, 0, 0), (7, 1, 0), (7, 1, 0)]
    docs = frame(spark, rows)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    taught = subwords.fit(docs, marked.where(~subwords.held_out()))
    # labels of held-out rows teach nothing
    flipped = marked.selectExpr("doc_id", "if(crc32(string(doc_id)) % 5 = 0, 1 - quality, quality) quality", "toxic")
    again = subwords.fit(docs, flipped.where(~subwords.held_out()))
    assert (taught.vectors == again.vectors).all() and (taught.layer == again.layer).all()
    out = subwords.judge(docs, taught).withColumn("held", subwords.held_out()).collect()
    right = [r["predicted"] == int(r["doc_id"] % 4 > 0) for r in out if r["held"]]
    assert len(right) > 40 and np.mean(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


def test_without_labels_or_with_one_class(spark):
    docs = frame(spark)
    none = subwords.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in subwords.judge(docs, none).collect()} == {0.5}
    one_class = subwords.fit(docs, spark.createDataFrame([(3 * k, 1) for k in range(60)], "doc_id long, quality int"))
    assert all(r["score"] > 0.5 for r in subwords.judge(docs, one_class).collect())
