import random
from collections import Counter

import numpy as np
from llm_fixtures import WORD, documents, empty, frame, prose

from tabwatch.llm import quality


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    out = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return (*out, out[0] < 50 or 100 * out[4] > 50 * out[0])


def test_counts(spark):
    model = quality.Model(np.zeros(1 << quality.TABLE_BITS), 0.0, 1.0, 0.0)
    docs = documents() + [(7000, "a b c a b c\nx | <y>\n\nx | <y>\n z", "en", "a", 1, *["x"] * 9)]
    rows = quality.judge(frame(spark, docs), model).collect()
    got = [(r["doc_id"], *(r[c] for c in quality._COUNTS), r["base_failed"]) for r in rows]
    assert sorted(got, key=str) == sorted(((d[0], *counts(d[1])) for d in docs), key=str)
    assert all(r["kept"] == (not r["base_failed"]) for r in rows)
    assert quality.judge(empty(spark), model).count() == 0


def test_learns_from_labels(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(300):
        good = k % 4 > 0
        text = prose(rng, "en", 80) if good else " ".join(w + rng.choice(["***", "$$$", "|"]) for w in prose(rng, "en", 80).split())
        rows.append((k, text, "en", "a", 0, *["x"] * 9))
        if k < 200:
            labels.append((k, int(good) if k % 50 else None, 0))
    docs = frame(spark, rows)
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r["probability"] for r in quality.judge(docs, model).collect()}
    right = [(got[k] >= 0.5) == (k % 4 > 0) for k in range(200, 300)]
    assert np.mean(right) > 0.95 and all(0 <= p <= 1 for p in got.values())


def test_no_labels(spark):
    model = quality.fit(frame(spark), spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["probability"] for r in quality.judge(frame(spark), model).collect()} == {0.5}
