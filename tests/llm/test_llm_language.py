import zlib

import numpy as np
from llm_fixtures import documents, empty, frame, prose
import random

from tabwatch.llm import language


def training(spark, n=240):
    rng = random.Random(1)
    langs = ["en", "de", "fr"]
    return spark.createDataFrame([(k, prose(rng, langs[k % 3], 60), langs[k % 3]) for k in range(n)], "doc_id long, text string, lang string")


def test_costs_are_a_probability_distribution():
    rng = np.random.default_rng(0)
    text = bytes(rng.choice(list(b"abcd ef"), 4000).tolist())
    data = np.frombuffer(text, np.uint8)
    grams, n = np.unique(language.windows(data, np.array([0, len(data)])), return_counts=True)
    tree = language.ContextTree.fit(grams, n.astype(float))
    for context in (b"abc", b"a b", b"zzz", b"zab", b"\n\n\n", b"zza"):
        windows = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint32)
        assert abs(np.exp2(-tree.cost(windows)).sum() - 1) < 1e-9


def test_cost_follows_the_definition():
    """Escape method C with exclusion, byte by byte, from plain dictionaries."""
    text = b"abracadabra abracadabrab"
    padded = b"\n\n\n" + text
    counts = {}
    for i in range(3, len(padded)):
        for order in range(4):
            context = padded[i - order : i]
            counts.setdefault((order, context), {}).setdefault(padded[i], 0)
            counts[order, context][padded[i]] += 1

    def bits(window):
        excluded, total = set(), 0.0
        for order in range(3, -1, -1):
            seen = counts.get((order, window[3 - order : 3]))
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            size = sum(left.values()) + len(left)
            if window[3] in left:
                return total - np.log2(left[window[3]] / size)
            if left:
                total -= np.log2(len(left) / size)
            excluded |= set(seen)
        return total + np.log2(256 - len(excluded))

    data = np.frombuffer(text, np.uint8)
    grams, n = np.unique(language.windows(data, np.array([0, len(data)])), return_counts=True)
    tree = language.ContextTree.fit(grams, n.astype(float))
    for window in (b"abra", b"abrx", b"zabr", b"\n\nab", b"xyza", b"bra ", b"dabz"):
        assert abs(tree.cost(np.array([int.from_bytes(window, "big")], np.uint32))[0] - bits(window)) < 1e-9


def test_held_out_accuracy(spark):
    docs = training(spark)
    model = language.fit(docs.where(~language.held_out()))
    rows = language.identify(docs, model).join(docs, "doc_id").where(language.held_out()).collect()
    assert {zlib.crc32(str(r["doc_id"]).encode()) % 3 for r in rows} == {1}
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.95


def test_odd_rows(spark):
    docs = frame(spark)
    model = language.fit(training(spark))
    rows = language.identify(docs, model).collect()
    assert len(rows) == len(documents())
    by_id = {r["doc_id"]: r for r in rows}
    for k in (1000, 1001, 1002, 1004):  # null, empty, blank, digits
        assert (by_id[k]["lang_pred"], by_id[k]["score"], by_id[k]["bits_per_byte"]) == ("und", 0.0, None)
    assert all(0 < r["score"] <= 1 for r in rows if r["lang_pred"] != "und")
    assert language.identify(empty(spark), model).count() == 0
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns
    assert not {1000, 1001, 1002, 1004} & {r["doc_id"] for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    docs = frame(spark)
    model = language.fit(empty(spark))
    assert {r["lang_pred"] for r in language.identify(docs, model).collect()} == {"und"}


def test_every_label_is_learned(spark):
    """Seventy labels, one of which has long texts only, among many nulls."""
    rng = random.Random(2)
    words = {f"l{k:02}": ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(12)] for k in range(70)}
    rows = [(x, " ".join(rng.choices(words[x], k=40))) for x in words for _ in range(5) if x != "l69"]
    rows += [("l69", " ".join(rng.choices(words["l69"], k=12_000))) for _ in range(5)] + [("l69", None), ("l69", "")] * 900
    docs = spark.createDataFrame([(k, t, x) for k, (x, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.fit(docs, 5)
    assert model.languages == sorted(words)
    got = language.identify(docs.where("text <> ''"), model).join(docs, "doc_id").collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)
