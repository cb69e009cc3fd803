"""Quality rules: counts over words and lines, and a calibrated linear model on hashed n-grams.

The model is a logistic regression on the mean weight of a text's word unigrams and bigrams and of its
4-byte grams, all hashed into one table. It learns from a bounded sample of labelled rows, balanced by
class; held-out rows then calibrate its output to the label shares of the whole table. Texts are scored
in Arrow batches, each with a few passes over its bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.arrow import blocks, flat, record
from tabwatch.llm.hashing import Substrings, line_spans, mix, segment_sums, word_spans

TABLE_BITS = 18
#: Fixed limits: fewest words, most words in repeated windows (per cent), lowest probability that is kept.
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_PROBABILITY = 50, 50, 0.5
#: Labelled rows learned from, for each class; one in four calibrates.
ROWS_PER_CLASS = 1000
SYMBOLS = b"#*$%&|<>"
SCALE = 100.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = pa.schema(
    [("doc_id", pa.int64())] + [(c, pa.int64()) for c in _COUNTS]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("probability", pa.float64())]
)
DDL = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", base_failed boolean, kept boolean, probability double"
_FEATURES = pa.schema([("label", pa.int32()), ("held", pa.bool_()), ("slot", pa.binary()), ("value", pa.binary())])


def _repeats(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether its owner has it twice or more, and whether its owner has had it before."""
    salted = mix(keys ^ mix(owner.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(salted, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = salted[order][1:] == salted[order][:-1]
    again, before = np.empty(len(keys), bool), np.empty(len(keys), bool)
    again[order], before[order] = same[1:] | same[:-1], same[:-1]
    return again, before


class Texts:
    """A block's bytes with its words and their hashes."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = flat(column)
        self.n = len(self.offsets) - 1
        self.hashes = Substrings(self.data)
        self.starts, self.ends, self.words = word_spans(self.data, self.offsets)
        self.word = self.hashes.of(self.starts, self.ends)
        self.owner = np.repeat(np.arange(self.n), np.diff(self.words))

    def counts(self) -> dict[str, np.ndarray]:
        data, offsets, owner = self.data, self.offsets, self.owner
        continued = segment_sums((data & 0xC0) == 0x80, offsets)
        repeat = np.zeros(len(self.word) + 1, np.int64)
        if len(self.word) > 2:
            w = self.word
            inside = np.flatnonzero(owner[2:] == owner[:-2])
            keys = mix(w[inside] + mix(w[inside + 1] + mix(w[inside + 2])))
            again = inside[_repeats(keys, owner[inside])[0]]
            np.add.at(repeat, again, 1)
            np.add.at(repeat, again + 3, -1)
        line_starts, line_ends, line_owner = line_spans(data, offsets, self.starts)
        earlier = _repeats(self.hashes.of(line_starts, line_ends), line_owner)[1]
        return {
            "n_words": np.diff(self.words),
            "word_chars": segment_sums(self.ends - self.starts, self.words) - continued,
            "n_symbols": segment_sums(_SYMBOL[data], offsets),
            "n_dup_lines": np.bincount(line_owner[earlier], minlength=self.n),
            "n_repeat_words": segment_sums(np.cumsum(repeat[:-1]) > 0, self.words),
        }

    def slots(self):
        """Table slots of word grams and byte grams, each with the offsets of the texts."""
        shift = np.uint64(64 - TABLE_BITS)
        w = self.word
        # a text's last word has no bigram: it counts as one with nothing
        follow = np.append(w[1:], 0).astype(np.uint64)
        follow[self.words[1:][np.diff(self.words) > 0] - 1] = 0
        words = np.stack([mix(w) >> shift, mix(w * np.uint64(3) + mix(follow)) >> shift], axis=1).ravel()
        gram = np.zeros(max(0, len(self.data) - 3), np.uint32)
        for k in range(4):
            gram = (gram << np.uint32(8)) | self.data[k : k + len(gram)]
        lengths = np.maximum(np.diff(self.offsets) - 3, 0)
        places = np.arange(lengths.sum()) + np.repeat(self.offsets[:-1] - np.append(0, np.cumsum(lengths)[:-1]), lengths)
        chars = (gram[places] * np.uint32(2654435769)) >> np.uint32(32 - TABLE_BITS)
        return (words.astype(np.int32), self.words * 2), (chars.astype(np.int32), np.append(0, np.cumsum(lengths)))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float  # calibration of the linear score
    shift: float

    def probability(self, texts: Texts) -> np.ndarray:
        score = np.full(texts.n, self.bias)
        for slots, offsets in texts.slots():
            score += SCALE * segment_sums(self.weights[slots], offsets) / np.maximum(np.diff(offsets), 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -500, 500)))


def _features(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            parts = []
            for slots, offsets in Texts(one.column("text")).slots():
                found, n = np.unique(slots, return_counts=True)
                parts.append((found, SCALE * n / max(1, offsets[-1])))
            slots, values = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            yield record(
                _FEATURES, label=one.column("label"), held=one.column("held"),
                slot=[slots.astype(np.int32).tobytes()], value=[values.astype(np.float32).tobytes()],
            )


def _descend(rows: list, labels: np.ndarray, steps: int = 120) -> tuple[np.ndarray, float]:
    """Logistic loss with a small penalty, by Adam on all rows; only slots that occur get a weight."""
    slots = np.concatenate([np.frombuffer(r["slot"], np.int32) for r in rows])
    values = np.concatenate([np.frombuffer(r["value"], np.float32) for r in rows])
    used, slots = np.unique(slots, return_inverse=True)
    offsets = np.append(0, np.cumsum([len(r["slot"]) // 4 for r in rows]))
    owner = np.repeat(np.arange(len(rows)), np.diff(offsets))
    w, first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, steps + 1):
        score = segment_sums(values * w[slots], offsets) + w[-1]
        miss = (1 / (1 + np.exp(-np.clip(score, -500, 500))) - labels) / len(rows)
        grad = np.append(np.bincount(slots, values * miss[owner], len(used)), miss.sum()) + 1e-5 * w
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        w -= 0.02 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)
    weights = np.zeros(1 << TABLE_BITS)
    weights[used] = w[:-1]
    return weights, float(w[-1])


def _calibrate(scores: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Platt scaling by Newton steps, with rows weighted to the share of good rows in the whole table."""
    if not 0 < labels.mean() < 1:
        return 1.0, 0.0
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    target = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    x = np.stack([scores, np.ones(len(scores))], axis=1)
    ab = np.array([0.0, np.log(share / (1 - share))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -500, 500)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (p - target)) + 1e-3 * np.array([ab[0], 0.0]))
        ab -= np.clip(step, -2, 2)
    return float(ab[0]), float(ab[1])


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, label_col: str = "quality") -> Model:
    """Learns from `labels` (doc_id and a 0/1 label) and the texts of `docs` (doc_id, text).

    The sample has the `rows_per_class` rows of each class that come first by a hash of doc_id. Without
    labels, or with a single class, every text is as good as another and has probability 0.5 or above.
    """
    labels = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where("label in (0, 1) and doc_id is not null")
    shares = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    hashed = labels.withColumn("drawn", F.xxhash64("doc_id", F.lit("quality")))
    first = [hashed.where(F.col("label") == k).orderBy("drawn", "doc_id").limit(rows_per_class) for k in (0, 1)]
    sample = first[0].union(first[1]).select("doc_id", "label", (F.pmod("drawn", F.lit(4)) == 3).alias("held"))
    # at most 2 * rows_per_class rows are broadcast
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("label", "held", "text")
    rows = chosen.mapInArrow(_features, "label int, held boolean, slot binary, value binary").collect()
    rows.sort(key=lambda r: (r["label"], r["slot"], r["value"]))
    train = [r for r in rows if not r["held"]]
    y = np.array([r["label"] for r in train], float)
    if not len(y) or not 0 < y.mean() < 1:
        return Model(np.zeros(1 << TABLE_BITS), 0.0, 1.0, 0.0)
    weights, bias = _descend(train, y)
    held = [r for r in rows if r["held"]]
    scores = np.array([weights[np.frombuffer(r["slot"], np.int32)] @ np.frombuffer(r["value"], np.float32) + bias for r in held])
    share = shares[1] / (shares[0] + shares[1])
    slope, shift = _calibrate(scores, np.array([r["label"] for r in held], float), share) if held else (1.0, 0.0)
    return Model(weights, bias, slope, shift)


def judge(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict for every whole text: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, probability.

    A null or empty text has no words and fails. Repeated rows give repeated results; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for block in blocks(batch, "text", 1_000_000):
                texts = Texts(block.column("text"))
                counts, probability = texts.counts(), shared.value.probability(texts)
                failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
                yield record(
                    _SCHEMA, doc_id=block.column("doc_id"), **counts, base_failed=failed,
                    kept=~failed & (probability >= MIN_PROBABILITY), probability=probability,
                )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, DDL)
