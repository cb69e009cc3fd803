"""Quality classifier by supervised subword embeddings.

Words, pairs of neighbouring words (all pairs of a word with itself as one) and 4-grams of characters are hashed into
one table of learned vectors. A document is
the average of the vectors of all its grams, repeats included; a softmax layer on it gives the probability of each label.
Vectors and layer are learned together by stochastic gradient descent in numpy, one document a step. For scoring the
vectors are fixed-point integers, so the sums over a document are exact and no matter how its bytes are cut into pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.arrow import blocks, flat, record
from tabwatch.llm.hashing import Substrings, mix, word_spans

TABLE_BITS, DIMENSIONS, GRAM = 17, 16, 4
#: Labelled rows learned from, for each class, and characters of the passage that a longer one teaches by.
ROWS_PER_CLASS, PASSAGE = 1000, 16_384
EPOCHS, SEED = 6, 11
#: First steps for vectors (a gram's share of a document is small) and for the layer; they fall to zero.
VECTOR_STEP, LAYER_STEP = 40.0, 0.5
THRESHOLD = 0.3
#: Scoring: fractional bits of the vectors, and grams that are looked up at a time.
POINT, LOOKUP = 20, 1 << 17

#: One gram for every word that follows itself, whichever word.
_TWICE = mix(np.array([GRAM], np.uint64))[0]
_FEATURES = pa.schema([("label", pa.int32()), ("drawn", pa.int64()), ("slots", pa.binary()), ("shares", pa.binary())])
_FEATURES_DDL = "label int, drawn long, slots binary, shares binary"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])
DDL = "doc_id long, score double, predicted int"


def held_out(of: str = "doc_id") -> Column:
    """Documents that teach nothing; false for a null id, which no label names either."""
    return F.coalesce(F.crc32(F.col(of).cast("string")) % 5 == 0, F.lit(False))


def slots(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Table slots of all grams of a block of texts, text by text, and their offsets. Nulls count as empty."""
    data, offsets = flat(column)
    n = len(offsets) - 1
    hashes = Substrings(data)
    starts, ends, before = word_spans(data, offsets)
    word = hashes.of(starts, ends)
    owner = np.repeat(np.arange(n), np.diff(before))
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = mix(word[pair] * np.uint64(3) + mix(word[pair + 1]))
    pairs[word[pair] == word[pair + 1]] = _TWICE
    lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    letter = np.searchsorted(offsets, lead[:-1], side="right") - 1
    gram = np.flatnonzero(letter[GRAM - 1 :] == letter[: max(0, len(letter) - GRAM + 1)])
    grams = mix(hashes.of(lead[gram], lead[gram + GRAM]) + np.uint64(GRAM))
    where = np.concatenate([owner, owner[pair], letter[gram]])
    order = np.argsort(where, kind="stable")
    found = (np.concatenate([word, pairs, grams]) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)
    return found[order], np.append(0, np.cumsum(np.bincount(where, minlength=n)))


@dataclass
class Model:
    vectors: np.ndarray  # (1 << TABLE_BITS, DIMENSIONS) int32, POINT fractional bits
    layer: np.ndarray  # (DIMENSIONS, 2)
    bias: np.ndarray  # (2,)

    def documents(self, found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Average vector of each text; zeros for a text without grams."""
        sums = np.zeros((len(offsets) - 1, DIMENSIONS), np.int64)
        for start in range(0, len(found), LOOKUP):
            end = min(start + LOOKUP, len(found))
            first = int(np.searchsorted(offsets, start, side="right")) - 1
            last = int(np.searchsorted(offsets, end, side="left"))
            texts = np.arange(first, last)[np.diff(np.clip(offsets[first : last + 1], start, end)) > 0]
            cuts = np.maximum(offsets[texts], start) - start
            sums[texts] += np.add.reduceat(self.vectors[found[start:end]], cuts, axis=0, dtype=np.int64)
        return sums / (np.maximum(np.diff(offsets), 1) * float(1 << POINT))[:, None]

    def probability(self, averages: np.ndarray) -> np.ndarray:
        """Softmax probability of label 1."""
        scores = averages @ self.layer + self.bias
        return 1 / (1 + np.exp(np.clip(scores[:, 0] - scores[:, 1], -500, 500)))


def _features(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            found, n = np.unique(slots(one.column("text"))[0], return_counts=True)
            shares = (n / max(1, n.sum())).astype(np.float32)
            yield record(_FEATURES, label=one.column("label"), drawn=one.column("drawn"), slots=[found.tobytes()], shares=[shares.tobytes()])


def descend(rows: list[tuple[int, np.ndarray, np.ndarray]], weights: tuple[float, float], epochs: int = EPOCHS) -> Model:
    """Stochastic gradient descent on rows of (label, distinct slots, their shares of the document)."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << TABLE_BITS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    step, steps = 0, max(1, epochs * len(rows))
    for _ in range(epochs):
        for at in rng.permutation(len(rows)):
            label, found, shares = rows[at]
            rate = 1 - step / steps
            step += 1
            own = vectors[found]
            average = shares @ own
            scores = average @ layer + bias
            miss = np.exp(scores - scores.max())
            miss = miss / miss.sum()
            miss[label] -= 1
            miss *= weights[label]
            vectors[found] = own - np.outer(shares, (VECTOR_STEP * rate) * (layer @ miss)).astype(np.float32)
            layer -= LAYER_STEP * rate * np.outer(average, miss)
            bias -= LAYER_STEP * rate * miss
    fixed = np.clip(np.round(vectors.astype(np.float64) * (1 << POINT)), -(1 << 30), 1 << 30).astype(np.int32)
    return Model(fixed, layer, bias)


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, label_col: str = "quality") -> Model:
    """Learns from `labels` (doc_id and a 0/1 label, others are ignored) and the texts of `docs` (doc_id, text).

    The sample is the `rows_per_class` rows of each class that come first by a hash of doc_id; of a text longer than
    PASSAGE characters it takes a passage, placed by that hash. Classes weigh as in all labels. Repeated rows teach as
    often as they occur. Without labels the probability is 0.5 everywhere; with a single class, all bias.
    """
    labels = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where("label in (0, 1) and doc_id is not null")
    shares = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    hashed = labels.withColumn("drawn", F.xxhash64("doc_id", F.lit("subwords")))
    first = [hashed.where(F.col("label") == k).orderBy("drawn", "doc_id").limit(rows_per_class) for k in (0, 1)]
    sample = first[0].union(first[1])  # at most 2 * rows_per_class rows
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    room = F.greatest(F.length("text") - PASSAGE, F.lit(0)) + 1
    passage = F.substring(F.col("text"), (F.pmod("drawn", room) + 1).cast("int"), F.lit(PASSAGE))
    rows = chosen.select("label", "drawn", passage.alias("text")).mapInArrow(_features, _FEATURES_DDL).collect()
    rows.sort(key=lambda r: (r["drawn"], r["label"], r["slots"], r["shares"]))
    taught = [(r["label"], np.frombuffer(r["slots"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in rows]
    n = [max(1, sum(r[0] == k for r in taught)) for k in (0, 1)]
    total = max(1, sum(shares.values()))
    return descend(taught, tuple(shares.get(k, 0) / total * len(taught) / n[k] for k in (0, 1)))


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (probability of label 1), predicted (1 from THRESHOLD on) of every whole text.

    A null or empty text is scored by the bias alone. Repeated rows give repeated results; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size: the table's

    def run(batches):
        for batch in batches:
            for block in blocks(batch, "text", 1_000_000):
                score = shared.value.probability(shared.value.documents(*slots(block.column("text"))))
                yield record(_SCHEMA, doc_id=block.column("doc_id"), score=score, predicted=(score >= THRESHOLD).astype(np.int32))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, DDL)
