"""Hard negatives by exact integer scores: Strassen products of anchor and candidate tiles, and mergeable heaps.

Anchors are the stated queries and meet all rows in blocks. A grid of (candidate part, anchor group) deals packed tiles
to tasks: each task multiplies its group's anchors with its part's candidates, one tile after the other, and keeps
heaps of constant size for each anchor, first of the positives, then, once these are known, of the rows in each
positive's window. Heaps of the parts are merged by window functions that keep as few rows. Nothing is collected.

Products are Strassen's on int64 with zero padding. Its sums wrap like integers modulo 2^64, so a score is exact
whenever it fits into 64 bits itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.session import stored

SCALE = 256
#: Scaled components are held to +-LIMIT, so that scores of up to 1024 components fit into 64 bits.
LIMIT = 1 << 26
POSITIVES, NEGATIVES = 5, 3
#: The window in per cent of the positive's score.
LOW, HIGH = 50, 95
#: Rows of a candidate tile, anchors of a tile, anchor tiles of a group, candidate tiles of a part.
TILE, ANCHORS, GROUP, PART = 2048, 256, 8, 16
#: Products of sides up to this are computed directly.
LEAF = 32
_LEAST = np.iinfo(np.int64).min
_TILE = pa.schema([("anchors", pa.bool_()), ("first", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("windows", pa.binary())])
_TILE_DDL = "anchors boolean, first long, ids binary, labels binary, vectors binary, windows binary"
_POSITIVE = "anchor long, copy long, positive_id long, positive_score long"
_NEGATIVE = "anchor long, copy long, positive_rank int, negative_id long, negative_score long"


def _even(x: np.ndarray) -> np.ndarray:
    return np.pad(x, [(0, s % 2) for s in x.shape]) if any(s % 2 for s in x.shape) else x


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices, by halves with seven products, down to LEAF; odd sides are padded with zeros."""
    if min(a.shape[0], a.shape[1], b.shape[1]) <= LEAF:
        return np.einsum("ik,kj->ij", a, b)  # numpy's matmul of integers is several times slower
    rows, columns = a.shape[0], b.shape[1]
    a, b = _even(a), _even(b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1, p2 = strassen(a11 + a22, b11 + b22), strassen(a21 + a22, b11)
    p3, p4 = strassen(a11, b12 - b22), strassen(a22, b21 - b11)
    p5, p6, p7 = strassen(a11 + a12, b22), strassen(a21 - a11, b11 + b12), strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n], out[:m, n:] = p1 + p4 - p5 + p7, p3 + p5
    out[m:, :n], out[m:, n:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:rows, :columns]


class Heaps:
    """The `most` first (score descending, id ascending) entries of each of n heaps."""

    def __init__(self, n: int, most: int):
        self.scores, self.ids = np.full((n, most), _LEAST), np.zeros((n, most), np.int64)

    def push(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores: one row for each heap, _LEAST where there is no entry; ids: of the columns, ascending."""
        most = self.scores.shape[1]
        lines = np.flatnonzero(scores.max(axis=1, initial=_LEAST) >= self.scores[:, -1])
        if not len(lines) or not scores.shape[1]:
            return
        rest = scores[lines]
        found, places = [], []
        for _ in range(most):  # the first greatest column is the one with the least id
            at = rest.argmax(axis=1)
            found.append(rest[np.arange(len(lines)), at])
            places.append(ids[at])
            rest[np.arange(len(lines)), at] = _LEAST
        self.merge(lines, np.stack(found, axis=1), np.stack(places, axis=1))

    def merge(self, lines: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        most = self.scores.shape[1]
        scores = np.concatenate([self.scores[lines], scores], axis=1)
        ids = np.concatenate([self.ids[lines], ids], axis=1)
        order = np.lexsort((ids, ~scores), axis=1)[:, :most]  # ~ turns the order of scores and cannot overflow
        self.scores[lines], self.ids[lines] = (np.take_along_axis(x, order, axis=1) for x in (scores, ids))

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(heap, id, score) of all entries."""
        heap, place = np.nonzero(self.scores > _LEAST)
        return heap, self.ids[heap, place], self.scores[heap, place]


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of lists, padded with zeros to the longest; a text without lists has no column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def _packed(anchors: bool, rows: int, windows: bool = False):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                ids = _column(part, "vec_id")
                order = np.argsort(ids, kind="stable")
                vectors = _matrix(part.column("vector"))[order]
                first = _column(part, "copy")[order] if anchors else np.zeros(0, np.int64)
                held = _matrix(part.column("scores"))[order] if windows else np.zeros((len(ids), 0), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip(
                        (anchors, len(ids), np.concatenate([ids[order], first]).tobytes(), _column(part, "label")[order].astype(np.int64).tobytes(),
                         vectors.tobytes(), held.tobytes()), _TILE, strict=True)], schema=_TILE)
    return run


class Tile:
    def __init__(self, row: dict):
        n = row["first"]
        ids = np.frombuffer(row["ids"], np.int64)
        self.ids, self.copies = ids[:n], ids[n:]
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.int64).reshape(n, -1)
        self.windows = np.frombuffer(row["windows"], np.int64).reshape(n, -1)

    def scores(self, other: Tile) -> np.ndarray:
        k = max(self.vectors.shape[1], other.vectors.shape[1])
        a, b = (np.pad(x, [(0, 0), (0, k - x.shape[1])]) for x in (self.vectors, other.vectors))
        return strassen(a, np.ascontiguousarray(b.T))


def _met(batches, start, push, finish):
    """Runs the heaps of each cell of the grid over its candidate tiles. Rows are sorted by cell, anchors first."""
    cell, anchors, heaps = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["part"], row["group"]) != cell:
                if cell is not None:
                    yield from finish(anchors, heaps)
                cell, anchors, heaps = (row["part"], row["group"]), [], []
            tile = Tile(row)
            if row["anchors"]:
                anchors.append(tile)
                heaps.append(start(tile))
            else:
                for anchor, heap in zip(anchors, heaps, strict=True):
                    push(anchor, heap, tile, anchor.scores(tile))
    if cell is not None:
        yield from finish(anchors, heaps)


def _positives(batches):
    def push(anchor: Tile, heap: Heaps, tile: Tile, scores: np.ndarray) -> None:
        fits = (anchor.labels[:, None] == tile.labels) & (anchor.ids[:, None] != tile.ids)
        heap.push(np.where(fits, scores, _LEAST), tile.ids)

    def finish(anchors, heaps):
        for anchor, heap in zip(anchors, heaps, strict=True):
            at, ids, scores = heap.entries()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (anchor.ids[at], anchor.copies[at], ids, scores)], names=["anchor", "copy", "positive_id", "positive_score"])

    return _met(batches, lambda tile: Heaps(len(tile.ids), POSITIVES), push, finish)


def bounds(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer score between LOW and HIGH per cent of a positive's, without overflow."""
    whole, rest = np.divmod(positive, 100)
    return whole * LOW - (-rest * LOW) // 100, whole * HIGH + rest * HIGH // 100


def _negatives(batches):
    def push(anchor: Tile, heaps: list[Heaps], tile: Tile, scores: np.ndarray) -> None:
        other = np.where(anchor.labels[:, None] != tile.labels, scores, _LEAST)
        for j, heap in enumerate(heaps):
            low, high = bounds(anchor.windows[:, j])
            there = (anchor.windows[:, j] > _LEAST)[:, None]
            heap.push(np.where(there & (other >= low[:, None]) & (other <= high[:, None]) & (other > _LEAST), other, _LEAST), tile.ids)

    def finish(anchors, held):
        for anchor, heaps in zip(anchors, held, strict=True):
            for j, heap in enumerate(heaps):
                at, ids, scores = heap.entries()
                rank = np.full(len(at), j + 1, np.int32)
                columns = [pa.array(c) for c in (anchor.ids[at], anchor.copies[at], rank, ids, scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "copy", "positive_rank", "negative_id", "negative_score"])

    return _met(batches, lambda tile: [Heaps(len(tile.ids), NEGATIVES) for _ in range(tile.windows.shape[1])], push, finish)


def _grid(anchors: DataFrame, candidates: DataFrame, n_anchors: int, n_candidates: int) -> DataFrame:
    """Tiles dealt to the cells (part, group), each with its anchors before its candidates."""
    groups = -(-n_anchors // (ANCHORS * GROUP)) or 1
    parts = -(-n_candidates // (TILE * PART)) or 1
    every = {"part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))}
    own = {"part": F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int"), "group": F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int")}
    tiles = anchors.withColumn("part", every["part"]).withColumn("group", own["group"])
    tiles = tiles.unionByName(candidates.withColumn("part", own["part"]).withColumn("group", every["group"]))
    return tiles.repartition(parts * groups, "part", "group").sortWithinPartitions("part", "group", F.desc("anchors"))


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vector (of long) of the rows that take part.

    Rows with a null id, label or vector, or with a null or non-finite component, do not. Components become
    floor(256 x), held to +-2^26; the label of each seventh vec_id is moved to (label + 1) % 10.
    """
    value = F.col("embedding")
    sound = F.expr("vec_id is not null and label is not null and embedding is not null and "
                   "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    scaled = F.transform(value, lambda x: F.floor(F.least(F.greatest(x.cast("double") * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("long"))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return vectors.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), scaled.alias("vector"))


def mine(rows: DataFrame, is_anchor: str = "vec_id % 50 = 0") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows of `prepared`.

    Positives: the anchor's first POSITIVES rows of its label under another vec_id. Negatives of a positive: the first
    NEGATIVES rows of other labels whose score is LOW to HIGH per cent of the positive's (none if that is negative).
    Higher scores come first, ties by smaller id. Rows that repeat a vec_id count each; an anchor repeated with the same
    label and vector gives its rows once, one repeated with others gives rows for each. Shorter vectors end in zeros.
    """
    candidates = stored(rows.mapInArrow(_packed(False, TILE), _TILE_DDL), "candidates")
    anchors = rows.where(is_anchor).distinct().withColumn("copy", F.xxhash64("label", "vector"))
    anchors = stored(anchors.select("vec_id", "label", "vector", "copy"), "anchors")
    sizes = candidates.agg(F.sum("first")).first()[0] or 0, anchors.count()
    tiles = anchors.mapInArrow(_packed(True, ANCHORS), _TILE_DDL)
    found = _grid(tiles, candidates, sizes[1], sizes[0]).mapInArrow(_positives, _POSITIVE)
    first = Window.partitionBy("anchor", "copy").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("positive_rank", F.row_number().over(first)).where(F.col("positive_rank") <= POSITIVES)
    positives = stored(found, "positives")

    held = positives.groupBy(F.col("anchor").alias("vec_id"), "copy").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("positive_rank", "positive_score"))), lambda s: s["positive_score"]).alias("scores")
    )  # at most POSITIVES scores, by rank
    most = F.array_repeat(F.lit(_LEAST).cast("long"), POSITIVES)
    held = held.withColumn("scores", F.slice(F.concat("scores", most), 1, POSITIVES))
    tiles = anchors.join(held, ["vec_id", "copy"]).mapInArrow(_packed(True, ANCHORS, windows=True), _TILE_DDL)
    found = _grid(tiles, candidates, sizes[1], sizes[0]).mapInArrow(_negatives, _NEGATIVE)
    first = Window.partitionBy("anchor", "copy", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES)
    return found.join(positives, ["anchor", "copy", "positive_rank"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score",
    )


SQL = """
WITH rows_ AS (
    SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM rows_ a JOIN rows_ b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s
  ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 3
"""
