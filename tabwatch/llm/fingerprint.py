"""Document fingerprints by order MinHash.

For each of FUNCTIONS hash functions the TUPLE smallest k-mers of a text are selected, where equal k-mers
are told apart by their occurrence number; the selected k-mers are put back into text order and hashed
together. Two texts agree in a slot if they select the same k-mers in the same order, so their share of
equal slots falls with their edit distance, also when an edit only moves text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.arrow import blocks, record
from tabwatch.llm.hashing import mix

KMER, TUPLE, FUNCTIONS = 10, 2, 64
#: k-mers worked on at a time, so that the values of all functions stay in cache.
_STRIDE = 4096
_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 1 << 32, (FUNCTIONS, 1), np.uint32)
_TIMES = _rng.integers(0, 1 << 31, (FUNCTIONS, 1), np.uint32) * np.uint32(2) + np.uint32(1)
_ROWS = np.arange(FUNCTIONS)
_WORST = np.uint32(0xFFFFFFFF)


def _kmers(text: bytes) -> np.ndarray:
    """64-bit hashes of all k-mers; a shorter text is one k-mer."""
    if len(text) < KMER:
        text = text + bytes(KMER - 1 - len(text)) + bytes([len(text)])
    n = len(text) - KMER + 1
    first = np.empty(len(text), np.uint64)
    for shift in range(8):
        part = np.frombuffer(text, "<u8", (len(text) - shift) // 8, shift)
        first[shift::8][: len(part)] = part
    return mix(first[:n] + mix(first[KMER - 8 : KMER - 8 + n] * np.uint64(0x9E3779B97F4A7C15)))


def _numbered(kmers: np.ndarray) -> np.ndarray:
    """32-bit values of the k-mers, other ones for the second and later occurrences of a k-mer."""
    values = (kmers >> np.uint64(32)).astype(np.uint32)
    ordered = np.sort((values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64))
    high = ordered >> np.uint64(32)
    fresh = np.append(True, high[1:] != high[:-1])
    if not fresh.all():
        at = np.arange(len(values))
        occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0))
        later = occurrence > 0
        places = (ordered[later] & np.uint64(_WORST)).astype(np.int64)
        values[places] = (mix(high[later] + occurrence[later].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)
    return values


def signature(text: bytes) -> np.ndarray:
    """FUNCTIONS 16-bit slots."""
    if not text:
        return np.zeros(FUNCTIONS, np.uint16)
    kmers = _kmers(text)
    values = _numbered(kmers)
    least = np.full((FUNCTIONS, TUPLE), _WORST)
    place = np.full((FUNCTIONS, TUPLE), -1, np.int64)
    for start in range(0, len(values), _STRIDE):
        hashed = (values[start : start + _STRIDE] ^ _XOR) * _TIMES
        for _ in range(min(TUPLE, hashed.shape[1])):
            at = hashed.argmin(axis=1)
            now = hashed[_ROWS, at]
            hashed[_ROWS, at] = _WORST
            worst = least.argmax(axis=1)
            better = (now < least[_ROWS, worst]) | (place[_ROWS, worst] < 0)
            least[_ROWS[better], worst[better]] = now[better]
            place[_ROWS[better], worst[better]] = (at + start)[better]
    place.sort(axis=1)
    slots = np.zeros(FUNCTIONS, np.uint64)
    for k in range(TUPLE):
        slots = mix(slots * np.uint64(3) + np.where(place[:, k] >= 0, kmers[place[:, k]], np.uint64(1)))
    return (slots >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


_FINGERPRINT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])
_EDITED = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_EDITED_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _hex(slots: np.ndarray) -> str:
    return slots.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars (code points) and fingerprint (hex) of every whole text; null counts as empty."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch, "text"):
                texts = [t or "" for t in block.column("text").to_pylist()]
                yield record(
                    _FINGERPRINT, doc_id=block.column("doc_id"), n_chars=[len(t) for t in texts],
                    fingerprint=[_hex(signature(t.encode())) for t in texts],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string"
    )


def _edit(batches):
    """Rows come in order; each is settled when the next one is known. Rows marked `tail` only serve as next ones."""
    held, out = None, []

    def settle(after: str, after_slots: np.ndarray):
        doc, text, slots = held
        cut = len(text) // 3
        edited = (text[: len(text) - cut] + after[:cut]).encode()
        edited_slots = signature(edited) if cut else slots
        out.append(
            (doc, len(text), hashlib.sha256(edited).hexdigest(), _hex(slots), _hex(edited_slots),
             likeness(slots, edited_slots), likeness(slots, after_slots))
        )

    for batch in batches:
        for block in blocks(batch, "text"):
            columns = (block.column(c).to_pylist() for c in ("doc_id", "text", "tail"))
            for doc, text, tail in zip(*columns, strict=True):
                if tail and held is None:
                    continue
                text = text or ""
                slots = signature(text.encode())
                if held is not None:
                    settle(text, slots)
                held = None if tail else (doc, text, slots)
            if out:
                rows, out = out, []
                yield record(_EDITED, **dict(zip(_EDITED.names, zip(*rows, strict=True), strict=True)))


def _search(bounds: list[int], value: Column) -> Column:
    """How many of the descending bounds are not below the value, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when((at + step <= len(bounds)) & (F.get(array, at + step - 1) >= value), at + step).otherwise(at),
    )


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text ends in the beginning of the next document by descending doc_id (the last one's next is
    the first) in place of its last third. Null texts count as empty, null ids come last, rows with equal ids
    follow each other by text. Rows are dealt once, by ranges of ids; the first document of a range is also
    sent to the range before it. Per range, one bound and one id pass through the driver.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    shares = [(k + 1) / n for k in range(n - 1)]
    found = docs.select(F.percentile_approx(rank, shares or [0.5], 10 * n).alias("b")).first()["b"] if n > 1 else None
    bounds = sorted(set(found or []), reverse=True)
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), rank.alias("rank")
    ).withColumn("part", _search(bounds, F.col("rank")))
    heads = {r["part"]: r["head"] for r in keyed.groupBy("part").agg(F.max("rank").alias("head")).collect()}
    parts = sorted(heads)
    before = {p: parts[k - 1] for k, p in enumerate(parts)}
    head = F.array(*[F.lit(heads.get(p)).cast("long") for p in range(len(bounds) + 1)])
    previous = F.array(*[F.lit(before.get(p, 0)) for p in range(len(bounds) + 1)])
    sent = F.when(F.get(head, F.col("part")) == F.col("rank"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    dealt = (
        keyed.select("doc_id", "text", "rank", "part", F.explode(sent).alias("tail"))
        .withColumn("part", F.when(F.col("tail"), F.get(previous, F.col("part"))).otherwise(F.col("part")))
        .repartitionById(len(bounds) + 1, F.col("part").cast("int"))
        .sortWithinPartitions("tail", F.desc("rank"), "text")
    )
    return dealt.select("doc_id", "text", "tail").mapInArrow(_edit, _EDITED_DDL)
