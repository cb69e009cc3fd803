"""Language identification by prediction by partial matching.

Each language has a byte context tree: counts of the byte that follows every context of 0 to ORDER
bytes. A text's code length under a language is the sum of -log2 of exact PPM probabilities (escape
method C with full exclusion) under the frozen counts; the shortest code wins. As the counts never
change, the cost of a byte depends on its context alone, so the costs of all byte windows seen in
training are tabulated once and other windows are worked out when met.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.arrow import blocks, flat, record, unused

ORDER = 3
PAD = 10  # contexts before a text's first byte are line feeds
UNDETERMINED = "und"
#: Training sample: about so many documents of each language, and a passage of at most so many characters of each.
DOCS_PER_LANGUAGE, PASSAGE = 1500, 65_536
#: Bits a byte above which a text is in none of the languages; what takes eight is not compressed at all.
MAX_BITS_PER_BYTE = 7.0
#: Bytes of evidence that the score stands for.
EVIDENCE = 32

_GRAMS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
_SCORES = pa.schema(
    [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]
)


def windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte the number made of the ORDER bytes before it and itself."""
    lengths = np.diff(offsets)
    padded = np.full(len(data) + ORDER * len(lengths), PAD, np.uint8)
    places = np.arange(len(data)) + ORDER * np.repeat(np.arange(1, len(lengths) + 1), lengths)
    padded[places] = data
    out = np.zeros(len(data), np.uint32)
    for back in range(ORDER, -1, -1):
        out = (out << np.uint32(8)) | padded[places - back]
    return out


@dataclass
class ContextTree:
    """Counts of one language, by order: windows and contexts with what PPM needs of each."""

    grams: list = field(default_factory=list)  # per order: sorted windows, their counts
    contexts: list = field(default_factory=list)  # per order: sorted contexts, total, distinct, total in the shorter context

    @classmethod
    def fit(cls, grams: np.ndarray, counts: np.ndarray) -> ContextTree:
        tree = cls()
        for order in range(ORDER + 1):
            mask = np.uint32((1 << 8 * (order + 1)) - 1 if order < 3 else 0xFFFFFFFF)
            keys, inverse = np.unique(grams & mask, return_inverse=True)
            n = np.bincount(inverse, counts, len(keys))
            contexts, first = np.unique(keys >> np.uint32(8), return_index=True)
            total, distinct = np.add.reduceat(n, first), np.diff(np.append(first, len(keys)))
            shorter = np.zeros(len(contexts))
            if order:
                below, below_n = tree.grams[order - 1]
                at = np.searchsorted(below, keys & np.uint32((1 << 8 * order) - 1))
                shorter = np.add.reduceat(below_n[at], first)
            tree.grams.append((keys, n))
            tree.contexts.append((contexts, total, distinct.astype(float), shorter))
        return tree

    def cost(self, grams: np.ndarray) -> np.ndarray:
        """Bits for the last byte of each window after the others."""
        cost, open_ = np.zeros(len(grams)), np.ones(len(grams), bool)
        gone_total, gone_distinct = np.zeros(len(grams)), np.zeros(len(grams))
        for order in range(ORDER, -1, -1):
            keys = grams & np.uint32((1 << 8 * (order + 1)) - 1 if order < 3 else 0xFFFFFFFF)
            (known, n), (contexts, total, distinct, shorter) = self.grams[order], self.contexts[order]
            at = np.minimum(np.searchsorted(contexts, keys >> np.uint32(8)), len(contexts) - 1)
            here = open_ & (contexts[at] == keys >> np.uint32(8))
            left, novel = total[at] - gone_total, distinct[at] - gone_distinct
            where = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            found = here & (known[where] == keys)
            escaped = here & ~found & (novel > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                cost = np.where(found, cost - np.log2(n[where] / (left + novel)), cost)
                cost = np.where(escaped, cost - np.log2(novel / (left + novel)), cost)
            open_ &= ~found
            gone_total, gone_distinct = np.where(here, shorter[at], 0.0), np.where(here, distinct[at], 0.0)
        return np.where(open_, cost + np.log2(np.maximum(256 - gone_distinct, 1)), cost)


class LanguageModel:
    """Context trees of all languages and the costs of all windows met in training, in a hash table."""

    def __init__(self, languages: list[str], grams: list[np.ndarray], counts: list[np.ndarray]):
        self.languages = languages
        self.trees = [ContextTree.fit(g, n) for g, n in zip(grams, counts, strict=True)]
        known = np.unique(np.concatenate(grams)) if grams else np.empty(0, np.uint32)
        self.costs = np.stack([t.cost(known) for t in self.trees], axis=1) if len(known) else np.empty((0, len(languages)))
        self.bits = max(10, int(len(known)).bit_length() + 2)
        self.keys, self.rows = np.zeros(1 << self.bits, np.uint32), np.full(1 << self.bits, -1, np.int32)
        rest, slot = np.arange(len(known)), self._slot(known)
        while len(rest):  # open addressing: one key a round wins each free slot, the others go on to the next
            free = self.rows[slot[rest]] < 0
            _, first = np.unique(slot[rest][free], return_index=True)
            won = rest[free][first]
            self.rows[slot[won]], self.keys[slot[won]] = won, known[won]
            rest = np.setdiff1d(rest, won, assume_unique=True)
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return ((grams * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def _find(self, grams: np.ndarray) -> np.ndarray:
        """Row of each window in `costs`, -1 for those not met in training."""
        slot = self._slot(grams)
        rows = self.rows[slot]
        rest = np.flatnonzero((self.keys[slot] != grams) & (rows >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)
            rows[rest] = self.rows[slot[rest]]
            rest = rest[(self.keys[slot[rest]] != grams[rest]) & (rows[rest] >= 0)]
        return rows

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language; texts may not be empty."""
        grams = windows(data, offsets)
        rows = self._find(grams)
        table = self.costs
        new = rows < 0
        if new.any():
            unseen, inverse = np.unique(grams[new], return_inverse=True)
            rows[new] = len(table) + inverse
            table = np.concatenate([table, np.stack([t.cost(unseen) for t in self.trees], axis=1)])
        return np.stack([np.add.reduceat(table[:, k][rows], offsets[:-1]) for k in range(len(self.languages))], axis=1)


def _sample(labelled: DataFrame, docs_per_language: int) -> DataFrame:
    """Rows drawn by doc_id; of a long text a passage, whose place is drawn too."""
    counts = labelled.groupBy("lang").agg((docs_per_language / F.count("*")).alias("share"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) / 1e6
    chosen = labelled.join(F.broadcast(counts.withColumnRenamed("lang", "of")), F.col("lang") == F.col("of")).where(drawn < F.col("share"))
    places = F.greatest(F.length("text") - PASSAGE, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("doc_id", F.lit("passage")), places) + 1).cast("int")
    return chosen.select(F.substring("text", start, F.lit(PASSAGE)).alias("text"), "lang")


def _count(batches):
    found: dict[str, list] = {}
    for batch in batches:
        for block in blocks(batch, "text"):
            langs = block.column("lang").to_numpy(zero_copy_only=False)
            for lang in set(langs):
                data, offsets = flat(block.column("text").filter(pa.array(langs == lang)))
                grams, n = np.unique(windows(data, offsets), return_counts=True)
                found.setdefault(lang, []).append((grams, n))
    for lang, parts in found.items():
        grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        n = np.bincount(inverse, np.concatenate([n for _, n in parts]), len(grams)).astype(np.int64)
        yield record(_GRAMS, lang=[lang] * len(grams), gram=grams.astype(np.int64), n=n)


def fit(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """Learns from columns doc_id, text, lang; rows with a null text or lang teach nothing.

    The sample is bounded (`docs_per_language` documents expected of each language, PASSAGE characters each)
    and depends on doc_id alone; every label is learned. Windows are counted in the tasks and only their totals reach the driver.
    """
    usable = labelled.where("lang is not null and text <> ''").select("doc_id", "text", "lang")
    sample = _sample(usable, docs_per_language)
    grams = sample.select(F.lower("text").alias("text"), "lang").mapInArrow(_count, "lang string, gram long, n long")
    totals = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(totals["lang"].unique())
    parts = [totals[totals["lang"] == x].sort_values("gram") for x in languages]
    return LanguageModel(
        languages, [p["gram"].to_numpy().astype(np.uint32) for p in parts], [p["n"].to_numpy().astype(float) for p in parts]
    )


def _score_block(model: LanguageModel, block: pa.RecordBatch) -> pa.RecordBatch:
    n = block.num_rows
    lang, score, rate = np.full(n, UNDETERMINED, object), np.zeros(n), np.full(n, np.nan)
    data, offsets = flat(block.column("text"))
    lengths = np.diff(offsets)
    real = np.flatnonzero(block.column("has_letter").to_numpy(zero_copy_only=False).astype(bool) & (lengths > 0))
    if len(real) and model.languages:
        kept = np.repeat(np.isin(np.arange(n), real), lengths)
        bits = model.code_lengths(data[kept], np.append(0, np.cumsum(lengths[real])))
        best = bits.argmin(axis=1)
        shortest = bits[np.arange(len(real)), best]
        weight = np.minimum(lengths[real], EVIDENCE) / lengths[real]
        likely = np.exp2((shortest[:, None] - bits) * weight[:, None])
        lang[real] = np.array(model.languages, object)[best]
        score[real] = 1 / likely.sum(axis=1)
        rate[real] = shortest / lengths[real]
    return record(
        _SCORES, doc_id=block.column("doc_id"), lang_pred=lang, score=score, bits_per_byte=pa.array(rate, pa.float64(), from_pandas=True)
    )


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every whole text: doc_id, lang_pred, score (0 to 1), bits_per_byte.

    A null text, one without a letter, and any text under a model without languages gives `und`, score 0
    and null bits. Ties go to the first language by name. Repeated rows give repeated results; other
    columns are ignored. Upper and lower case count as the same.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            for block in blocks(batch, "text", 1_000_000):
                yield _score_block(shared.value, block)

    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.lower(text_col).alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
    )
    return texts.mapInArrow(score, "doc_id long, lang_pred string, score double, bits_per_byte double")


def accepted(docs: DataFrame, model: LanguageModel, text_col: str = "text", max_bits: float = MAX_BITS_PER_BYTE) -> DataFrame:
    """The rows of `docs` whose text is in one of the model's languages.

    Undetermined texts go, and those whose shortest code takes more than `max_bits` for a byte: their language
    is none of the model's, or they are no language at all. A model without languages accepts all with a letter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lower, letter = unused("lower", docs.columns), unused("letter", docs.columns)
    names = docs.columns

    def keep(batches):
        for batch in batches:
            for block in blocks(batch, lower, 1_000_000):
                ids = pa.array(np.zeros(block.num_rows, np.int64))
                texts = pa.RecordBatch.from_arrays([ids, block.column(lower), block.column(letter)], names=["doc_id", "text", "has_letter"])
                scored = _score_block(shared.value, texts)
                rate = scored.column("bits_per_byte").to_numpy(zero_copy_only=False)
                known = ~(rate > max_bits) & block.column(letter).to_numpy(zero_copy_only=False).astype(bool)
                yield block.select(names).filter(pa.array(known))

    rows = docs.withColumn(lower, F.lower(text_col)).withColumn(letter, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    return rows.mapInArrow(keep, docs.schema)


def held_out(id_col: str = "doc_id"):
    """True for documents that the model may not learn from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
