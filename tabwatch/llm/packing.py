"""Packing tokenized texts into fixed windows by minimum bin slack.

A text's ids are cut into full windows and a remainder. Remainders wait in a bounded pool, held as
counts per length. Each window takes the longest remainder and then the multiset of others that comes
closest to the capacity: a subset-sum over lengths and counts kept as one bitset, traced back to counts
and used again as often as the counts allow. Slack that no remainder fits is filled by cutting the
longest one. Every task packs its own rows in order: nothing is shuffled, and a repeated task gives
the same rows.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections import Counter, defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.arrow import blocks, flat
from tabwatch.llm.hashing import Substrings, word_spans

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Remainders that a task holds before it packs them down to half as many (at most 8 KB each).
POOL = 4096
#: Parts of texts whose ids a worker remembers before it starts anew.
CACHED_WORDS = 2_000_000

_SCHEMA = pa.schema(
    [("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
)
DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths (with at most `counts` of each) whose sum is the largest up to `room`."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, share = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(share, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left, share = left - take, share * 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] += take
            total -= length * take
    return dict(used)


# Classes of bytes: white space ends words; runs of letters and runs of signs are words, as is each digit.
_SPACE, _LETTER, _SIGN, _DIGIT, _OTHER, _WHOLE = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[0x21:0x7F] = _SIGN
_CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("'")] = _OTHER  # it can begin a word of letters


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the smallest parts that the tokenizer surely treats apart, whether each must be encoded on its
    own, and the bytes with the letters of the others in lower case.

    Parts are runs of Latin-1 letters, runs of ASCII signs, and digits. What stands between white space and has other
    characters, an apostrophe, or a sign that could begin a special token, is one part.
    """
    upper = (data >= ord("A")) & (data <= ord("Z"))
    text = data + np.where(upper, np.uint8(32), np.uint8(0))
    kind = _CLASS[text]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] >= 0x80) & (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER  # all other characters of this block are letters
    odd = kind == _OTHER
    odd[np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))] = True
    if odd.any():
        starts, ends, _ = word_spans(data, offsets)
        ahead = np.append(0, np.cumsum(odd))
        whole = np.flatnonzero(ahead[ends] > ahead[starts])
        edge = np.zeros(len(data) + 1, np.int8)
        edge[starts[whole]] += 1
        edge[ends[whole]] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
        kind[inside], text[inside] = _WHOLE, data[inside]
    fresh = np.ones(len(data) + 1, bool)
    if len(data):
        fresh[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        fresh[offsets] = True
    starts = np.flatnonzero(fresh)
    starts, ends = starts[:-1], starts[1:]
    filled = kind[starts] != _SPACE
    starts, ends = starts[filled], ends[filled]
    return starts, ends, kind[starts] == _WHOLE, text


class WordIds:
    """Ids of texts, from those of their different parts (see units).

    The ids of parts are remembered under the parts' hashes in sorted arrays. A part of letters or signs is one word to
    the tokenizer, and a word's last id is one of a token with the word-end suffix, so many new parts are encoded as one
    string that is cut after such ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary, suffix = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.stops = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.stops[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known, self.place, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where those of each text begin."""
        starts, ends, alone, text = units(data, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        if len(self.known) > CACHED_WORDS:
            self._forget()
        hashes = Substrings(text).of(starts, ends) ^ alone
        order = np.argsort(hashes)
        fresh = np.append(True, hashes[order][1:] != hashes[order][:-1])
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        at = np.searchsorted(self.known, hashes[first])
        new = np.ones(len(first), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != hashes[first]
        if new.any():
            raw, learn = text.tobytes(), first[new]
            ids = self._encode([raw[a:b] for a, b in zip(starts[learn].tolist(), ends[learn].tolist(), strict=True)], alone[learn])
            sizes = np.array([len(x) for x in ids])
            places = len(self.pool) + np.cumsum(sizes) - sizes
            self.pool = np.concatenate([self.pool, *ids])
            self.known = np.insert(self.known, at[new], hashes[learn])
            self.place, self.size = np.insert(self.place, at[new], places), np.insert(self.size, at[new], sizes)
            at = np.searchsorted(self.known, hashes[first])
        size = self.size[at][which]
        before = np.append(0, np.cumsum(size))
        ids = self.pool[np.repeat(self.place[at][which] - before[:-1], size) + np.arange(before[-1])]
        return ids, before[np.searchsorted(starts, offsets)]

    def _encode(self, parts: list[bytes], alone: np.ndarray) -> list[np.ndarray]:
        out: list = [None] * len(parts)
        plain, rest = np.flatnonzero(~alone).tolist(), np.flatnonzero(alone).tolist()
        if plain:
            ids = np.array(self.tokenizer.encode(b" ".join([parts[k] for k in plain]).decode("utf-8"), add_special_tokens=False).ids, np.uint32)
            stops = np.flatnonzero(self.stops[ids]) + 1
            if len(stops) == len(plain) and stops[-1] == len(ids):
                for k, x in zip(plain, np.split(ids, stops[:-1]), strict=True):
                    out[k] = x
            else:
                rest = range(len(parts))
        found = self.tokenizer.encode_batch_fast([parts[k].decode("utf-8") for k in rest], add_special_tokens=False)
        for k, encoding in zip(rest, found, strict=True):
            out[k] = np.array(encoding.ids, np.uint32)
        return out


@functools.lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One per Python worker, for all tasks that it runs."""
    return WordIds(path)


class Packer:
    """Takes documents in order; `rows` gathers the pieces whose place is settled."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next_id = capacity, first_sequence
        self.pool: dict[int, deque] = defaultdict(deque)
        self.waiting, self.rows = 0, []

    def _sequence(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _settle(self, doc, start, ids, tokens, sequence, offset):
        self.rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), tokens, sequence, offset))

    def _wait(self, doc, start, ids, tokens):
        self.pool[len(ids) // 4].append((doc, start, ids, tokens))
        self.waiting += 1

    def _take(self, length: int):
        queue = self.pool[length]
        item = queue.popleft()
        if not queue:
            del self.pool[length]
        self.waiting -= 1
        return item

    def add(self, doc, ids: bytes) -> None:
        tokens, size = len(ids) // 4, 4 * self.capacity
        for at in range(0, len(ids) - len(ids) % size, size):
            self._settle(doc, at // 4, ids[at : at + size], tokens, self._sequence(), 0)
        if len(ids) % size:
            at = len(ids) - len(ids) % size
            self._wait(doc, at // 4, ids[at:], tokens)

    def _window(self) -> bool:
        """Packs one mix of lengths as often as it can be; False if too little is left for a window."""
        counts = {length: len(queue) for length, queue in self.pool.items()}
        if sum(length * n for length, n in counts.items()) < self.capacity:
            return False
        longest = max(counts)
        counts[longest] -= 1
        mix = Counter(fill(counts, self.capacity - longest))
        mix[longest] += 1
        slack = self.capacity - sum(length * n for length, n in mix.items())
        counts[longest] += 1
        times = 1 if slack else min(counts[length] // n for length, n in mix.items())
        for _ in range(times):
            sequence, offset = self._sequence(), 0
            for length in sorted(mix, reverse=True):
                for _ in range(mix[length]):
                    self._settle(*self._take(length), sequence, offset)
                    offset += length
            if slack:
                self._cut(max(self.pool), slack, sequence, offset)
        return True

    def _cut(self, length: int, most: int, sequence: int, offset: int) -> None:
        doc, start, ids, tokens = self._take(length)
        self._settle(doc, start, ids[: 4 * most], tokens, sequence, offset)
        if length > most:
            self._wait(doc, start + most, ids[4 * most :], tokens)

    def pack(self, down_to: int) -> None:
        while self.waiting > down_to and self._window():
            pass

    def finish(self) -> None:
        """Packs all; the last ids, too few for a window, go into sequences of a power of two, which need no padding."""
        self.pack(0)
        while self.waiting:
            size = 1 << (sum(length * len(q) for length, q in self.pool.items()).bit_length() - 1)
            sequence, offset = self._sequence(), 0
            while offset < size:
                length = max(self.pool)
                taken = min(length, size - offset)
                self._cut(length, taken, sequence, offset)
                offset += taken


def _pack(tokenizer: str, capacity: int, end_id: int):
    def run(batches):
        ids_of, end = _word_ids(tokenizer), end_id.to_bytes(4, "little")
        packer = Packer(capacity, TaskContext.get().partitionId() << 36)

        def settled():
            rows, packer.rows = packer.rows, []
            columns = list(zip(*rows, strict=True)) or [()] * len(_SCHEMA)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)

        for batch in batches:
            for block in blocks(batch, "text"):
                ids, starts = ids_of(*flat(block.column("text")))
                ids, starts = ids.astype("<u4").tobytes(), (4 * starts).tolist()
                for k, doc in enumerate(block.column("doc_id").to_pylist()):
                    packer.add(doc, ids[starts[k] : starts[k + 1]] + end)
                    if packer.waiting >= POOL:
                        packer.pack(POOL // 2)
                yield settled()
        packer.finish()
        yield settled()

    return run


def pack(
    docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A text's ids are the tokenizer's and then `end_id`, so a null or empty text has one id. `tokenizer` is a
    file of the `tokenizers` library whose pre-tokenizer ends words at white space: a path that all executors
    reach, or the name of one of the installed public ones. Rows are packed as they come; equal doc_ids are
    separate documents. Other columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_pack(tokenizer, capacity, end_id), DDL)
