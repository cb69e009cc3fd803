"""Removal of substrings that also start in an earlier document, by suffix arrays.

A string of LENGTH bytes belongs to the smallest of the hashes of its GRAM-byte parts, its anchor; all strings of
a document that share an anchor form one piece of text. Equal strings have equal anchors, so a piece can only
share strings with pieces of the same anchor. What pieces share is found in three steps:

1. Pieces are told apart by hashes of 128 bits in all and dealt by anchor. A piece that an earlier document has too
   is wholly removed. A string around an anchor also holds SIDE bytes before it or SIDE bytes behind it. Of pieces
   that differ but share an anchor and such a side, one copy each goes on.
2. The text of these is fetched and dealt by anchor (strings one by one, if very many pieces share the anchor).
3. Of equal texts the later ones are removed. Each shard of the others gets a suffix array by Larsson-Sadakane refinement; Kasai's common prefixes mark off the
   groups of suffixes with LENGTH bytes in common. Shards of a bucket are merged by binary search of their sorted
   strings in each other's, and strings whose group has a smaller document are removed.

Records travel as parcels, one row for each bucket and batch. There are many more buckets than tasks: a task gets its
parcels in the order of their buckets and holds one bucket at a time, so what it holds does not follow its share.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.llm.arrow import PARCEL, PARCEL_DDL, blocks, flat, joined, packed, parcels, record, unpacked
from tabwatch.llm.hashing import Substrings, mix
from tabwatch.llm.suffix import equal_prefix_groups
from tabwatch.session import stored

LENGTH, GRAM = 50, 16
SIDE = (LENGTH - GRAM) // 2
_SPAN = LENGTH - GRAM + 1  # parts of a string
#: Bytes of text that one suffix array covers, and how many such shards are merged at most (more if an anchor has more).
SHARD_BYTES, MERGED = 1_000_000, 2
#: An anchor with more different pieces has its strings dealt one by one.
CROWD = 4096
#: Parcels of pieces in a batch.
_AT_ONCE = 512
#: Least numbers of buckets, by anchor and by row.
ANCHORS, ROWS = 1024, 200
#: Bytes worked on at a time; longer texts are read in overlapping stretches.
_STRETCH = 250_000
#: Bytes of text whose pieces are gathered, of records and of strings that are gathered before they are sent, and of texts packed at a time.
_GATHERED, _RECORDS, _HELD, _PACKED = 16_000_000, 4_000_000, 16_000_000, 16_000_000
_PLACE_BITS = np.uint64(24)

TEXT, REMOVED, FETCH, PIECE, STRINGS = 0, 1, 2, 3, 4
_PIECE = "u8 u8 i8 u8 u4 u1 u4 u4 u1"  # anchor, piece hash, doc, row, place, strings, hashes of both sides, where the anchor is
_REMOVED = "u8 u4 u4"  # row, start, end
_FETCH = "u8 u8 i8 u4 u1 u1"  # row, anchor, doc, place, strings, crowded
_TEXT = "u8 i8 u4 u1"  # row, doc, bytes, doc is null
_STRINGS = "u8 u4 i8 u4 u4"  # row, key (equal strings have equal ones), doc, place, bytes


def _parts(data: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes from each place on."""
    raw = np.append(data, np.zeros(GRAM, np.uint8)).tobytes()
    eight = np.empty(len(data) + 8, np.uint64)
    for shift in range(8):
        part = np.frombuffer(raw, "<u8", (len(raw) - shift) // 8, shift)
        eight[shift::8] = part[: len(eight[shift::8])]
    return mix(eight[: len(data)] + mix(eight[8:] * np.uint64(0x9E3779B97F4A7C15)))


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, hash, start, number of strings, hashes of both sides (0 for one that is cut off) and place of the anchor of
    all pieces of the texts."""
    parts = _parts(data)
    least = (parts >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(data), dtype=np.uint64)
    width = 1
    while width * 2 <= _SPAN:
        least = np.minimum(least[:-width], least[width:]) if len(least) > width else least[:0]
        width *= 2
    rest = _SPAN - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:]) if len(least) > rest else least[:0]
    n = max(0, len(data) - LENGTH + 1)
    anchor = (least[:n] & np.uint64((1 << 24) - 1)).astype(np.int64)
    whole = np.zeros(len(data) + 1, np.int64)  # strings end with their text
    lengths = np.diff(offsets)
    np.add.at(whole, offsets[:-1], lengths >= LENGTH)
    np.add.at(whole, offsets[:-1] + np.maximum(lengths - LENGTH + 1, 0), -(lengths >= LENGTH).astype(np.int64))
    inside = np.cumsum(whole)[:n] > 0
    owner = np.repeat(np.arange(len(lengths)), lengths)[:n]
    fresh = np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1])[:n] & inside
    start = np.flatnonzero(fresh)
    ahead = np.append(0, np.cumsum(inside))
    count = np.diff(ahead[np.append(start, n)])
    end, place, hashes = start + count + LENGTH - 1, anchor[start], Substrings(data)

    def side(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        fits = (low >= start) & (high <= end)
        found = (hashes.of(np.where(fits, low, start), np.where(fits, high, end)) >> np.uint64(32)) | np.uint64(1)
        return np.where(fits, found, np.uint64(0)).astype(np.uint32)

    before, behind = side(place - SIDE, place + GRAM), side(place, place + GRAM + SIDE)
    return parts[place], hashes.of(start, end), start, count, before, behind, place - start


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Number of the run of equal keys that each row is in."""
    fresh = np.zeros(len(keys[0]), bool)
    for k in keys:
        fresh[1:] |= k[1:] != k[:-1]
    return np.cumsum(fresh)


def _same_piece(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of records by anchor, piece and document, and for each record whether a smaller document has its piece."""
    anchor, piece, doc = columns[:3]
    order = np.lexsort((doc, piece, anchor))
    run = _runs(anchor[order], piece[order])
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))[: len(run)]
    later = np.zeros(len(order), bool)
    later[order] = doc[order] > doc[order][first][run]
    return order, later


def _planes(values: np.ndarray) -> np.ndarray:
    """The first bytes of all values, their second bytes and so on."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T


def _of_planes(planes: np.ndarray) -> np.ndarray:
    """Values whose bytes stand so."""
    by_value = planes.view(np.uint8).reshape(planes.itemsize, -1).T
    return np.ascontiguousarray(by_value).view(planes.dtype).ravel()


def _squeezed(columns: list[np.ndarray]) -> bytes:
    """Records of pieces, compressed: small parcels of plain ones take a quarter more room than large ones."""
    anchor, piece, doc, row, place, *rest = columns
    steps = np.diff(doc, prepend=np.int64(0))
    return zstandard.compress(packed([anchor, piece, _planes(steps), row, _planes(place), *rest]), 1)


def _loosened(records: bytes) -> list[np.ndarray]:
    anchor, piece, steps, row, place, *rest = unpacked(zstandard.decompress(records), _PIECE)
    return [anchor, piece, np.cumsum(_of_planes(steps)), row, _of_planes(place), *rest]


def _whole(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Records of pieces as spans to remove."""
    row, place, count = columns[3:6]
    return [row, place, place + count.astype(np.uint32) + np.uint32(LENGTH - 1)]


class _Outbox:
    """Records by row, gathered until their parcels are worth a row each."""

    def __init__(self, kind: int, types: str, rows: int):
        self.kind, self.types, self.rows, self.held, self.size = kind, types, np.uint64(rows), [], 0

    def add(self, columns: list[np.ndarray]):
        if len(columns[0]):
            self.held.append(columns)
            self.size += sum(c.nbytes for c in columns)
        if self.size > _RECORDS:
            yield from self.send()

    def send(self):
        columns = joined(self.held, self.types)
        self.held, self.size = [], 0
        yield from parcels(self.kind, (columns[0] % self.rows).astype(np.int32), columns)


def _received(batches):
    """(kind, bucket, records, data) of one parcel after the other; data as a buffer."""
    for batch in batches:
        kinds, buckets, records, data = (batch.column(c) for c in ("kind", "bucket", "records", "data"))
        for k in range(batch.num_rows):
            yield kinds[k].as_py(), buckets[k].as_py(), records[k].as_py(), data[k].as_buffer()


def _stretches(batch: pa.RecordBatch):
    """(row in the batch, place in its text) of each text and the texts' bytes; long texts in overlapping stretches."""
    for block in blocks(batch, "text", _STRETCH):
        data, offsets = flat(block.column("text"))
        doc = block.column("rank").to_numpy(zero_copy_only=False)
        row = block.column("row").to_numpy(zero_copy_only=False).view(np.uint64)
        if len(offsets) == 2 and len(data) > _STRETCH:
            for at in range(0, len(data) - LENGTH + 1, _STRETCH):
                part = data[at : at + _STRETCH + LENGTH - 1]
                yield doc, row, at, part, np.array([0, len(part)])
        else:
            yield doc, row, 0, data, offsets


def _cut(anchors: int, rows: int):
    """Pieces of a batch, _GATHERED bytes of text at a time. Of a piece that several documents have only the first one's is
    dealt; the others' are removed here."""

    def send(found: list, removed: _Outbox):
        columns = joined(found, _PIECE)
        found.clear()
        _, later = _same_piece(columns)
        yield from removed.add(_whole([c[later] for c in columns[:6]]))
        for k in range(len(columns)):
            columns[k] = columns[k][~later]
        bucket = (columns[0] % np.uint64(anchors)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        first = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1]))[: len(order)]
        for at in range(0, len(first), _AT_ONCE):
            own = np.split(order, first[1:])[at : at + _AT_ONCE]
            rows = [_squeezed([c[o] for c in columns]) for o in own]
            yield record(PARCEL, kind=[PIECE] * len(rows), bucket=[bucket[o[0]] for o in own], records=rows, data=[b""] * len(rows))

    def run(batches):
        removed = _Outbox(REMOVED, _REMOVED, rows)
        found, size = [], 0
        for batch in batches:
            for doc, row, at, data, offsets in _stretches(batch):
                anchor, piece, start, count, before, behind, inner = pieces(data, offsets)
                owner = np.searchsorted(offsets, start, side="right") - 1
                place = (start - offsets[owner] + at).astype(np.uint32)
                found.append([anchor, piece, doc[owner], row[owner], place, count.astype(np.uint8), before, behind, inner.astype(np.uint8)])
                size += len(data)
                if size > _GATHERED:
                    yield from send(found, removed)
                    size = 0
        yield from send(found, removed)
        yield from removed.send()

    return run


def _compare(rows: int):
    """Removes pieces that an earlier document has; asks for the text of those that only share an anchor with one."""

    def earliest(found: list, removed: _Outbox):
        """The pieces in order; those that an earlier document among them has go out."""
        columns = joined(found, _PIECE)
        found.clear()
        order, later = _same_piece(columns)
        yield from removed.add(_whole([c[later] for c in columns[:6]]))
        order = order[~later[order]]
        found.append([c[order] for c in columns])

    def asked(columns: list[np.ndarray]) -> list[np.ndarray]:
        before, behind = _shared_side(columns, 6), _shared_side(columns, 7)
        wanted = before | behind
        anchor, piece, doc, row, place, count, _, _, inner = (c[wanted] for c in columns)
        if not len(anchor):
            return joined([], _FETCH)
        # Strings from SIDE bytes before the anchor on hold the side behind it, those up to there the one before it.
        turn = inner.astype(np.int64) - SIDE
        skip = np.where(before[wanted], 0, np.clip(turn, 0, count - 1))
        left = np.where(behind[wanted], count, np.clip(turn + 1, 1, count)) - skip
        place, count = (place + skip).astype(np.uint32), left.astype(np.uint8)
        run = _runs(anchor)
        different = np.bincount(run, np.append(True, (piece[1:] != piece[:-1]) | (run[1:] != run[:-1])))
        crowded = (different > CROWD)[run].astype(np.uint8)
        return [row, anchor, doc, place, count, crowded]

    def run(batches):
        removed, fetch = _Outbox(REMOVED, _REMOVED, rows), _Outbox(FETCH, _FETCH, rows)
        at, found, size, most = None, [], 0, _RECORDS
        ready = []

        def others():
            """Parcels of pieces; what is removed already goes on as it is."""
            for batch in batches:
                done = pc.equal(batch.column("kind"), REMOVED)
                if (passed := batch.filter(done)).num_rows:
                    ready.append(passed)
                yield batch.filter(pc.invert(done))

        for _, bucket, records, _ in _received(others()):
            yield from ready
            ready.clear()
            if bucket != at and found:
                yield from earliest(found, removed)
                yield from fetch.add(asked(found.pop()))
                size, most = 0, _RECORDS
            at = bucket
            found.append(_loosened(records))
            size += sum(c.nbytes for c in found[-1])
            if size > most:  # a bucket with many pieces: copies go at once
                yield from earliest(found, removed)
                size = sum(c.nbytes for c in found[-1])
                most = max(_RECORDS, 2 * size)
        yield from ready
        if found:
            yield from earliest(found, removed)
            yield from fetch.add(asked(found.pop()))
        yield from removed.send()
        yield from fetch.send()

    return run


def _shared_side(columns: list[np.ndarray], which: int) -> np.ndarray:
    """Records whose anchor and side another piece of another document has too."""
    anchor, piece, doc, side = columns[0], columns[1], columns[2], columns[which]
    out = np.zeros(len(anchor), bool)
    if not len(anchor):
        return out
    order = np.lexsort((piece, side, anchor))
    run = _runs(anchor[order], side[order])
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    several = np.minimum.reduceat(piece[order], first) < np.maximum.reduceat(piece[order], first)
    spread = np.minimum.reduceat(doc[order], first) < np.maximum.reduceat(doc[order], first)
    out[order] = (several & spread)[run] & (side[order] != 0)
    return out


def _texts(rows_: int):
    """All texts, compressed, by the bucket of their row."""

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for block in blocks(batch, "text", _PACKED):
                row = block.column("row").to_numpy(zero_copy_only=False).view(np.uint64)
                doc, null = block.column("rank").to_numpy(zero_copy_only=False), block.column("null_id").to_numpy(zero_copy_only=False)
                data, offsets = flat(block.column("text"))
                data = data.tobytes()
                bucket = (row % np.uint64(rows_)).astype(np.int32)
                rows = []
                for b in np.unique(bucket):
                    own = np.flatnonzero(bucket == b)
                    text = b"".join([data[offsets[k] : offsets[k + 1]] for k in own])
                    lengths = np.diff(offsets)[own].astype(np.uint32)
                    rows.append((TEXT, b, packed([row[own], doc[own], lengths, null[own].astype(np.uint8)]), squeeze.compress(text)))
                if rows:
                    yield record(PARCEL, **dict(zip(PARCEL.names, zip(*rows, strict=True), strict=True)))

    return run


def _by_text(batches, types: str, use):
    """Each bucket comes with its records first: use(records by row, records of texts, data, offsets) for each parcel of texts."""
    at, held, ready = None, [], None
    for kind, bucket, records, data in _received(batches):
        if bucket != at:
            at, held, ready = bucket, [], None
        if kind != TEXT:
            held.append(unpacked(records, types))
            continue
        if ready is None:
            columns = joined(held, types)
            order = np.lexsort((columns[1], columns[0]))
            ready, held = [c[order] for c in columns], []
        texts = unpacked(records, _TEXT)
        data = np.frombuffer(zstandard.decompress(data, max_output_size=int(texts[2].sum()) + 1), np.uint8)
        yield from use(ready, texts, data, np.append(0, np.cumsum(texts[2].astype(np.int64))))


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], ..., start[0] + length[0] - 1, start[1], ..."""
    ahead = np.cumsum(length) - length
    return np.repeat(start - ahead, length) + np.arange(length.sum())


def _extract(anchors: int):
    """The wanted pieces of text, by anchor; a task gathers them up to _HELD bytes and sends a parcel for each bucket."""
    n = np.uint64(anchors)

    def cut(wanted, texts, data, offsets):
        row, anchor, doc, place, count, crowded = wanted
        low, high = np.searchsorted(row, texts[0], "left"), np.searchsorted(row, texts[0], "right")
        which = _ranges(low, high - low)
        start = place[which] + np.repeat(offsets[:-1], high - low)
        length = count[which].astype(np.int64) + LENGTH - 1
        single = np.flatnonzero(crowded[which])
        one_by_one = _ranges(start[single], count[which][single].astype(np.int64))
        back = np.repeat(single, count[which][single])
        whole = np.flatnonzero(crowded[which] == 0)
        hashes = Substrings(data).of(one_by_one, one_by_one + LENGTH) if len(single) else np.empty(0, np.uint64)
        dealt = np.concatenate([anchor[which][whole], hashes])
        bucket, key = (dealt % n).astype(np.int64), (dealt // n).astype(np.uint32)
        start_, length_ = np.concatenate([start[whole], one_by_one]), np.concatenate([length[whole], np.full(len(back), LENGTH)])
        source = np.concatenate([whole, back])
        base = np.repeat(offsets[:-1], high - low)[source]
        columns = [row[which][source], key, doc[which][source], (start_ - base).astype(np.uint32), length_.astype(np.uint32)]
        return bucket, columns, data[_ranges(start_, length_)]

    def send(held):
        bucket = np.concatenate([b for b, _, _ in held])
        columns, text = joined([c for _, c, _ in held], _STRINGS), np.concatenate([t for _, _, t in held])
        held.clear()
        length = columns[4].astype(np.int64)
        start = np.cumsum(length) - length
        order = np.argsort(bucket, kind="stable")
        cuts = np.append(np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])), len(order))
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = order[a:b]
            pieces_ = text[_ranges(start[own], length[own])].tobytes()
            rows.append((STRINGS, int(bucket[own[0]]), packed([c[own] for c in columns]), pieces_))
        yield record(PARCEL, **dict(zip(PARCEL.names, zip(*rows, strict=True), strict=True)))

    def run(batches):
        held, size = [], 0
        for found in _by_text(batches, _FETCH, lambda *x: [cut(*x)]):
            if len(found[0]):
                held.append(found)
                size += len(found[2])
            if size > _HELD:
                yield from send(held)
                size = 0
        if held:
            yield from send(held)

    return run


def _merged(known: tuple[np.ndarray, np.ndarray], new: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted lists of strings with their least documents as one, by binary search of the new ones in the known."""
    at = np.searchsorted(known[0], new[0])
    same = (at < len(known[0])) & (known[0][np.minimum(at, len(known[0]) - 1)] == new[0])
    least = known[1].copy()
    least[at[same]] = np.minimum(least[at[same]], new[1][same])
    return np.insert(known[0], at[~same], new[0][~same]), np.insert(least, at[~same], new[1][~same])


class Shard:
    """The suffix array of some texts, with the suffixes of LENGTH bytes grouped by those bytes."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, docs: np.ndarray):
        offsets = np.append(0, np.cumsum(lengths))
        text = np.repeat(np.arange(len(lengths)), lengths)
        array, group = equal_prefix_groups(data, LENGTH)
        fits = array + LENGTH <= offsets[text[array] + 1]
        self.start, self.group = array[fits], _runs(group[fits])
        self.first = np.flatnonzero(np.append(True, self.group[1:] != self.group[:-1]))[: len(self.start)]
        self.docs = docs[text[self.start]]
        self.least = np.minimum.reduceat(self.docs, self.first) if len(self.first) else self.docs
        self.data = data

    def strings(self) -> tuple[np.ndarray, np.ndarray]:
        """The different strings in order (of one length, so trailing zero bytes make no difference) and their least documents."""
        at = self.start[self.first]
        taken = self.data[at[:, None] + np.arange(LENGTH)] if len(at) else np.empty((0, LENGTH), np.uint8)
        return np.ascontiguousarray(taken).view(f"S{LENGTH}").ravel(), self.least

    def repeated(self, least: np.ndarray) -> np.ndarray:
        """Starts of strings that a document before theirs has."""
        return np.sort(self.start[least[self.group] < self.docs])


def repeated_strings(data: np.ndarray, lengths: np.ndarray, docs: np.ndarray, shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """Starts, in the joined data, of all strings that a text of a smaller document has too."""
    offsets = np.append(0, np.cumsum(lengths.astype(np.int64)))
    cuts, at = [0], 0
    while at < len(lengths):
        at = max(at + 1, int(np.searchsorted(offsets, offsets[at] + shard_bytes, side="right")) - 1)
        cuts.append(min(at, len(lengths)))
    shards = [Shard(data[offsets[a] : offsets[b]], lengths[a:b], docs[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    if len(shards) == 1:
        return shards[0].repeated(shards[0].least)
    known = (np.empty(0, f"S{LENGTH}"), np.empty(0, np.int64))
    for shard in shards:
        known = _merged(known, shard.strings()) if len(known[0]) else shard.strings()
    out = []
    for a, shard in zip(cuts, shards, strict=False):
        strings, _ = shard.strings()
        out.append(shard.repeated(known[1][np.searchsorted(known[0], strings)]) + offsets[a])
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _text_hashes(data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hashes of the texts, so many at a time."""
    end = np.cumsum(length)
    out, at = np.empty(len(length), np.uint64), 0
    while at < len(length):
        low = end[at] - length[at]
        to = max(at + 1, int(np.searchsorted(end, low + _STRETCH, side="right")))
        out[at:to] = Substrings(data[low : end[to - 1]]).of(end[at:to] - length[at:to] - low, end[at:to] - low)
        at = to
    return out


def _search(rows: int, shard_bytes: int):
    """Strings that a smaller document has too; so many buckets at a time that their texts fill a shard."""

    def spans(columns: list[np.ndarray], data: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Texts that a smaller document has, and spans of the others, to remove."""
        row, _, doc, place, length = columns
        length = length.astype(np.int64)
        hashes = _text_hashes(data, length)
        order = np.lexsort((doc, hashes))
        run = _runs(hashes[order])
        head = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        later = doc[order] > doc[order][head][run]
        gone = order[later]
        whole = [row[gone], place[gone], place[gone] + length[gone].astype(np.uint32)]
        # one of each text that is left; copies of it in rows of the same document get the same spans
        members, run, one = order[~later], run[~later], order[head]
        first = np.searchsorted(run, np.arange(len(one)))
        copies = np.diff(np.append(first, len(run)))
        start = (np.cumsum(length) - length)[one]
        found = repeated_strings(data[_ranges(start, length[one])], length[one], doc[one], shard_bytes)
        offsets = np.append(0, np.cumsum(length[one]))
        text = np.searchsorted(offsets, found, side="right") - 1
        start = (found - offsets[text]).astype(np.uint32)
        # neighbouring strings go as one span
        fresh = np.append(True, (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1))[: len(text)]
        head = np.flatnonzero(fresh)
        tail = np.append(head[1:], len(text))[: len(head)] - 1
        owner = members[_ranges(first[text[head]], copies[text[head]])]
        each = np.repeat(np.arange(len(head)), copies[text[head]])
        low, high = start[head][each] + place[owner], start[tail][each] + place[owner] + np.uint32(LENGTH)
        return whole, [row[owner], low, high]

    def searched(records: list, texts: list):
        columns, data = joined([r for _, r in records], _STRINGS), np.frombuffer(b"".join(texts), np.uint8)
        bucket = np.repeat([b for b, _ in records], [len(r[0]) for _, r in records])
        records.clear()
        texts.clear()
        # Strings with different buckets or keys differ: texts are worked on by key, as many as give MERGED shards.
        order = np.lexsort((columns[1], bucket))
        length = columns[4].astype(np.int64)
        start = np.cumsum(length) - length
        run, end = _runs(bucket[order], columns[1][order]), np.cumsum(length[order])
        cuts = np.append(np.flatnonzero(np.append(True, run[1:] != run[:-1])), len(run))
        upto, at = np.append(0, end)[cuts], 0
        while at < len(cuts) - 1:
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + MERGED * shard_bytes, side="right")) - 1)
            own = order[cuts[at] : cuts[to]]
            yield from spans([c[own] for c in columns], data[_ranges(start[own], length[own])])
            at = to

    def run(batches):
        removed = _Outbox(REMOVED, _REMOVED, rows)
        at, records, texts, size = None, [], [], 0
        for _, bucket, some, data in _received(batches):
            if bucket != at and size >= shard_bytes:
                for found in searched(records, texts):
                    yield from removed.add(found)
                size = 0
            at = bucket
            records.append((bucket, unpacked(some, _STRINGS)))
            texts.append(data.to_pybytes())
            size += len(texts[-1])
        if records:
            for found in searched(records, texts):
                yield from removed.add(found)
        yield from removed.send()

    return run


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
)
_RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _finish(with_text: bool):
    def use(removed, texts, data, offsets):
        low, high = np.searchsorted(removed[0], texts[0], "left"), np.searchsorted(removed[0], texts[0], "right")
        out = []
        for k in range(len(low)):
            text = data[offsets[k] : offsets[k + 1]]
            gone, spans = 0, 0
            if high[k] > low[k]:
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, removed[1][low[k] : high[k]], 1)
                np.add.at(edge, removed[2][low[k] : high[k]], -1)
                covered = np.cumsum(edge[:-1]) > 0
                gone, spans = int(covered.sum()), int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
                text = text[~covered]
            kept = text.tobytes()
            doc = None if texts[3][k] else int(texts[1][k])
            out.append((doc, int(texts[2][k]), gone, spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        yield record(_RESULT, **dict(zip(_RESULT.names, zip(*out, strict=True), strict=True)))

    return lambda batches: _by_text(batches, _REMOVED, use)


def remove_repeats(
    docs: DataFrame, with_text: bool = False, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and (if asked for) the kept bytes of every whole text.

    Texts are judged as UTF-8 bytes; a null one is empty. A byte goes if a string of LENGTH bytes over it also starts
    in a document with a smaller doc_id. Rows with equal ids do not count against each other, a null id comes before
    all others; other columns are ignored.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(
        rank.alias("rank"), F.col(id_col).isNull().alias("null_id"), F.xxhash64(F.col(id_col).cast("long"), text_col).alias("row"),
        F.col(text_col).alias("text"),
    )

    def dealt(parcels_: DataFrame) -> DataFrame:
        return parcels_.repartitionById(n, F.col("bucket") % n).sortWithinPartitions("bucket", F.desc("kind"))

    anchors, by_row = (n * -(-least // n) for least in (ANCHORS, ROWS))  # as many for each task
    compared = stored(dealt(rows.mapInArrow(_cut(anchors, by_row), PARCEL_DDL)).mapInArrow(_compare(by_row), PARCEL_DDL), "repeats")
    texts = rows.mapInArrow(_texts(by_row), PARCEL_DDL)
    strings = dealt(compared.where(F.col("kind") == FETCH).union(texts)).mapInArrow(_extract(anchors), PARCEL_DDL)
    searched = dealt(strings).mapInArrow(_search(by_row, shard_bytes), PARCEL_DDL)
    removed = compared.where(F.col("kind") == REMOVED).union(searched)
    result = dealt(removed.union(texts)).mapInArrow(_finish(with_text), _RESULT_DDL)
    return result if with_text else result.drop("kept")
