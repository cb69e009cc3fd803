"""Arrow helpers: texts as flat byte arrays, processed in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text a task works on at a time; a single longer text forms a block of its own.
BLOCK_BYTES = 2_000_000


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def unused(name: str, taken: list[str]) -> str:
    """The name, made longer until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with at most `most` bytes of text each (or one row)."""
    _, offsets = flat(batch.column(column))
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield batch.slice(start, end - start)
        start = end


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, f.type) for f, v in ((f, columns[f.name]) for f in schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


#: Rows that carry many small records to a bucket at once: what they are, the bucket, the records by column.
PARCEL = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("records", pa.binary()), ("data", pa.binary())])
PARCEL_DDL = "kind int, bucket int, records binary, data binary"


def packed(columns: list[np.ndarray]) -> bytes:
    return b"".join([np.ascontiguousarray(c).tobytes() for c in columns])


def unpacked(records: bytes, types: str) -> list[np.ndarray]:
    """Columns of the given one-letter-and-size types, separated by spaces."""
    dtypes = [np.dtype(t) for t in types.split()]
    n = len(records) // sum(t.itemsize for t in dtypes)
    out, at = [], 0
    for t in dtypes:
        out.append(np.frombuffer(records, t, n, at))
        at += n * t.itemsize
    return out


def joined(parts: list[list[np.ndarray]], types: str) -> list[np.ndarray]:
    """Columns of several unpacked records one after the other."""
    if not parts:
        return [np.empty(0, np.dtype(t)) for t in types.split()]
    return [np.concatenate(p) for p in zip(*parts, strict=True)]


def parcels(kind: int, bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row for each bucket that occurs, with its records in their order."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    columns, bucket = [c[order] for c in columns], bucket[order]
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    rows = [packed([c[a:b] for c in columns]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    yield record(PARCEL, kind=[kind] * len(rows), bucket=bucket[cuts[:-1]].astype(np.int32), records=rows, data=[b""] * len(rows))
