"""Places and running sums within keys, in an order in which a key's rows may be split over many tasks.

Rows are dealt by ranges of key and order, so a key with a third of all rows is cut like any others. Each task counts
from its first row on; the ends of the tasks, one row for each task, are carried over on the driver and added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwatch.session import stored


def ints(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _within(key: np.ndarray, columns: list[np.ndarray], state: tuple | None) -> tuple[list[np.ndarray], tuple]:
    """Running sums (wrapping) of columns of ones and values by key, going on from the last row before."""
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    lengths = np.diff(np.append(starts, len(key)))
    out = []
    for i, values in enumerate(columns):
        sums = np.cumsum(values)
        before = sums[starts] - values[starts]
        if state is not None and state[0] == key[0]:
            before[0] -= state[1][i]
        out.append(sums - np.repeat(before, lengths))
    return out, (key[-1], [c[-1] for c in out])


def running(df: DataFrame, key: str, order: list[str], keep: list[str], sums: list[str]) -> DataFrame:
    """The columns `keep` with `place` (1, 2, ... within the key by `order`) and `run_<c>` for each c of `sums`.

    key and sums are longs without nulls; sums wrap at 64 bits and include their row. Rows equal in key and order
    have places in any order.
    """
    ends = ["place", *(f"run_{c}" for c in sums)]
    kept = [key, *(c for c in keep if c != key)]
    ranged = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).select(*dict.fromkeys([*kept, *sums]))
    kept_schema = df.select(*kept).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept_schema) + ", part int, " + ", ".join(f"{c} long" for c in ends)

    def local(batches):
        part, state = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.ones(batch.num_rows, np.int64), *(ints(batch.column(c)) for c in sums)]
            out, state = _within(ints(batch.column(key)), columns, state)
            arrays = [*(batch.column(c) for c in kept), pa.array(np.full(batch.num_rows, part, np.int32)), *map(pa.array, out)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "part", *ends])

    table = stored(ranged.mapInArrow(local, ddl), "running")
    last = F.max(F.struct(key, *ends)).alias("last")
    tails = table.groupBy("part").agg(F.min(key).alias("first"), last).orderBy("part").collect()  # a row for each task
    carry, state = {}, None
    for tail in tails:
        end = np.array(tail["last"][1:], np.int64)
        if state is not None and state[0] == tail["first"]:
            carry[tail["part"]] = state
            if tail["last"][0] == tail["first"]:
                end = end + state[1]
        state = (tail["last"][0], end)

    def carried(batches):
        for batch in batches:
            parts, keys = ints(batch.column("part")), ints(batch.column(key))
            out = [np.array(ints(batch.column(c))) for c in ends]
            for part in np.unique(parts):
                if part in carry:
                    at = (parts == part) & (keys == carry[part][0])
                    for i, c in enumerate(out):
                        c[at] += carry[part][1][i]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, out)], names=[*kept, *ends])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept_schema) + ", " + ", ".join(f"{c} long" for c in ends)
    return table.mapInArrow(carried, ddl)
