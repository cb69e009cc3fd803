"""Login attempt limiter as a stateful stream.

A window opens at a key's first failure and does not slide; once it holds the maximum number of
failures, every attempt of that key is blocked until it ends. A success before that clears it.
Blocked attempts neither count nor clear.

The state of a key is one open window, so it is constant in size. Attempts of a key are taken in time
order within a micro-batch, whose size the source's `maxFilesPerTrigger` bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tabwatch.schema import MonitorConfig


def decide(micros: np.ndarray, success: np.ndarray, start: int | None, failures: int, config: MonitorConfig) -> tuple[np.ndarray, int | None, int]:
    """Blocked flags of one key's attempts in time order, and the window left open after them."""
    span = config.login_window_seconds * 1_000_000
    blocked = np.zeros(len(micros), dtype=bool)
    for i, (now, ok) in enumerate(zip(micros, success)):
        if start is not None and now >= start + span:
            start, failures = None, 0
        if failures >= config.login_max_attempts:
            blocked[i] = True
        elif ok:
            start, failures = None, 0
        else:
            start, failures = (int(now) if start is None else start), failures + 1
    return blocked, start, failures


def limit_attempts(attempts: DataFrame, config: MonitorConfig = MonitorConfig(), watermark: str = "10 minutes") -> DataFrame:
    """(attempt_id, key, blocked) for a stream of attempt_id bigint, ts timestamp, key string, success boolean."""

    def step(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        start, failures = state.get if state.exists else (-1, 0)
        rows = pd.concat(list(batches)).sort_values(["micros", "attempt_id"], kind="stable")
        blocked, left, failures = decide(
            rows["micros"].to_numpy(), rows["success"].to_numpy(), None if start < 0 else start, failures, config
        )
        state.update((-1 if left is None else left, failures))
        if left is not None:
            # An event-time timeout may not lie before the watermark.
            ends = left // 1000 + config.login_window_seconds * 1000
            state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"attempt_id": rows["attempt_id"], "key": key[0], "blocked": blocked})

    timed = attempts.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return (
        timed.withColumn("micros", F.unix_micros("ts"))
        .groupBy("key")
        .applyInPandasWithState(
            step, "attempt_id bigint, key string, blocked boolean", "start bigint, failures int", "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
