"""Replay-safe sinks and readers shared by the streaming jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, directory: str, name: str, *, max_files: int = 100) -> DataFrame:
    """Parquet files called `name` (a glob) in a directory, a bounded number per micro-batch."""
    schema = spark.read.option("pathGlobFilter", name).parquet(directory).schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", max_files).parquet(directory)
    )


def write_batches(
    stream: DataFrame, out: str, checkpoint: str, *, mode: str = "update", shape: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True, interval: str = "1 minute",
) -> StreamingQuery:
    """Writes each micro-batch to its own folder, which a replay of the batch overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shaped = batch if shape is None else shape(batch)
        shaped.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def newest_state(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Current value of every key from the batches of an update-mode aggregation."""
    batches = spark.read.parquet(out)
    values = [c for c in batches.columns if c not in (*keys, "batch_id")]
    return batches.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(*keys, "_v.*")


def current_windows(spark: SparkSession, out: str, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """(window_start, keys, values): every window of an append-mode aggregation with its value so far.

    Closed windows were written once, when the watermark passed them; open ones are read from the query's state, as of
    the last batch committed, so both parts are of one moment also while the query runs. What is read is one row for each
    window and key, however many batches there were. Values must be counts and sums of doubles, whose state is the value.
    """
    last = spark.read.format("state-metadata").load(checkpoint).agg(F.max("maxBatchId")).first()[0]
    closed = spark.read.parquet(out).where(F.col("batch_id") <= last).drop("batch_id")
    values = [c for c in closed.columns if c not in ("window_start", *keys)]
    state = spark.read.format("statestore").option("batchId", int(last)).load(checkpoint)
    if len(state.schema["value"].dataType.names) != len(values):
        raise ValueError("The state of this aggregation is not its value.")
    # the fields of the state are taken by place: two aggregates may have one name there
    names = ", ".join(f"v{i}: {closed.schema[v].dataType.simpleString()}" for i, v in enumerate(values))
    open_windows = state.select("key.*", F.col("value").cast(f"struct<{names}>").alias("_v"))
    named = [F.col("window.start").alias("window_start"), *keys, *[F.col(f"_v.v{i}").alias(v) for i, v in enumerate(values)]]
    return closed.select("window_start", *keys, *values).unionByName(open_windows.select(*named))
