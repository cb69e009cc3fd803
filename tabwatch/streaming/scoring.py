"""Scoring of arriving feature rows: stateless, append only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwatch.operators.features import FeatureSpec
from tabwatch.plans.scoring import score, staged


def score_stream(
    records: DataFrame,
    model: PipelineModel,
    spec: FeatureSpec,
    out: str,
    checkpoint: str,
    *,
    model_version_id: str,
    record_key: Sequence[str],
    integers: Sequence[str] = (),
    available_now: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Scores each micro-batch and keeps all of it: predictions, with their latency and in the layout of the batch log,
    below `out`/predictions, refused records with their violations below `out`/rejected.

    The request id of a micro-batch is `stream-` and its number; a replayed one overwrites its own folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        request = f"stream-{batch_id}"
        scored, rejected = score(
            batch, model, spec, model_version_id=model_version_id, request_id=request, record_key=record_key,
            as_of=F.current_timestamp(), integers=integers,
        )
        timed, _ = staged(scored)
        dated = timed.withColumn("dt", F.to_date("created_at"))
        dated.write.mode("overwrite").partitionBy("dt").parquet(f"{out}/predictions/batch_id={batch_id}")
        rejected.withColumn("request_id", F.lit(request)).write.mode("overwrite").parquet(f"{out}/rejected/batch_id={batch_id}")

    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
