"""Life of training and scoring jobs: queued, running, then completed or failed.

What a job has done is read from what it left behind (registered candidates, rows of the prediction log), so any number
of jobs is advanced by a few joins, and a job that was cut short goes on with what is missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.text import error_text
from tabwatch.operators.features import FeatureSpec
from tabwatch.plans import train
from tabwatch.schema import ALGORITHMS, TrainingConfig
from tabwatch.sources.files import integrity_errors

OPEN = ("queued", "running")


def training_steps(jobs: DataFrame, datasets: DataFrame, hashes: DataFrame, candidates: DataFrame) -> DataFrame:
    """Open training jobs (id, dataset_id, error, todo): why each must fail, else the algorithms it has still to train.

    `hashes` is storage_path and sha256 of what is stored now; `candidates` has training_job_id and algorithm.
    A job names its algorithms in the payload, or trains all.
    """
    wanted = F.coalesce(F.from_json("payload", "algorithms array<string>").algorithms, F.array(*map(F.lit, ALGORITHMS)))
    open_jobs = jobs.where((F.col("job_type") == "train") & F.col("status").isin(*OPEN)).select("id", "dataset_id", wanted.alias("_wanted"))
    made = candidates.groupBy(F.col("training_job_id").alias("_job")).agg(F.collect_set("algorithm").alias("_made"))
    todo = F.array_except("_wanted", F.coalesce("_made", F.array().cast("array<string>")))
    checked = integrity_errors(open_jobs, datasets, hashes)
    return checked.join(made, F.col("id") == F.col("_job"), "left").select("id", "dataset_id", "error", todo.alias("todo"))


def _running(jobs: DataFrame, as_of: Column) -> DataFrame:
    changed = {"status": F.lit("running"), "started_at": F.coalesce("started_at", as_of.cast(jobs.schema["started_at"].dataType))}
    return jobs.select(*[changed[c].alias(c) if c in changed else c for c in jobs.columns])


def advance_training(jobs: DataFrame, steps: DataFrame, candidates: DataFrame, as_of: Column) -> DataFrame:
    """All job rows after `steps`: failed with their partial candidates, completed with the best, or running.

    Jobs without a step stay as they are. `candidates` has id, algorithm, metrics, ordinal and training_job_id.
    """
    columns, moment = jobs.columns, as_of.cast(jobs.schema["finished_at"].dataType)
    known = jobs.join(steps.select("id", F.col("error").alias("_error"), "todo"), "id", "left").select(*columns, "_error", "todo")
    settled = known.where("todo IS NULL").select(*columns)
    running = _running(known.where("todo IS NOT NULL"), moment)
    own = candidates.join(running.select(F.col("id").alias("training_job_id")), "training_job_id", "left_semi")
    failed = train.failed_job(running.where("_error IS NOT NULL"), own, F.col("_error"), moment).select(*columns)
    completed = train.finished_job(running.where("_error IS NULL AND size(todo) = 0"), own, moment).select(*columns)
    waiting = running.where("_error IS NULL AND size(todo) > 0").select(*columns)
    return settled.unionByName(failed).unionByName(completed).unionByName(waiting)


def advance_scoring(jobs: DataFrame, versions: DataFrame, log: DataFrame, as_of: Column) -> DataFrame:
    """All job rows after scoring: an open batch job is completed once the log holds all of its records, and fails if
    its pinned version is gone; others stay open.

    The result holds the number of predictions; their ids, which have no bound, are rows (`scoring.batch_result`).
    """
    columns, moment = jobs.columns, as_of.cast(jobs.schema["finished_at"].dataType)
    payload = F.from_json("payload", "model_version_id string, records array<string>")
    is_open = (F.col("job_type") == "batch_predict") & F.col("status").isin(*OPEN)
    pinned = jobs.where(is_open).withColumn("_p", payload).withColumn("_version", F.col("_p.model_version_id")).withColumn("_size", F.size("_p.records"))
    known = versions.select(F.col("id").alias("_known")).distinct()
    done = log.groupBy(F.col("request_id").alias("_request")).agg(F.count(F.lit(1)).alias("_n"))
    found = _running(pinned, moment).join(known, F.col("_version") == F.col("_known"), "left").join(done, F.col("id") == F.col("_request"), "left")
    n = F.coalesce("_n", F.lit(0))  # a batch without records has no rows in the log
    gone, ready = F.col("_known").isNull(), n >= F.coalesce("_size", F.lit(0))
    message = F.concat(F.lit("Pinned model version "), F.coalesce("_version", F.lit("None")), F.lit(" no longer exists."))  # fixed value
    changed = {
        "status": F.when(gone, "failed").when(ready, "completed").otherwise(F.col("status")),
        "result": F.when(~gone & ready, F.to_json(F.struct(n.alias("n_processed")))),
        "error_message": F.when(gone, error_text(message)),
        "finished_at": F.when(gone | ready, moment),
    }
    return jobs.where(~is_open).unionByName(found.select(*[changed[c].alias(c) if c in changed else c for c in columns]))


def run_training_job(
    job: DataFrame,
    raw: DataFrame,
    versions: DataFrame,
    candidates: DataFrame,
    spec: FeatureSpec,
    config: TrainingConfig,
    *,
    datasets: DataFrame,
    hashes: DataFrame,
    root: str,
    as_of: Column,
    key: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the job row afterwards, the registry, all candidates): one open job run to its end.

    The dataset is checked first. Algorithms are trained and registered one by one, those that `candidates` already
    holds for the job are left out, and an error ends the job as failed with what had been registered. Candidates
    have at least id, algorithm, training_job_id, ordinal and metrics (`METRICS`).
    """
    spark = job.sparkSession
    step = training_steps(job, datasets, hashes, candidates).head()
    if step is None:
        return job, versions, candidates
    error = step["error"]
    used = datasets.where(F.col("id") == step["dataset_id"]).head() if error is None else None
    for ordinal, algorithm in enumerate(step["todo"] if error is None else []):
        try:
            versions, _, made = train.train_and_register(
                raw, versions, spec, config, root=root, dataset_id=used["id"], content_hash=used["content_hash"], filename=used["filename"],
                as_of=as_of, algorithms=[algorithm], job_id=step["id"], key=key,
            )
        except Exception as problem:  # noqa: BLE001 - whatever stops a job is recorded with it
            error = str(problem)
            break
        rank = F.lit(len(ALGORITHMS) + ordinal)  # after those of an earlier run
        candidates = candidates.unionByName(made.select(*[rank.alias(c) if c == "ordinal" else c for c in candidates.columns]))
    left = spark.createDataFrame([(step["id"], error, [])], "id string, error string, todo array<string>")
    return advance_training(job, left, candidates, as_of), versions, candidates
