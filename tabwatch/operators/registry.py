"""Model registry as tables: registration, promotion policy, promotion, rollback and audit.

Transitions are pure: registry in, new registry and new lifecycle events out. They are projections
of the registry table, without joins or shuffles. Publishing the result is a separate step
(`sources.tables.publish`) done by a single writer after `violations` has come back empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwatch.schema import MonitorConfig


class InvalidTransition(ValueError):
    """The requested promotion or rollback is not allowed in the current state."""


class ConflictingState(RuntimeError):
    """The registry breaks one of its invariants."""


# The rules that promotion and rollback rely on.
ONE_EACH = ("one_production", "one_previous")


def _stage(name: str) -> Column:
    return F.col("stage") == name


def _events(
    rows: DataFrame, action: str, previous: str | None, new: str, by: str, as_of: Column, seq: int, reason: Column | None = None
) -> DataFrame:
    nothing = F.array().cast("array<string>")
    metadata = F.create_map(F.lit("reason"), reason) if reason is not None else F.map_from_arrays(nothing, nothing)
    return rows.select(
        F.col("id").alias("model_version_id"),
        F.lit(action).alias("action"),
        F.lit(previous).cast("string").alias("previous_stage"),
        F.lit(new).alias("new_stage"),
        F.lit(by).alias("triggered_by"),
        metadata.cast("map<string,string>").alias("event_metadata"),
        as_of.alias("created_at"),
        F.lit(seq).alias("seq"),
    )


def register(versions: DataFrame, candidates: DataFrame, *, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """(registry with the candidates appended, `registered` events).

    Labels continue the registry's count. `candidates` is what one training job produced, a few rows
    with an `ordinal`, so numbering them needs no partitioning. A run that is registered already is refused.
    """
    again = versions.join(candidates.select("mlflow_run_id"), "mlflow_run_id", "left_semi").select("mlflow_run_id").head(1)
    if again:
        raise ConflictingState(f"unique_run_id: {again[0][0]} is registered already")
    known = versions.agg(F.count(F.lit(1))).scalar()
    numbered = candidates.withColumn("_rn", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("ordinal", "id")))
    new = numbered.select(
        *[F.col(c) for c in candidates.columns if c != "ordinal"],
        F.concat(F.lit("v"), (known + F.col("_rn")).cast("string")).alias("version_label"),
        F.lit("candidate").alias("stage"),
        as_of.alias("created_at"),
        F.lit(None).cast(versions.schema["promoted_at"].dataType).alias("promoted_at"),
    )
    events = _events(new, "registered", None, "candidate", "system", as_of, 0)
    return versions.unionByName(new.select(*versions.columns)), events


def promotion_policy(
    versions: DataFrame, datasets: DataFrame, verified_runs: DataFrame | None = None, config: MonitorConfig = MonitorConfig()
) -> DataFrame:
    """Every version with `eligible` and the first rule it fails as `reason`.

    `verified_runs` lists the run ids whose artifact was found; without it no artifact counts as
    verified, so a broken probe blocks promotion.
    """
    known = datasets.select(F.col("id").alias("dataset_id"), F.col("is_valid").alias("_valid"))
    out = versions.join(known, "dataset_id", "left")
    if verified_runs is None:
        out = out.withColumn("_verified", F.lit(False))
    else:
        runs = verified_runs.select(F.col("run_id").alias("mlflow_run_id")).distinct().withColumn("_verified", F.lit(True))
        out = out.join(runs, "mlflow_run_id", "left")
    # Texts of the refusals.
    missing = F.filter(
        F.array(*[F.when(F.col(f"metrics.{m}").isNull(), F.lit(f"'{m}'")) for m in config.required_metrics]),
        lambda m: m.isNotNull(),
    )
    reason = (
        F.when(~_stage("candidate"), F.concat(
            F.lit("Model version "), F.col("id"), F.lit(" is not a candidate (current stage: "), F.col("stage"),
            F.lit("); only candidates can be promoted."),
        ))
        .when(F.col("dataset_id").isNull(), "Candidate has no linked training dataset.")
        .when(~F.coalesce("_valid", F.lit(False)), "Candidate's training dataset is missing or failed validation.")
        .when(F.size(missing) > 0, F.concat(
            F.lit("Candidate is missing required evaluation metric(s): ["), F.array_join(missing, ", "), F.lit("]."),
        ))
    )
    if config.require_artifact:
        reason = reason.when(~F.coalesce("_verified", F.lit(False)), F.concat(
            F.lit("Candidate's MLflow artifact could not be verified for run "), F.col("mlflow_run_id"),
            F.lit("; refusing to promote an unverifiable model."),
        ))
    return out.withColumn("reason", reason).select(*versions.columns, F.col("reason").isNull().alias("eligible"), "reason")


def violations(versions: DataFrame) -> DataFrame:
    """(rule, value, n) rows that break: one production, one previous, unique run ids."""
    exclusive = (
        versions.where(F.col("stage").isin("production", "previous"))
        .groupBy(F.concat(F.lit("one_"), F.col("stage")).alias("rule"), F.col("stage").alias("value"))
    )
    runs = versions.groupBy(F.lit("unique_run_id").alias("rule"), F.col("mlflow_run_id").alias("value"))
    return (
        exclusive.agg(F.count(F.lit(1)).alias("n"))
        .unionByName(runs.agg(F.count(F.lit(1)).alias("n")))
        .where(F.col("n") > 1)
    )


def require_consistent(versions: DataFrame, *rules: str) -> None:
    """Raises when the registry breaks an invariant (one of `rules`, if given); looks at one offending row at most."""
    found = violations(versions)
    broken = (found.where(F.col("rule").isin(*rules)) if rules else found).head(1)
    if broken:
        raise ConflictingState(f"{broken[0]['rule']}: {broken[0]['value']} occurs {broken[0]['n']} times")


def promote(
    versions: DataFrame, candidate_id: str, policy: DataFrame, *, as_of: Column, triggered_by: str = "api"
) -> tuple[DataFrame, DataFrame]:
    """Candidate to production, production to previous, previous to archived; events in the order
    archived, demoted, promoted. `policy` is the outcome of `promotion_policy`."""
    require_consistent(versions, *ONE_EACH)
    verdict = policy.where(F.col("id") == candidate_id).select("eligible", "reason").head(1)
    if not verdict:
        raise LookupError(f"Model version {candidate_id} not found.")
    if not verdict[0]["eligible"]:
        raise InvalidTransition(verdict[0]["reason"])
    chosen = F.col("id") == candidate_id
    stage = (
        F.when(chosen, "production")
        .when(_stage("production"), "previous")
        .when(_stage("previous"), "archived")
        .otherwise(F.col("stage"))
    )
    new = versions.select(
        *[
            stage.alias(c) if c == "stage" else F.when(chosen, as_of).otherwise(F.col(c)).alias(c) if c == "promoted_at" else F.col(c)
            for c in versions.columns
        ]
    )
    # Texts of the reasons and refusals.
    because = F.lit(f"superseded by promotion of {candidate_id}")
    events = (
        _events(versions.where(_stage("previous")), "archived", "previous", "archived", triggered_by, as_of, 1, because)
        .unionByName(_events(versions.where(_stage("production")), "demoted_to_previous", "production", "previous", triggered_by, as_of, 2, because))
        .unionByName(_events(versions.where(chosen), "promoted", "candidate", "production", triggered_by, as_of, 3))
    )
    return new, events


def rollback(versions: DataFrame, *, as_of: Column, triggered_by: str = "api") -> tuple[DataFrame, DataFrame]:
    """Swaps production and previous; one `rolled_back` event for each side that exists."""
    require_consistent(versions, *ONE_EACH)
    previous = versions.where(_stage("previous")).select("id").head(1)
    if not previous:
        raise InvalidTransition("No previous production model is available to roll back to.")  # fixed value
    stage = F.when(_stage("previous"), "production").when(_stage("production"), "previous").otherwise(F.col("stage"))
    new = versions.select(
        *[
            stage.alias(c) if c == "stage"
            else F.when(_stage("previous"), as_of).otherwise(F.col(c)).alias(c) if c == "promoted_at"
            else F.col(c)
            for c in versions.columns
        ]
    )
    because = F.lit(f"rolled back in favor of {previous[0]['id']}")
    events = _events(
        versions.where(_stage("production")), "rolled_back", "production", "previous", triggered_by, as_of, 1, because
    ).unionByName(
        _events(versions.where(_stage("previous")), "rolled_back", "previous", "production", triggered_by, as_of, 2)
    )
    return new, events


def production(versions: DataFrame) -> DataFrame:
    """The version in production, or no row; a registry with several is refused when the row is read."""
    several = F.raise_error(F.lit("one_production: more than one version is in production")).cast("boolean")
    counted = versions.where(_stage("production")).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("stage")))
    return counted.where(F.when(F.col("_n") > 1, several).otherwise(True)).drop("_n")


def event_history(events: DataFrame) -> DataFrame:
    return events.orderBy("model_version_id", "created_at", "seq")


def stages_from_events(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Stage of each version rebuilt from its last event, beside the stored one."""
    last = events.groupBy(F.col("model_version_id").alias("id")).agg(
        F.max_by("new_stage", F.struct("created_at", "seq")).alias("event_stage")
    )
    return versions.select("id", "stage").join(last, "id", "left").withColumn(
        "consistent", F.col("stage").eqNullSafe(F.col("event_stage"))
    )


def metrics_rows(versions: DataFrame, prefix: str = "test") -> DataFrame:
    """(id, metric, value): scalar metrics with a prefix, the confusion matrix flattened."""
    fields = versions.schema["metrics"].dataType.fields
    entries = []
    for field in fields:
        if field.name == "confusion_matrix":
            entries += [(f"{prefix}_{field.name}_{f.name}", F.col(f"metrics.{field.name}.{f.name}")) for f in field.dataType.fields]
        else:
            entries.append((f"{prefix}_{field.name}", F.col(f"metrics.{field.name}")))
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value")) for n, v in entries])
    return versions.select("id", F.explode(pairs).alias("_m")).select("id", "_m.metric", "_m.value").where(F.col("value").isNotNull())


def best_candidates(candidates: DataFrame, job: str = "training_job_id") -> DataFrame:
    """Per training job the candidate with the highest test ROC-AUC; the first trained wins a tie."""
    best = F.max_by(F.struct("id", "algorithm", F.col("metrics.roc_auc").alias("roc_auc")), F.struct("metrics.roc_auc", -F.col("ordinal")))
    return candidates.groupBy(job).agg(best.alias("_b")).select(
        job, F.col("_b.id").alias("best_model_version_id"), F.col("_b.algorithm").alias("best_algorithm"),
        F.col("_b.roc_auc").alias("best_test_roc_auc"),
    )
