"""Drift of production feature values against each model version's own training data.

Everything works on value counts in long form, one row per (keys, feature, value), so all features
and all model versions are one plan: numeric features by the two-sample Kolmogorov-Smirnov distance
of exact empirical distributions, categorical ones by the population stability index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.functions import stats
from tabwatch.operators.ordered import global_cumsum, newest_per_group
from tabwatch.operators.reference import ABOVE, KEY, Reference, all_absent, content_key, ensure, lazy, temporary, with_bucket
from tabwatch.schema import WINDOW_SECONDS, DatasetContract, MonitorConfig

NO_VALUES_NOTE = "no usable values for this feature on one side of the comparison"  # fixed value


def _long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], value: type | str) -> DataFrame:
    """(ids, feature, value) rows, one per listed column.

    An exploded array of structs rather than UNPIVOT: UNPIVOT re-uses the id attributes, which keeps
    Spark from recognising the second use of the same counts and sharing their shuffle.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(value).alias("value")) for c in columns])
    return df.select(*ids, F.explode(entries).alias("_e")).select(*ids, "_e.feature", "_e.value")


def numeric_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str], name: str) -> DataFrame:
    """Counts per (keys, feature, numeric value); null and NaN values are not usable."""
    rows = _long(df, keys, columns, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    return rows.groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias(name))


def categorical_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str], name: str) -> DataFrame:
    """Counts per (keys, feature, category); only null is dropped, an empty text is a category."""
    rows = _long(df, keys, columns, "string").where(F.col("value").isNotNull())
    return rows.groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias(name))


def both_sides(reference: DataFrame, production: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer combination of both count tables, as a union that is summed once."""
    group = [*keys, "feature", "value"]
    sides = reference.select(*group, "ref_n", F.lit(0).cast("bigint").alias("prod_n")).unionByName(
        production.select(*group, F.lit(0).cast("bigint").alias("ref_n"), "prod_n")
    )
    return sides.groupBy(*group).agg(F.sum("ref_n").alias("ref_n"), F.sum("prod_n").alias("prod_n"))


def proportions(counts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Share of each category within its (keys, feature)."""
    group = [*keys, "feature"]
    counts = counts.where(F.col(name) > 0)
    totals = counts.groupBy(*group).agg(F.sum(name).alias("_total"))
    return counts.join(totals, group).withColumn("proportion", F.col(name) / F.col("_total")).drop("_total")


def compared(reference: Reference, production: DataFrame, keys: Sequence[str], totals: DataFrame, config: MonitorConfig) -> DataFrame:
    """(keys, feature, reference_n, production_n, score) for every row of `totals` (by, keys, feature, production_n).

    `production` has counts (by, keys, feature, num, cat, n). A reference is never copied for the groups that share it:
    both empirical distribution functions are steps, so their largest gap lies at a production value or just before one,
    and it is enough to look up the reference there. Rows of both sides meet in the buckets of the reference, ordered
    by value; what a bucket says about the gap up to a constant, and what its categories add to the index, is added up
    over the buckets of a group. Values outside the range of the reference need no order: the gap is widest at its ends.
    """
    by, keys = list(reference.by), list(keys)
    group = list(dict.fromkeys([*by, *keys]))
    on = [c for c in (*group, "feature") if c in production.columns]  # the totals bring the reference of a group
    named = lambda columns: ", ".join(f"`{c}`" for c in columns)
    place, floor = [*by, "feature", "bucket"], f"{config.psi_floor!r}D"
    bounds = reference.summary.selectExpr(*by, "feature", "edges", "before", "total", f"{all_absent(config.psi_floor)} AS _absent")
    # The condition names the count, so that it stays behind the grouping and all uses of the counts share its shuffle.
    rows = production.where("CASE WHEN n > 0 THEN num IS NOT NULL OR cat IS NOT NULL END").join(totals, on).join(bounds, [*by, "feature"])
    rows = with_bucket(rows).selectExpr(
        *group, "feature", "bucket", "num", "cat", "n", "total", "production_n", "_absent", "1 AS _side",
        f"CASE WHEN bucket < 0 THEN 0 WHEN bucket >= {ABOVE} THEN total ELSE get(before, bucket) END AS _before",
    )
    ref = reference.values.where("num IS NOT NULL OR cat IS NOT NULL").selectExpr(
        *by, "feature", "bucket", "num", "cat", "struct(num, cat, n, run) AS _ref", "0 AS _side"
    )
    share, p = "(_same / total)", "(n / production_n)"
    floored = lambda x: f"(CASE WHEN {x} > 0 THEN {x} ELSE {floor} END)"
    there = f"({floored(p)} - {floored(share)}) * ln({floored(p)} / {floored(share)})"
    gone = f"CASE WHEN _same > 0 THEN ({floor} - {share}) * ln({floor} / {share}) ELSE 0D END"
    parts = (
        rows.unionByName(ref, allowMissingColumns=True)
        .selectExpr("*", f"last(_ref, true) OVER (PARTITION BY {named(place)} ORDER BY num, cat, _side ROWS UNBOUNDED PRECEDING) AS _seen")
        .where("_side = 1")
        .selectExpr(
            "*", "coalesce(_before + coalesce(_seen.run, 0), 0) AS _ref_at",
            "CASE WHEN _seen IS NOT NULL AND _seen.num <=> num AND _seen.cat <=> cat THEN _seen.n ELSE 0 END AS _same",
            f"sum(n) OVER (PARTITION BY {named(dict.fromkeys([*place, *keys]))} ORDER BY num ROWS UNBOUNDED PRECEDING) AS _prod",
        )
        .selectExpr(
            *group, "feature", "bucket", "n", "total", "production_n", "_absent",
            "CASE WHEN num IS NOT NULL THEN _ref_at / total - _prod / production_n END AS _at",
            "CASE WHEN num IS NOT NULL THEN (_ref_at - _same) / total - (_prod - n) / production_n END AS _just_before",
            f"CASE WHEN num IS NULL THEN {there} - {gone} END AS _term",
        )
        .groupBy(*dict.fromkeys([*place, *keys]))
        .agg(
            F.expr("max(greatest(_at, _just_before))").alias("_high"), F.expr("min(least(_at, _just_before))").alias("_low"),
            *[F.expr(f"{f}({c})").alias(c) for c, f in (("n", "sum"), ("_term", "sum"), ("total", "first"), ("production_n", "first"), ("_absent", "first"))],
        )
    )
    return (
        parts.unionByName(totals.selectExpr(*group, "feature", "production_n"), allowMissingColumns=True)
        .selectExpr(
            "*", f"coalesce(sum(n) OVER (PARTITION BY {named([*group, 'feature'])} ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
            " / production_n AS _off",
        )
        .groupBy(*group, "feature")
        .agg(
            F.expr("max(total)").alias("reference_n"), F.expr("max(production_n)").alias("production_n"),
            F.expr("coalesce(max(greatest(abs(_high - _off), abs(_low - _off))), max(_absent) + sum(_term))").alias("score"),
        )
    )


def _totals(production: DataFrame, group: Sequence[str]) -> DataFrame:
    """Usable values of each (group, feature)."""
    usable = F.when(F.col("num").isNotNull() | F.col("cat").isNotNull(), F.col("n"))
    return production.groupBy(*group, "feature").agg(F.sum(usable).alias("production_n"))


def _as_counts(counts: DataFrame, keys: Sequence[str], value: str, n: str) -> DataFrame:
    other, kind = ("cat", "string") if value == "num" else ("num", "double")
    return counts.where(F.col(n) > 0).select(*keys, "feature", F.col("value").alias(value), F.lit(None).cast(kind).alias(other), F.col(n).alias("n"))


def _whole(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(keys)) if keys else (df.withColumn("_all", F.lit(0)), ["_all"])


def ks_against_reference(reference: DataFrame, production: DataFrame, ref_keys: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(ref_keys, keys, feature, reference_n, production_n, score, p_value) from two numeric count tables.

    `reference` counts are per (ref_keys, feature, value); `production` counts per (ref_keys, keys, feature, value).
    Only groups of production have a row; its score is null when the reference has no usable value.
    """
    ref, by = _whole(_as_counts(reference, ref_keys, "num", "ref_n"), ref_keys)
    prod, _ = _whole(_as_counts(production, [*ref_keys, *keys], "num", "prod_n"), ref_keys)
    found = compared(lazy(ref, by), prod, keys, _totals(prod, [*by, *keys]), MonitorConfig())
    p = F.when(F.col("score").isNotNull(), stats.ks_pvalue(F.col("score"), F.col("reference_n"), F.col("production_n")))
    return found.select(*ref_keys, *keys, "feature", "reference_n", "production_n", "score", p.alias("p_value"))


def ks_by_feature(reference: DataFrame, production: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, feature, reference_n, production_n, score, p_value) from two numeric count tables.

    The score is null when one side has no usable value.
    """
    group = [*keys, "feature"]
    both = both_sides(reference, production, keys)
    run = global_cumsum(both, group, "value", ["ref_n", "prod_n"], strata=["feature"])
    gap = F.abs(
        F.try_divide(F.col("cum_ref_n").cast("double"), F.col("total_ref_n").cast("double"))
        - F.try_divide(F.col("cum_prod_n").cast("double"), F.col("total_prod_n").cast("double"))
    )
    return (
        run.groupBy(*group)
        .agg(
            F.first("total_ref_n").alias("reference_n"),
            F.first("total_prod_n").alias("production_n"),
            F.max(gap).alias("score"),
        )
        .withColumn("p_value", stats.ks_pvalue(F.col("score"), F.col("reference_n"), F.col("production_n")))
    )


def psi_against_reference(
    reference: DataFrame,
    production: DataFrame,
    ref_keys: Sequence[str] = (),
    keys: Sequence[str] = (),
    config: MonitorConfig = MonitorConfig(),
) -> DataFrame:
    """(ref_keys, keys, feature, reference_n, production_n, score) from categorical count tables.

    The sum runs over the categories of both sides. The part of categories absent from production is
    the same for every production group of a reference up to the categories that group does have, so:
    sum over the reference as if all were absent, plus a correction per category that is present.
    """
    ref_keys, keys = list(ref_keys), list(keys)
    by_ref, by_group = [*ref_keys, "feature"], [*ref_keys, *keys, "feature"]
    share = F.col("ref_n") / F.col("reference_n").cast("double")
    absent = stats.psi_term(share, F.lit(0.0), config.psi_floor)
    ref_total = reference.groupBy(*by_ref).agg(F.sum("ref_n").alias("reference_n"))
    ref = reference.join(ref_total, by_ref).withColumn("_share", share).withColumn("_absent", absent)
    base = ref.groupBy(*by_ref).agg(F.first("reference_n").alias("reference_n"), F.sum("_absent").alias("_base"))
    prod_total = production.groupBy(*by_group).agg(F.sum("prod_n").alias("production_n"))
    prod_share = F.col("prod_n") / F.col("production_n").cast("double")
    correction = stats.psi_term(F.coalesce("_share", F.lit(0.0)), prod_share, config.psi_floor) - F.coalesce(
        "_absent", F.lit(0.0)
    )
    present = (
        production.join(prod_total, by_group)
        .join(ref.select(*by_ref, "value", "_share", "_absent"), [*by_ref, "value"], "left")
        .groupBy(*by_group)
        .agg(F.first("production_n").alias("production_n"), F.sum(correction).alias("_correction"))
    )
    return present.join(base, by_ref, "left").select(
        *by_group,
        F.coalesce("reference_n", F.lit(0)).cast("bigint").alias("reference_n"),
        "production_n",
        (F.col("_base") + F.col("_correction")).alias("score"),
    )


ROWS = "__rows__"


def feature_counts(
    df: DataFrame, contract: DatasetContract, keys: Sequence[str] = (), features: Sequence[str] | None = None
) -> DataFrame:
    """(keys, feature, num, cat, n): counts of every feature's values from one scan and one shuffle.

    `num` holds numeric values (null and NaN are not usable), `cat` categories (only null is dropped
    later, an empty text is a category). The pseudo-feature ROWS counts the rows themselves. Store
    this table once per model version for the reference side.
    """
    wanted = list(contract.features) if features is None else list(features)
    contract.check_features(wanted)

    def entry(name: str, num: Column | None, cat: Column | None) -> Column:
        return F.struct(
            F.lit(name).alias("feature"),
            (F.lit(None) if num is None else num).cast("double").alias("num"),
            (F.lit(None) if cat is None else cat).cast("string").alias("cat"),
        )

    entries = [entry(ROWS, None, None)]
    for c in wanted:
        col = F.col(f"`{c}`")
        if c in contract.numeric_columns:
            value = col.cast("double")
            entries.append(entry(c, F.when(~F.isnan(value), value), None))
        else:
            entries.append(entry(c, None, col))
    long = df.select(*keys, F.explode(F.array(*entries)).alias("_e")).select(*keys, "_e.feature", "_e.num", "_e.cat")
    return long.groupBy(*keys, "feature", "num", "cat").agg(F.count(F.lit(1)).alias("n"))


def row_counts(counts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    # The condition names the count, so that it stays behind the grouping: all uses then read the same shuffle.
    return counts.where(F.when(F.col("n") > 0, F.col("feature")) == ROWS).select(*keys, F.col("n").alias(name))


def feature_results(
    reference: Reference,
    production: DataFrame,
    contract: DatasetContract,
    *,
    keys: Sequence[str] = (),
    groups: DataFrame,
    features: Sequence[str] | None = None,
    config: MonitorConfig = MonitorConfig(),
) -> DataFrame:
    """One result row per (keys, feature) of `groups` (the reference's keys, and `keys`).

    `production` is `feature_counts` keyed by `keys`. A feature without a usable value on one side still gets its row,
    with a note in place of the score.
    """
    keys, by = list(keys), list(reference.by)
    group = list(dict.fromkeys([*by, *keys]))
    wanted = list(contract.features) if features is None else list(features)
    contract.check_features(wanted)
    asked = groups.select(*group, F.explode(F.array(*[F.lit(c) for c in wanted])).alias("feature"))
    counted = production.where(F.when(F.col("n") > 0, F.col("feature")) != ROWS)
    totals = asked.join(_totals(counted, keys), [*keys, "feature"], "left")
    found = compared(reference, counted, keys, totals, config)
    numeric = ", ".join(f"'{c}'" for c in contract.numeric_columns) or "NULL"
    pvalue = stats.ks_pvalue(F.col("score"), F.col("reference_n"), F.col("production_n"))
    banded = (
        found.withColumns({"_ks": F.expr(f"coalesce(feature IN ({numeric}), false)"), "_p": pvalue, "_band": stats.severity(F.col("score"), config)})
        .selectExpr("*", f"CASE WHEN _ks THEN {config.ks_threshold!r}D ELSE {config.psi_warning!r}D END AS threshold")
    )
    return banded.selectExpr(
        *group,
        "feature",
        "CASE WHEN _ks THEN 'KS' ELSE 'PSI' END AS test",
        "score",
        "CASE WHEN _ks AND score IS NOT NULL THEN _p END AS p_value",
        "threshold",
        f"CASE WHEN NOT _ks THEN {config.psi_critical!r}D END AS critical_threshold",
        "CASE WHEN NOT _ks THEN _band END AS severity",
        "coalesce(score >= threshold, false) AS drift_detected",
        *[f"CASE WHEN score IS NOT NULL THEN {n} END AS {n}" for n in ("reference_n", "production_n")],
        f"CASE WHEN score IS NULL THEN '{NO_VALUES_NOTE}' END AS note",
    )


def references(versions: DataFrame, training_rows: DataFrame, contract: DatasetContract, path: str | None) -> tuple[Reference, DataFrame]:
    """The references of all versions, and the versions with their ref_key.

    They are kept below `path` under the versions' content_hash, so a later report reads no training rows. Without a
    path they are made for this report, by dataset_id.
    """
    ref = "dataset_id"
    if path is None:
        keyed = versions.withColumn(KEY, content_key(F.col(ref), contract))
        rows = training_rows.join(keyed.select(ref, KEY).distinct(), ref)
        return temporary(feature_counts(rows, contract, [KEY]), [KEY]), keyed
    keyed = versions.withColumn(KEY, content_key(F.col("content_hash"), contract))
    return ensure(path, keyed, training_rows, lambda rows, by: feature_counts(rows, contract, by)), keyed


def displayed(results: DataFrame) -> DataFrame:
    """Final projection for people: four decimals (half-up) and the status text. Never compare on these."""
    return results.select(
        *[c for c in results.columns if c not in ("score", "p_value")],
        F.round("score", 4).alias("score"),
        F.round("p_value", 4).alias("p_value"),
        stats.display_status(F.col("score"), F.col("drift_detected"), F.col("severity")).alias("status_text"),
        F.when(
            F.col("score").isNotNull(),
            F.when(F.col("threshold") > 0, F.col("score") / F.col("threshold")).otherwise(0.0),
        ).alias("score_to_threshold"),
    )


def within_window(predictions: DataFrame, window: str | None, as_of: Column, ts: str = "created_at") -> DataFrame:
    """Rows not older than a preset, seen from `as_of`; None keeps all rows."""
    if window is None:
        return predictions
    if window not in WINDOW_SECONDS:
        raise ValueError(f"Unknown window {window!r}. Valid: {sorted(WINDOW_SECONDS)}")
    return predictions.where(F.col(ts) >= as_of - F.expr(f"INTERVAL {WINDOW_SECONDS[window]} SECOND"))


def newest_sample(predictions: DataFrame, config: MonitorConfig, key: str = "model_version_id") -> DataFrame:
    """Optional newest-N cut per version; by default every row is used."""
    if config.max_sample is None:
        return predictions
    return newest_per_group(
        predictions, [key], [F.col("created_at").desc(), F.col("id")], config.max_sample, salt_by="id"
    )


def with_status(versions: DataFrame, sizes: DataFrame, config: MonitorConfig = MonitorConfig(), key: str = "model_version_id") -> DataFrame:
    """Versions with their filtered prediction count and `ok` / `insufficient_data` status.

    `sizes` (key, sample_size) counts the whole filtered log, before any newest-N cut.
    """
    size = F.coalesce("sample_size", F.lit(0)).cast("bigint")
    return versions.join(sizes, key, "left").select(
        *versions.columns,
        size.alias("sample_size"),
        F.lit(config.min_samples).alias("minimum_required"),
        F.when(size < config.min_samples, "insufficient_data").otherwise("ok").alias("status"),
    )


def drift_report(
    versions: DataFrame,
    training_rows: DataFrame,
    predictions: DataFrame,
    contract: DatasetContract,
    *,
    as_of: Column,
    window: str | None = None,
    features: Sequence[str] | None = None,
    config: MonitorConfig = MonitorConfig(),
    kept: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(header, features) for every version of `versions` in one run.

    `versions` has model_version_id, version_label, dataset_id, training_job_id; `training_rows` has
    dataset_id and typed features; `predictions` has id, model_version_id, created_at and features.
    Versions below the sample gate appear in the header only. The header carries the lineage of the
    reference: its dataset, training job and row count. With a folder for `kept` the reference counts of datasets stay
    there under their content_hash, and reports that follow read no training rows.
    """
    key = "model_version_id"
    recent = within_window(predictions, window, as_of)
    # The log is read once, without joining its rows: the gate and the reference are applied to counts.
    production = feature_counts(newest_sample(recent, config), contract, [key], features)
    if config.max_sample is None:
        sizes = row_counts(production, [key], "sample_size")
    else:
        sizes = recent.groupBy(key).agg(F.count(F.lit(1)).alias("sample_size"))
    reference, keyed = references(versions, training_rows, contract, kept)
    header = with_status(keyed, sizes, config)
    passed = header.where(F.col("status") == "ok").select(KEY, key)
    results = feature_results(reference, production, contract, keys=[key], groups=passed, features=features, config=config).drop(KEY)
    ref_rows = reference.summary.where(F.col("feature") == ROWS).select(KEY, F.col("total").alias("reference_n_rows"))
    flags = results.groupBy(key).agg(F.bool_or("drift_detected").alias("drift_detected"))
    cap = F.col("sample_size") if config.max_sample is None else F.least("sample_size", F.lit(config.max_sample))
    header = (
        header.join(ref_rows, KEY, "left")
        .join(flags, key, "left")
        .drop(KEY)
        .withColumn("window", F.lit(window).cast("string"))
        .withColumn("n_sampled_for_computation", F.when(F.col("status") == "ok", cap))
        .withColumn("reference_n_rows", F.when(F.col("status") == "ok", F.col("reference_n_rows")))
    )
    return header, results


def version_drift(
    versions: DataFrame, training_rows: DataFrame, predictions: DataFrame, contract: DatasetContract, *,
    model_version_id: str | None = None, **options,
) -> tuple[DataFrame, DataFrame]:
    """drift_report of one version: the one asked for, or the one in production.

    `versions` is as for drift_report, with the stage. If there is no such version the header is one row whose status
    is `no_production_model` or `unknown_version`, and there are no results.
    """
    key = "model_version_id"
    asked = F.col("stage") == "production" if model_version_id is None else F.col(key) == model_version_id
    chosen = versions.where(asked)
    header, results = drift_report(chosen, training_rows, predictions, contract, **options)
    status = "no_production_model" if model_version_id is None else "unknown_version"
    nothing = chosen.agg(F.count(F.lit(1)).alias("_n")).where("_n = 0").select(
        F.lit(model_version_id).cast("string").alias(key), F.lit(status).alias("status")
    )
    return header.unionByName(nothing, allowMissingColumns=True), results


def age_class(ts: Column, as_of: Column) -> Column:
    """0, 1, 2 for the shortest preset window that holds the row, 3 beyond all of them."""
    out = F.lit(len(WINDOW_SECONDS))
    for i, seconds in reversed(list(enumerate(WINDOW_SECONDS.values()))):
        out = F.when(ts >= as_of - F.expr(f"INTERVAL {seconds} SECOND"), i).otherwise(out)
    return out


def _holding(age: Column) -> Column:
    """Names of the windows that hold a row of an age class: its own and all longer ones."""
    names = [*WINDOW_SECONDS, "all"]
    return F.slice(F.array(*[F.lit(n) for n in names]), age + 1, F.lit(len(names)))


def window_sizes(predictions: DataFrame, as_of: Column, key: str = "model_version_id") -> DataFrame:
    """(key, n, window): predictions in each preset window and in all, from one pass: each is counted under the shortest
    window that holds it, and the counts are spread over the longer ones."""
    aged = predictions.groupBy(key, age_class(F.col("created_at"), as_of).alias("_age")).agg(F.count(F.lit(1)).alias("_n"))
    spread = aged.select(key, "_n", F.explode(_holding(F.col("_age"))).alias("window"))
    return spread.groupBy(key, "window").agg(F.sum("_n").alias("n")).select(key, "n", "window")


def drift_by_window(
    versions: DataFrame,
    training_rows: DataFrame,
    predictions: DataFrame,
    contract: DatasetContract,
    *,
    as_of: Column,
    config: MonitorConfig = MonitorConfig(),
    kept: str | None = None,
) -> DataFrame:
    """Feature results for every (version, window preset and all time) from one pass over the log.

    Presets nest, so each prediction is counted once under the shortest window holding it; only the
    counts are then spread over that window and the longer ones. `versions` maps model_version_id to
    dataset_id.
    """
    key = "model_version_id"
    aged = predictions.withColumn("_age", age_class(F.col("created_at"), as_of))
    production = (
        feature_counts(aged, contract, [key, "_age"])
        .withColumn("window", F.explode(_holding(F.col("_age"))))
        .groupBy(key, "window", "feature", "num", "cat")
        .agg(F.sum("n").alias("n"))
    )
    reference, keyed = references(versions, training_rows, contract, kept)
    sizes = row_counts(production, [key, "window"], "sample_size").where(F.col("sample_size") >= config.min_samples)
    groups = sizes.join(keyed.select(key, KEY), key).select(KEY, key, "window")
    return feature_results(reference, production, contract, keys=[key, "window"], groups=groups, config=config).drop(KEY)
