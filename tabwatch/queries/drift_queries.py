"""Drift queries: the log after the cut date against the training rows before it."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.functions import stats
from tabwatch.operators import drift
from tabwatch.queries.tables import AS_OF, PREDICTION_CONTRACT, load, moment, r6, with_tables
from tabwatch.schema import MonitorConfig
from tabwatch.session import shared_dir

CONTRACT = PREDICTION_CONTRACT
_NUMERIC = list(CONTRACT.numeric_columns)
_CATEGORICAL = list(CONTRACT.categorical_columns)


def _ks_sql(keys: str, ref: str, prod: str) -> str:
    """SQL for the KS distance per (keys, feature) of two long tables (keys, feature, value, n)."""
    group = f"{keys}, feature" if keys else "feature"
    return f"""
    ks_counts AS (
      SELECT {group}, value, CAST(SUM(ref_n) AS DOUBLE) AS a, CAST(SUM(prod_n) AS DOUBLE) AS b
      FROM (SELECT {group}, value, 1 AS ref_n, 0 AS prod_n FROM {ref} WHERE value IS NOT NULL
            UNION ALL SELECT {group}, value, 0, 1 FROM {prod} WHERE value IS NOT NULL) u
      GROUP BY {group}, value),
    ks_run AS (
      SELECT {group}, SUM(a) OVER w AS ca, SUM(b) OVER w AS cb,
             SUM(a) OVER (PARTITION BY {group}) AS ta, SUM(b) OVER (PARTITION BY {group}) AS tb
      FROM ks_counts WINDOW w AS (PARTITION BY {group} ORDER BY value ROWS UNBOUNDED PRECEDING)),
    ks AS (
      SELECT {group}, 'KS' AS test, CAST(MAX(ta) AS BIGINT) AS reference_n, CAST(MAX(tb) AS BIGINT) AS production_n,
             CASE WHEN MAX(ta) > 0 AND MAX(tb) > 0 THEN MAX(abs(ca / ta - cb / tb)) END AS score
      FROM ks_run GROUP BY {group})"""


def _psi_sql(keys: str, ref: str, prod: str) -> str:
    group = f"{keys}, feature" if keys else "feature"
    return f"""
    psi_counts AS (
      SELECT {group}, value, CAST(SUM(ref_n) AS DOUBLE) AS a, CAST(SUM(prod_n) AS DOUBLE) AS b
      FROM (SELECT {group}, value, 1 AS ref_n, 0 AS prod_n FROM {ref} WHERE value IS NOT NULL
            UNION ALL SELECT {group}, value, 0, 1 FROM {prod} WHERE value IS NOT NULL) u
      GROUP BY {group}, value),
    psi_share AS (
      SELECT *, SUM(a) OVER (PARTITION BY {group}) AS ta, SUM(b) OVER (PARTITION BY {group}) AS tb FROM psi_counts),
    psi AS (
      SELECT {group}, 'PSI' AS test, CAST(MAX(ta) AS BIGINT) AS reference_n, CAST(MAX(tb) AS BIGINT) AS production_n,
             CASE WHEN MAX(ta) > 0 AND MAX(tb) > 0 THEN
               SUM(((CASE WHEN b > 0 THEN b / tb ELSE 1e-4 END) - (CASE WHEN a > 0 THEN a / ta ELSE 1e-4 END))
                   * ln((CASE WHEN b > 0 THEN b / tb ELSE 1e-4 END) / (CASE WHEN a > 0 THEN a / ta ELSE 1e-4 END))) END AS score
      FROM psi_share GROUP BY {group})"""


def _long_sql(name: str, source: str, ids: str, columns: list[str]) -> str:
    prefix = f"{ids}, " if ids else ""
    parts = [f"SELECT {prefix}'{c}' AS feature, {c} AS value FROM {source}" for c in columns]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


@functools.cache
def _store(app_id: str, sf_dir: str, shared: str) -> str:
    return f"{shared}/references-{uuid.uuid4().hex[:12]}"


def _kept(spark: SparkSession, sf_dir: str) -> str:
    """The folder of reference counts of these tables: a session's later reports read no training rows."""
    return _store(spark.sparkContext.applicationId, sf_dir, shared_dir(spark))


def _sides(spark: SparkSession, sf_dir: str):
    return load(spark, sf_dir, "training_rows"), load(spark, sf_dir, "predictions")


def drift_ks_by_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, predictions = _sides(spark, sf_dir)
    ks = drift.ks_by_feature(
        drift.numeric_counts(training, _NUMERIC, [], "ref_n"),
        drift.numeric_counts(predictions, _NUMERIC, [], "prod_n"),
    )
    return ks.select("feature", "reference_n", "production_n", *r6("score"))


def drift_psi_by_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, predictions = _sides(spark, sf_dir)
    psi = drift.psi_against_reference(
        drift.categorical_counts(training, _CATEGORICAL, [], "ref_n"),
        drift.categorical_counts(predictions, _CATEGORICAL, [], "prod_n"),
    )
    return psi.select(
        "feature", "reference_n", "production_n", *r6("score"),
        stats.severity(F.col("score"), MonitorConfig()).alias("severity"),
    )


def drift_ks_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, predictions = _sides(spark, sf_dir)
    ks = drift.ks_by_feature(
        drift.numeric_counts(training, _NUMERIC, [], "ref_n"),
        drift.numeric_counts(predictions, _NUMERIC, [], "prod_n"),
    )
    return ks.select("feature", *r6("p_value"))


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions whose training dataset still exists, with their reference lineage."""
    return load(spark, sf_dir, "model_versions").join(
        load(spark, sf_dir, "datasets").select(F.col("id").alias("dataset_id"), "content_hash"), "dataset_id"
    ).select(F.col("id").alias("model_version_id"), "version_label", "dataset_id", "content_hash", "training_job_id")


def _report(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    training, predictions = _sides(spark, sf_dir)
    return drift.drift_report(
        _versions(spark, sf_dir), training, predictions, CONTRACT, as_of=moment(AS_OF), kept=_kept(spark, sf_dir), **options
    )


def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature of every version that passes the sample gate, over the whole log."""
    _, results = _report(spark, sf_dir)
    return results.select(
        "model_version_id", "feature", "test", *r6("score"), "threshold", "critical_threshold", "severity",
        "drift_detected", "reference_n", "production_n", "note",
    )


def drift_report_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status, sample and reference lineage per version, last 30 days."""
    header, _ = _report(spark, sf_dir, window="30d", config=MonitorConfig(min_samples=5))
    return header.select(
        "model_version_id", "version_label", "dataset_id", "content_hash", "training_job_id", "window",
        "sample_size", "minimum_required", "status", "n_sampled_for_computation", "reference_n_rows", "drift_detected",
    )


def drift_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of the version in production, and the answer for one that does not exist."""
    training, predictions = _sides(spark, sf_dir)
    staged = _versions(spark, sf_dir).join(load(spark, sf_dir, "model_versions").select(F.col("id").alias("model_version_id"), "stage"), "model_version_id")
    asked = []
    for version in (None, "nowhere"):
        header, _ = drift.version_drift(staged, training, predictions, CONTRACT, model_version_id=version, as_of=moment(AS_OF), kept=_kept(spark, sf_dir))
        asked.append(header.select("model_version_id", "status", "sample_size", "reference_n_rows"))
    return asked[0].unionByName(asked[1])


def drift_single_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One requested feature of every version, over all predictions."""
    _, results = _report(spark, sf_dir, features=["price"], config=MonitorConfig(min_samples=20))
    return results.select("model_version_id", "feature", *r6("score"), "drift_detected", "reference_n", "production_n")


def drift_single_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the production version alone: filters on version reach both scans."""
    production = load(spark, sf_dir, "model_versions").where("stage = 'production'").select("id", "dataset_id").head()
    training, predictions = _sides(spark, sf_dir)
    _, results = drift.drift_report(
        _versions(spark, sf_dir).where(F.col("model_version_id") == production["id"]),
        training.where(F.col("dataset_id") == production["dataset_id"]),
        predictions.where(F.col("model_version_id") == production["id"]),
        CONTRACT, as_of=moment(AS_OF), kept=_kept(spark, sf_dir),
    )
    return results.select("model_version_id", "feature", "test", *r6("score"), "severity", "drift_detected", "reference_n", "production_n")


def drift_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per version: how many features drifted, worst score to threshold ratio."""
    _, results = _report(spark, sf_dir)
    shown = drift.displayed(results)
    return shown.groupBy("model_version_id").agg(
        F.bool_or("drift_detected").alias("drift_detected"),
        F.count_if("drift_detected").alias("n_drifted"),
        F.count_if(F.col("status_text") == "No data").alias("n_without_data"),
        F.round(F.max("score_to_threshold"), 6).alias("worst_ratio"),
    )


def drift_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (version, preset window) with enough predictions, in one pass over the log."""
    training, predictions = _sides(spark, sf_dir)
    results = drift.drift_by_window(
        _versions(spark, sf_dir), training, predictions, CONTRACT, as_of=moment(AS_OF),
        config=MonitorConfig(min_samples=5), kept=_kept(spark, sf_dir),
    )
    return results.select(
        "model_version_id", "window", "feature", "test", *r6("score"), "drift_detected", "reference_n", "production_n"
    )


def drift_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features kept as JSON text: key `k` of each event type, second half of the month against the first."""
    events = load(spark, sf_dir, "events").select(
        "event_type", "ts", F.get_json_object("props", "$.k").try_cast("double").alias("k"), "value"
    )
    cut = moment("2024-01-16 00:00:00")
    ks = drift.ks_by_feature(
        drift.numeric_counts(events.where(F.col("ts") < cut), ["k", "value"], ["event_type"], "ref_n"),
        drift.numeric_counts(events.where(F.col("ts") >= cut), ["k", "value"], ["event_type"], "prod_n"),
        ["event_type"],
    )
    return ks.select("event_type", "feature", "reference_n", "production_n", *r6("score"))


def category_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised category shares of each training dataset."""
    counts = drift.categorical_counts(load(spark, sf_dir, "training_rows"), _CATEGORICAL, ["dataset_id"], "ref_n")
    return drift.proportions(counts, ["dataset_id"], "ref_n").select(
        "dataset_id", "feature", "value", F.round("proportion", 6).alias("proportion")
    )


def category_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of both sides and where each occurs."""
    training, predictions = _sides(spark, sf_dir)
    both = drift.both_sides(
        drift.categorical_counts(training, _CATEGORICAL, [], "ref_n"),
        drift.categorical_counts(predictions, _CATEGORICAL, [], "prod_n"),
        [],
    )
    return both.select("feature", "value", "ref_n", "prod_n")


QUERIES = {
    f.__name__: f
    for f in (
        drift_report, drift_report_header, drift_production, drift_single_version, drift_single_feature, drift_by_version, drift_by_window,
        drift_ks_by_feature, drift_psi_by_feature, drift_ks_pvalue, drift_from_json,
        category_proportions, category_union,
    )
}

_LONG_ALL = ",\n".join([
    _long_sql("rn", "training_rows", "", _NUMERIC), _long_sql("pn", "predictions", "", _NUMERIC),
])
_LONG_CAT = ",\n".join([
    _long_sql("rc", "training_rows", "", _CATEGORICAL), _long_sql("pc", "predictions", "", _CATEGORICAL),
])


def _report_sql(select: str, *, window: str = "TRUE", minimum: int = 100) -> str:
    return with_tables(
        f"""WITH versions AS (
      SELECT m.id AS model_version_id, version_label, m.dataset_id, content_hash, training_job_id
      FROM model_versions m JOIN datasets d ON m.dataset_id = d.id),
    recent AS (SELECT * FROM predictions WHERE {window}),
    header AS (
      SELECT v.*, CAST(count(r.id) AS BIGINT) AS sample_size, CAST({minimum} AS INT) AS minimum_required,
             CASE WHEN count(r.id) < {minimum} THEN 'insufficient_data' ELSE 'ok' END AS status
      FROM versions v LEFT JOIN recent r USING (model_version_id) GROUP BY ALL),
    passed AS (SELECT model_version_id, dataset_id FROM header WHERE status = 'ok'),
    sampled AS (SELECT * FROM recent WHERE model_version_id IN (SELECT model_version_id FROM passed)),
    trained AS (SELECT model_version_id, t.* FROM training_rows t JOIN passed USING (dataset_id)),
    {_long_sql("rn", "trained", "model_version_id", _NUMERIC)},
    {_long_sql("pn", "sampled", "model_version_id", _NUMERIC)},
    {_long_sql("rc", "trained", "model_version_id", _CATEGORICAL)},
    {_long_sql("pc", "sampled", "model_version_id", _CATEGORICAL)},
    {_ks_sql("model_version_id", "rn", "pn")},
    {_psi_sql("model_version_id", "rc", "pc")},
    features(feature, test) AS (VALUES ('quantity', 'KS'), ('price', 'KS'), ('discount', 'KS'), ('flag', 'PSI'), ('status', 'PSI')),
    found AS (SELECT * FROM ks UNION ALL SELECT * FROM psi),
    results AS (
      SELECT p.model_version_id, f.feature, f.test, score, CAST(0.1 AS DOUBLE) AS threshold,
             CASE WHEN f.test = 'PSI' THEN CAST(0.25 AS DOUBLE) END AS critical_threshold,
             CASE WHEN f.test = 'PSI' AND score IS NOT NULL THEN
               CASE WHEN score >= 0.25 THEN 'critical' WHEN score >= 0.1 THEN 'warning' ELSE 'none' END END AS severity,
             coalesce(score >= 0.1, FALSE) AS drift_detected,
             CASE WHEN score IS NOT NULL THEN reference_n END AS reference_n, CASE WHEN score IS NOT NULL THEN production_n END AS production_n,
             CASE WHEN score IS NULL THEN '{drift.NO_VALUES_NOTE}' END AS note
      FROM passed p CROSS JOIN features f LEFT JOIN found x ON p.model_version_id = x.model_version_id AND f.feature = x.feature)
    {select}""",
        "training_rows", "predictions", "model_versions", "datasets",
    )


ORACLES = {
    "drift_report": _report_sql(
        """SELECT model_version_id, feature, test, round(score, 6) AS score, threshold, critical_threshold, severity,
                  drift_detected, reference_n, production_n, note FROM results"""
    ),
    "drift_production": _report_sql(
        """SELECT h.model_version_id, h.status, h.sample_size,
                  CASE WHEN h.status = 'ok' THEN (SELECT CAST(count(*) AS BIGINT) FROM training_rows t WHERE t.dataset_id = h.dataset_id) END AS reference_n_rows
        FROM header h JOIN model_versions m ON m.id = h.model_version_id WHERE m.stage = 'production'
        UNION ALL SELECT 'nowhere', 'unknown_version', NULL, NULL""",
    ),
    "drift_report_header": _report_sql(
        """SELECT h.model_version_id, h.version_label, h.dataset_id, h.content_hash, h.training_job_id, '30d' AS "window",
                  h.sample_size, h.minimum_required, h.status,
                  CASE WHEN h.status = 'ok' THEN h.sample_size END AS n_sampled_for_computation,
                  CASE WHEN h.status = 'ok' THEN t.n END AS reference_n_rows, d.drift_detected
           FROM header h LEFT JOIN (SELECT dataset_id, CAST(count(*) AS BIGINT) AS n FROM training_rows GROUP BY 1) t USING (dataset_id)
           LEFT JOIN (SELECT model_version_id, bool_or(drift_detected) AS drift_detected FROM results GROUP BY 1) d
             ON h.model_version_id = d.model_version_id""",
        window=f"created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY", minimum=5,
    ),
    "drift_single_feature": _report_sql(
        """SELECT model_version_id, feature, round(score, 6) AS score, drift_detected, reference_n, production_n
           FROM results WHERE feature = 'price'""", minimum=20,
    ),
    "drift_single_version": _report_sql(
        """SELECT model_version_id, feature, test, round(score, 6) AS score, severity, drift_detected, reference_n, production_n
           FROM results WHERE model_version_id = (SELECT id FROM model_versions WHERE stage = 'production')"""
    ),
    "drift_by_version": _report_sql(
        """SELECT model_version_id, bool_or(drift_detected) AS drift_detected,
                  CAST(count(*) FILTER (drift_detected) AS BIGINT) AS n_drifted,
                  CAST(count(*) FILTER (score IS NULL) AS BIGINT) AS n_without_data,
                  round(max(score / threshold), 6) AS worst_ratio FROM results GROUP BY 1"""
    ),
    "drift_by_window": with_tables(
        f"""WITH versions AS (
      SELECT m.id AS model_version_id, m.dataset_id FROM model_versions m JOIN datasets d ON m.dataset_id = d.id),
    spans("window", since) AS (VALUES ('24h', TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY), ('7d', TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY),
      ('30d', TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY), ('all', TIMESTAMP '1900-01-01')),
    logged AS (SELECT p.*, s."window" FROM predictions p JOIN spans s ON p.created_at >= s.since
               WHERE model_version_id IN (SELECT model_version_id FROM versions)),
    passed AS (SELECT model_version_id, "window" FROM logged GROUP BY 1, 2 HAVING count(*) >= 5),
    sampled AS (SELECT l.* FROM logged l JOIN passed USING (model_version_id, "window")),
    trained AS (SELECT p.model_version_id, p."window", t.* FROM training_rows t JOIN versions v USING (dataset_id)
                JOIN passed p ON p.model_version_id = v.model_version_id),
    {_long_sql("rn", "trained", 'model_version_id, "window"', _NUMERIC)},
    {_long_sql("pn", "sampled", 'model_version_id, "window"', _NUMERIC)},
    {_long_sql("rc", "trained", 'model_version_id, "window"', _CATEGORICAL)},
    {_long_sql("pc", "sampled", 'model_version_id, "window"', _CATEGORICAL)},
    {_ks_sql('model_version_id, "window"', "rn", "pn")},
    {_psi_sql('model_version_id, "window"', "rc", "pc")},
    features(feature, test) AS (VALUES ('quantity', 'KS'), ('price', 'KS'), ('discount', 'KS'), ('flag', 'PSI'), ('status', 'PSI')),
    found AS (SELECT * FROM ks UNION ALL SELECT * FROM psi)
    SELECT p.model_version_id, p."window", f.feature, f.test, round(score, 6) AS score,
           coalesce(score >= 0.1, FALSE) AS drift_detected,
           CASE WHEN score IS NOT NULL THEN reference_n END AS reference_n, CASE WHEN score IS NOT NULL THEN production_n END AS production_n
    FROM passed p CROSS JOIN features f LEFT JOIN found x
      ON p.model_version_id = x.model_version_id AND p."window" = x."window" AND f.feature = x.feature""",
        "training_rows", "predictions", "model_versions", "datasets",
    ),
    "drift_ks_by_feature": with_tables(
        f"WITH {_LONG_ALL}, {_ks_sql('', 'rn', 'pn')} SELECT feature, reference_n, production_n, round(score, 6) AS score FROM ks",
        "training_rows", "predictions",
    ),
    "drift_psi_by_feature": with_tables(
        f"""WITH {_LONG_CAT}, {_psi_sql('', 'rc', 'pc')}
        SELECT feature, reference_n, production_n, round(score, 6) AS score,
               CASE WHEN score >= 0.25 THEN 'critical' WHEN score >= 0.1 THEN 'warning' ELSE 'none' END AS severity FROM psi""",
        "training_rows", "predictions",
    ),
    "drift_ks_pvalue": with_tables(
        f"""WITH {_LONG_ALL}, {_ks_sql('', 'rn', 'pn')},
        scaled AS (SELECT feature, sqrt(CAST(reference_n AS DOUBLE) * production_n / (reference_n + production_n)) AS en, score FROM ks),
        lam AS (SELECT feature, (en + 0.12 + 0.11 / en) * score AS l FROM scaled)
        SELECT feature, round(CASE WHEN l < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101),
               lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * l * l))))) END, 6) AS p_value FROM lam""",
        "training_rows", "predictions",
    ),
    "drift_from_json": f"""WITH e AS (SELECT event_type, ts, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, value FROM events),
        first_half AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-16'), second_half AS (SELECT * FROM e WHERE ts >= TIMESTAMP '2024-01-16'),
        {_long_sql("rn", "first_half", "event_type", ["k", "value"])}, {_long_sql("pn", "second_half", "event_type", ["k", "value"])},
        {_ks_sql("event_type", "rn", "pn")}
        SELECT event_type, feature, reference_n, production_n, round(score, 6) AS score FROM ks""",
    "category_proportions": with_tables(
        f"""WITH {_long_sql("rc", "training_rows", "dataset_id", _CATEGORICAL)},
        c AS (SELECT dataset_id, feature, value, count(*) AS n FROM rc WHERE value IS NOT NULL GROUP BY 1, 2, 3)
        SELECT dataset_id, feature, value, round(n / sum(n) OVER (PARTITION BY dataset_id, feature), 6) AS proportion FROM c""",
        "training_rows",
    ),
    "category_union": with_tables(
        f"""WITH {_LONG_CAT}
        SELECT feature, value, CAST(sum(a) AS BIGINT) AS ref_n, CAST(sum(b) AS BIGINT) AS prod_n
        FROM (SELECT feature, value, 1 AS a, 0 AS b FROM rc UNION ALL SELECT feature, value, 0, 1 FROM pc) u
        WHERE value IS NOT NULL GROUP BY 1, 2""",
        "training_rows", "predictions",
    ),
}
