"""Feature, split and evaluation queries over line items seen as a raw training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.operators import evaluate, features, split
from tabwatch.queries.tables import load, r6
from tabwatch.schema import ID, TARGET, ColumnSpec, DatasetContract, categories, numbers

CONTRACT = DatasetContract(
    name="line_value",
    columns=(
        ColumnSpec("row_key", ID), *numbers("quantity", "unit"), *numbers("total", coercible=True),
        *categories("flag", "status"), ColumnSpec("costly", TARGET),
    ),
    labels=("Yes", "No"),
)
SPEC = features.FeatureSpec(CONTRACT, {"avg_unit": features.average_spend("total", "quantity", "unit")})

# Raw text rows with a learnable target: blanks and texts in numerics, nulls in categoricals.
_RAW = """
    SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),
                     CAST(l_suppkey AS STRING), CAST(l_shipdate AS STRING)) AS row_key,
           CASE WHEN l_partkey % 50 = 0 THEN '0' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
           CASE WHEN l_partkey % 31 = 0 THEN CAST(NULL AS STRING) ELSE CAST(l_tax AS STRING) END AS unit,
           CASE WHEN l_partkey % 50 = 0 THEN '' WHEN l_partkey % 53 = 0 THEN 'n/k' ELSE CAST(l_extendedprice AS STRING) END AS total,
           CASE WHEN l_suppkey % 9 = 0 THEN CAST(NULL AS STRING) ELSE l_returnflag END AS flag,
           l_linestatus AS status,
           CASE WHEN l_extendedprice > 2000 * l_quantity THEN 'Yes' ELSE 'No' END AS costly
    FROM {lineitem}"""


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_RAW, lineitem=load(spark, sf_dir, "lineitem"))


def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_rows(raw_rows(spark, sf_dir), SPEC, keep=["row_key"])


def engineered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed_rows(spark, sf_dir)
    return rows.select("row_key", *SPEC.numeric, *SPEC.categorical, "label")


def stratified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(typed_rows(spark, sf_dir), ["row_key"], test_size=0.15, val_size=0.15, seed=42)


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_rows(spark, sf_dir).select("row_key", "label", "split")


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_sizes(stratified_rows(spark, sf_dir))


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_rows(spark, sf_dir).where("split = 'train'")


def fit_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imputation and scaling parameters of the training fold only."""
    return features.numeric_statistics(_train(spark, sf_dir), SPEC.numeric).select(
        "feature", "n", "n_missing", *r6("median", "mean", "std")
    )


def category_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.category_statistics(_train(spark, sf_dir), SPEC.categorical)


def standardized_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled features of every row; the parameters come from the training fold."""
    stats = features.numeric_statistics(_train(spark, sf_dir), SPEC.numeric)
    return features.standardized(typed_rows(spark, sf_dir), stats, SPEC.numeric, ["row_key"]).select("row_key", "feature", F.round("z", 5).alias("z"))


def one_hot_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = features.category_statistics(_train(spark, sf_dir).where("flag <> 'N' OR flag IS NULL"), SPEC.categorical)
    return features.one_hot(typed_rows(spark, sf_dir), vocabulary, SPEC.categorical, ["row_key"])


def hashed_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared positions if columns were hashed: one with as many categories as rows, one with a few."""
    return features.hashed_collisions(features.category_statistics(_train(spark, sf_dir), ["row_key", "flag"]))


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.class_weights(_train(spark, sf_dir)).select("n_neg", "n_pos", *r6("weight_neg", "weight_pos", "scale_pos_weight"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a fixed score formula, so that any engine scores them alike."""
    score = F.round((F.col("l_discount") * 5 + F.col("l_tax") * 5 + F.col("l_quantity") / 100) / 2, 4)
    return load(spark, sf_dir, "lineitem").select(
        "l_linestatus", "l_linenumber", (F.col("l_extendedprice") > 50000).cast("int").alias("label"),
        score.alias("probability"), (score >= 0.5).cast("int").alias("prediction"),
    )


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(_scored(spark, sf_dir), ["l_linestatus"])


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = evaluate.evaluation_report(_scored(spark, sf_dir), ["l_linestatus", "l_linenumber"])
    return report.select("l_linestatus", "l_linenumber", *r6(*evaluate.SCORES, "roc_auc"))


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.roc_auc(_scored(spark, sf_dir)).select(*r6("roc_auc"))


QUERIES = {
    f.__name__: f
    for f in (
        engineered_features, stratified_split, split_sizes, fit_statistics, category_statistics, standardized_features,
        one_hot_features, hashed_categories, class_weights, confusion_matrix, classification_metrics, roc_auc,
    )
}

_TYPED = f"""raw AS ({_RAW.format(lineitem="lineitem")}),
    numbers AS (SELECT row_key, TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(unit AS DOUBLE) AS unit, TRY_CAST(total AS DOUBLE) AS total,
                flag, status, CASE WHEN costly = 'Yes' THEN 1 ELSE 0 END AS label FROM raw),
    typed AS (SELECT *, CASE WHEN quantity > 0 THEN total / quantity ELSE unit END AS avg_unit FROM numbers),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || row_key)) AS r, count(*) OVER (PARTITION BY label) AS t FROM typed),
    parts AS (SELECT *, CASE WHEN r <= floor(t * 0.15 + 0.5) THEN 'test' WHEN r <= floor(t * 0.15 + 0.5) + floor(t * 0.15 + 0.5) THEN 'val' ELSE 'train' END AS split FROM ranked),
    train AS (SELECT * FROM parts WHERE split = 'train')"""
_STATS = "stats AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST(count(*) AS BIGINT) AS n, CAST(count(*) - count({c}) AS BIGINT) AS n_missing, max(m) AS median,
        avg(coalesce({c}, m)) AS mean, CASE WHEN stddev_pop(coalesce({c}, m)) > 0 THEN stddev_pop(coalesce({c}, m)) ELSE 1 END AS std
        FROM train, (SELECT median({c}) AS m FROM train) x"""
    for c in SPEC.numeric
) + ")"
_SCORED = """scored AS (SELECT l_linestatus, l_linenumber, CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END AS label,
    round((l_discount * 5 + l_tax * 5 + l_quantity / 100) / 2, 4) AS probability FROM lineitem),
    predicted AS (SELECT *, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scored)"""
_CELLS = """count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp"""


def _auc_sql(keys: str) -> str:
    """Rank-sum form with average ranks."""
    over = f"PARTITION BY {keys} " if keys else ""
    by = f"GROUP BY {keys}" if keys else ""
    head = f"{keys}, " if keys else ""
    return f"""ranks AS (SELECT {head}label, rank() OVER ({over}ORDER BY probability) + (count(*) OVER ({over and over.strip() + ', '}{'' if over else 'PARTITION BY '}probability) - 1) / 2.0 AS r FROM predicted),
    auc AS (SELECT {head}(sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
            / nullif(CAST(count(*) FILTER (label = 1) AS DOUBLE) * count(*) FILTER (label = 0), 0) AS roc_auc FROM ranks {by})"""


ORACLES = {
    "engineered_features": f"""WITH {_TYPED} SELECT row_key, quantity, unit, total, avg_unit, flag, status, label FROM typed""",
    "stratified_split": f"WITH {_TYPED} SELECT row_key, label, split FROM parts",
    "split_sizes": f"WITH {_TYPED} SELECT split, label, CAST(count(*) AS BIGINT) AS n_rows FROM parts GROUP BY 1, 2",
    "fit_statistics": f"WITH {_TYPED}, {_STATS} SELECT feature, n, n_missing, round(median, 6) AS median, round(mean, 6) AS mean, round(std, 6) AS std FROM stats",
    "category_statistics": f"""WITH {_TYPED}, c AS (SELECT 'flag' AS feature, flag AS value, count(*) AS n FROM train WHERE flag IS NOT NULL GROUP BY 2
          UNION ALL SELECT 'status', status, count(*) FROM train WHERE status IS NOT NULL GROUP BY 2)
        SELECT feature, value, CAST(n AS BIGINT) AS n, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) = 1 AS is_mode FROM c""",
    "standardized_features": f"WITH {_TYPED}, {_STATS} " + " UNION ALL ".join(
        f"SELECT row_key, '{c}' AS feature, round((coalesce({c}, median) - mean) / std, 5) AS z FROM typed, stats WHERE feature = '{c}'" for c in SPEC.numeric
    ),
    "one_hot_features": f"""WITH {_TYPED}, seen AS (SELECT * FROM train WHERE flag <> 'N' OR flag IS NULL),
        filled AS (SELECT row_key, 'flag' AS feature, coalesce(flag, (SELECT flag FROM seen WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)) AS category FROM typed
          UNION ALL SELECT row_key, 'status', status FROM typed)
        SELECT * FROM filled WHERE (feature = 'flag' AND category IN (SELECT flag FROM seen)) OR (feature = 'status' AND category IN (SELECT status FROM seen))""",
    "hashed_categories": f"""WITH {_TYPED}, c AS (SELECT DISTINCT 'row_key' AS feature, row_key AS value FROM train
          UNION ALL SELECT DISTINCT 'flag', flag FROM train WHERE flag IS NOT NULL),
        p AS (SELECT feature, CAST('0x' || substr(md5(value), 1, 8) AS BIGINT) % {features.HASHED_POSITIONS} AS position, count(*) AS n FROM c GROUP BY 1, 2)
        SELECT feature, CAST(sum(n) AS BIGINT) AS n_categories, CAST(count(*) AS BIGINT) AS n_positions,
          CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS n_collided FROM p GROUP BY 1""",
    "class_weights": f"""WITH {_TYPED}, c AS (SELECT count(*) FILTER (label = 0) AS a, count(*) FILTER (label = 1) AS b FROM train)
        SELECT CAST(a AS BIGINT) AS n_neg, CAST(b AS BIGINT) AS n_pos, round((a + b) / (2.0 * a), 6) AS weight_neg, round((a + b) / (2.0 * b), 6) AS weight_pos,
        round(CAST(a AS DOUBLE) / b, 6) AS scale_pos_weight FROM c""",
    "confusion_matrix": f"""WITH {_SCORED}, m AS (SELECT l_linestatus, {_CELLS} FROM predicted GROUP BY 1)
        SELECT l_linestatus, CAST(tn AS BIGINT) AS true_negative, CAST(fp AS BIGINT) AS false_positive, CAST(fn AS BIGINT) AS false_negative, CAST(tp AS BIGINT) AS true_positive FROM m""",
    "classification_metrics": f"""WITH {_SCORED}, m AS (SELECT l_linestatus, l_linenumber, {_CELLS} FROM predicted GROUP BY 1, 2),
        {_auc_sql('l_linestatus, l_linenumber')}
        SELECT l_linestatus, l_linenumber, round((tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS accuracy,
          round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0), 6) AS "precision", round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0), 6) AS recall,
          round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 6) AS f1, round(roc_auc, 6) AS roc_auc
        FROM m JOIN auc USING (l_linestatus, l_linenumber)""",
    "roc_auc": f"WITH {_SCORED}, {_auc_sql('')} SELECT round(roc_auc, 6) AS roc_auc FROM auc",
}
