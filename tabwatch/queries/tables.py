"""Stand-ins for the platform's tables, derived from the test tables.

Each is one SELECT that both Spark and the oracle engine accept; `{name}` marks a source table or
another stand-in. All of them grow with the test data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.schema import ID, TARGET, ColumnSpec, DatasetContract, categories, numbers
from tabwatch.session import read_table

# Reference point of every relative window: just after the last row of the table concerned.
AS_OF = "2001-11-05 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
CUT = "1998-01-01 00:00:00"
# Rows of one uploaded file: a larger upload comes in more files.
UPLOAD_ROWS = 100_000

SELECTS: dict[str, str] = {
    # A raw, all-text dataset with blanks, texts in numeric columns, unknown labels and a spare column.
    "raw_lines": """
        SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS line_id,
               CASE WHEN l_partkey % 97 = 0 THEN ' ' WHEN l_partkey % 101 = 0 THEN 'n/k'
                    ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
               CASE WHEN l_suppkey % 13 = 0 THEN CAST(NULL AS STRING) WHEN l_suppkey % 17 = 0 THEN '1d'
                    ELSE CAST(l_discount AS STRING) END AS discount,
               CASE WHEN l_tax = 0 THEN '' WHEN l_partkey % 103 = 0 THEN '0x10'
                    ELSE CAST(l_tax AS STRING) END AS tax,
               CASE WHEN l_quantity > 20 THEN CAST(NULL AS STRING) ELSE l_linestatus END AS linestatus,
               CASE WHEN l_partkey % 89 = 0 THEN CAST(NULL AS STRING) ELSE l_returnflag END AS flag,
               CAST(l_suppkey AS STRING) AS supplier_hint
        FROM {lineitem}""",
    # Typed training rows; each supplier nation is one training dataset.
    "training_rows": f"""
        SELECT CAST(s_nationkey AS STRING) AS dataset_id, l_quantity AS quantity, l_extendedprice AS price,
               l_discount AS discount, l_returnflag AS flag, l_linestatus AS status
        FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey
        WHERE l_shipdate < '{CUT}'""",
    # The prediction log: some versions see shifted prices, some a category unknown to training.
    "predictions": f"""
        SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),
                         CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)) AS id,
               CAST(l_orderkey AS STRING) AS request_id, CAST(l_suppkey AS STRING) AS model_version_id,
               CASE WHEN l_quantity > 48 THEN CAST(NULL AS DOUBLE) ELSE l_quantity END AS quantity,
               CASE WHEN l_suppkey % 5 = 0 THEN l_extendedprice * 1.25 ELSE l_extendedprice END AS price,
               l_discount AS discount,
               CASE WHEN l_suppkey % 7 = 0 AND l_returnflag = 'A' THEN 'X' ELSE l_returnflag END AS flag,
               CASE WHEN l_suppkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE l_linestatus END AS status,
               CASE WHEN l_tax >= 0.04 THEN 'Yes' ELSE 'No' END AS prediction,
               l_tax * 12 AS probability, l_discount * 100 AS latency_ms, l_shipdate AS created_at
        FROM {{lineitem}} WHERE l_shipdate >= '{CUT}'""",
    "model_versions": """
        SELECT CAST(s_suppkey AS STRING) AS id, concat('v', CAST(s_suppkey + 1 AS STRING)) AS version_label,
               CASE WHEN s_nationkey % 3 = 0 THEN 'logistic_regression'
                    WHEN s_nationkey % 3 = 1 THEN 'random_forest' ELSE 'xgboost' END AS algorithm,
               CASE WHEN s_suppkey % 40 = 39 THEN 'run-shared'
                    ELSE concat('run-', CAST(s_suppkey AS STRING)) END AS mlflow_run_id,
               '1' AS mlflow_experiment_id,
               concat('runs:/run-', CAST(s_suppkey AS STRING), '/model') AS artifact_uri,
               'deadbeef' AS git_commit,
               CASE WHEN s_suppkey = 1 THEN 'production' WHEN s_suppkey = 2 THEN 'previous'
                    WHEN s_acctbal < 1000 THEN 'archived' ELSE 'candidate' END AS stage,
               abs(s_acctbal) / 10000 AS m_accuracy, abs(s_acctbal) / 11000 AS m_precision,
               abs(s_acctbal) / 12000 AS m_recall,
               CASE WHEN s_suppkey % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE abs(s_acctbal) / 13000 END AS m_f1,
               abs(s_acctbal) / 10500 AS m_roc_auc,
               CASE WHEN s_suppkey % 29 = 28 THEN CAST(NULL AS STRING)
                    WHEN s_suppkey % 19 = 18 THEN concat('gone-', CAST(s_suppkey AS STRING))
                    ELSE CAST(s_nationkey AS STRING) END AS dataset_id,
               CASE WHEN s_suppkey % 4 = 0 THEN CAST(NULL AS STRING)
                    ELSE CAST(s_suppkey AS STRING) END AS training_job_id,
               CAST('1995-01-01 00:00:00' AS TIMESTAMP) + s_suppkey * INTERVAL '1' HOUR AS created_at,
               CASE WHEN s_suppkey IN (1, 2) OR s_acctbal < 1000
                    THEN CAST('2000-01-01 00:00:00' AS TIMESTAMP) - s_suppkey * INTERVAL '1' HOUR
                    END AS promoted_at
        FROM {supplier}""",
    "datasets": """
        SELECT CAST(c_custkey AS STRING) AS id, concat(c_name, '.csv') AS filename, c_mktsegment AS schema_name,
               concat('/landing/', CAST(c_custkey AS STRING), '.csv') AS storage_path,
               md5(c_name) AS content_hash, c_custkey * 10 AS n_rows, 21 AS n_columns,
               c_acctbal >= 0 AS is_valid,
               CAST('1995-01-01 00:00:00' AS TIMESTAMP) + c_custkey * INTERVAL '1' MINUTE AS uploaded_at
        FROM {customer}""",
    "jobs": """
        SELECT id, job_type, status, CASE WHEN job_type = 'train' THEN dataset_id END AS dataset_id,
               CASE WHEN job_type = 'train'
                    THEN concat('{{"config": {{"random_state": ', CAST(seed AS STRING), '}}, "algorithms": ',
                                CASE WHEN seed = 1 THEN 'null' ELSE '["xgboost"]' END, '}}')
                    WHEN job_type = 'batch_predict'
                    THEN concat('{{"records": [', repeat('{{}}, ', CAST(seed AS INT)), '{{}}], "model_version_id": "', version, '"}}')
                    ELSE '{{}}' END AS payload,
               CASE WHEN status = 'failed' THEN concat('boom in ', id) END AS error_message,
               created_at,
               CASE WHEN status <> 'queued' THEN created_at END AS started_at,
               CASE WHEN status IN ('failed', 'completed') THEN created_at + seconds * INTERVAL '1' SECOND END AS finished_at
        FROM (SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS dataset_id,
                     CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'train'
                          WHEN o_orderpriority = '5-LOW' THEN 'ingest' ELSE 'batch_predict' END AS job_type,
                     CASE WHEN o_orderstatus = 'P' THEN 'failed' WHEN o_orderstatus = 'F' THEN 'completed'
                          WHEN o_totalprice > 250000 THEN 'queued' ELSE 'running' END AS status,
                     o_orderkey % 3 AS seed, CAST(o_custkey % 120 AS STRING) AS version,
                     CAST(floor(o_totalprice / 100) AS BIGINT) AS seconds, o_orderdate AS created_at
              FROM {orders}) o""",
    # What training jobs left behind: an order's first three lines stand for the three algorithms.
    "job_candidates": """
        SELECT concat('c', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id, CAST(l_orderkey AS STRING) AS training_job_id,
               CASE WHEN l_linenumber = 1 THEN 'logistic_regression' WHEN l_linenumber = 2 THEN 'random_forest' ELSE 'xgboost' END AS algorithm,
               CAST(l_linenumber AS INT) AS ordinal, max(l_quantity) / 64 AS roc_auc
        FROM {lineitem} WHERE l_linenumber <= 3 GROUP BY l_orderkey, l_linenumber""",
    "access_log": """
        SELECT event_id, ts, CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
               concat('/', event_type) AS endpoint,
               CASE WHEN event_type = 'error' THEN 500 WHEN value > 100 THEN 404 ELSE 200 END AS status_code,
               value / 10 AS latency_s
        FROM {events}""",
}

PREDICTION_CONTRACT = DatasetContract(
    name="lines",
    columns=(
        ColumnSpec("id", ID), *numbers("quantity", "price", "discount"), *categories("flag", "status"),
        ColumnSpec("prediction", TARGET),
    ),
    labels=("Yes", "No"),
)
RAW_CONTRACT = DatasetContract(
    name="raw_lines",
    columns=(
        ColumnSpec("line_id", ID), *numbers("quantity", "discount"), *numbers("tax", coercible=True),
        *categories("linestatus"), ColumnSpec("flag", TARGET),
    ),
    labels=("R", "N"),
)

_NAMES = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in (or a test table) as a DataFrame."""
    if name not in SELECTS:
        return read_table(spark, sf_dir, name)
    sql = SELECTS[name]
    sources = {source: load(spark, sf_dir, source) for source in set(_NAMES.findall(sql))}
    df = spark.sql(sql, **sources)
    if name == "model_versions":
        metrics = F.struct(*[F.col(f"m_{m}").alias(m) for m in ("accuracy", "precision", "recall", "f1", "roc_auc")])
        df = df.withColumn("metrics", metrics).drop(*[c for c in df.columns if c.startswith("m_")])
    return df


def with_tables(sql: str, *names: str) -> str:
    """Oracle SQL with the named stand-ins as leading common table expressions."""
    ctes = [f"{n} AS ({SELECTS[n].format_map(_Itself())})" for n in names]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


class _Itself(dict):
    def __missing__(self, key: str) -> str:
        return key


def moment(text: str):
    """Zone-less literal, so that comparisons with the test tables' timestamps reach the Parquet scan."""
    return F.lit(text).cast("timestamp_ntz")


def r6(*names: str):
    """Doubles to six places, which absorbs summation order."""
    return [F.round(n, 6).alias(n) for n in names]
