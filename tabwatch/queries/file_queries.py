"""Source and sink queries: test tables written out in the platform's formats and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.operators import monitoring, quality
from tabwatch.plans.ingest import ingest_csv
from tabwatch.queries.tables import RAW_CONTRACT, UPLOAD_ROWS, load, moment, r6, with_tables
from tabwatch.session import new_workspace
from tabwatch.sources import csv, files, logs, tables


def raw_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines and a note with quotes, commas and line breaks, written as CSV and scanned again as text."""
    path = new_workspace(spark, "csv")
    note = F.concat(F.lit('said "'), "supplier_hint", F.lit('", then\n'), "line_id", F.lit(" left"))
    csv.write_raw_csv(load(spark, sf_dir, "raw_lines").withColumn("note", note), path, max_records=UPLOAD_ROWS)
    rows, _ = csv.split_malformed(csv.read_raw_csv(spark, path))
    return rows


def corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a field too many: customer names are written unquoted, some with a comma inside."""
    path = new_workspace(spark, "corrupt")
    broken = F.when(F.col("c_acctbal") < 0, F.concat("c_name", F.lit(",Jr."))).otherwise(F.col("c_name"))
    load(spark, sf_dir, "customer").select(
        F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment", broken).alias("value")
    ).write.text(path)
    _, rejects = csv.split_malformed(csv.read_raw_csv(spark, path, columns=["id", "segment", "name"]))
    return rejects.select("id", "segment", "name", F.col(csv.OVERFLOW).alias("first_extra"))


def _segment_files(spark: SparkSession, sf_dir: str, suffix: str = "csv") -> str:
    """One file per market segment, customers in key order."""
    path = new_workspace(spark, "segments")
    lines = load(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("value"))
    ordered = lines.repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "c_custkey").drop("c_custkey")
    ordered.write.partitionBy("c_mktsegment").option("compression", "none").text(path)
    return path


def _segment(path) -> object:
    return F.regexp_extract(path, r"c_mktsegment=([^/]+)/", 1)


def file_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = files.list_files(spark, _segment_files(spark, sf_dir))
    return files.admission(listed).select(_segment(F.col("path")).alias("segment"), "length", "reject_reason")


def file_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.fingerprints(spark, _segment_files(spark, sf_dir))
    return found.select(_segment(F.col("path")).alias("segment"), "length", "sha256")


def integrity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's request to train on its segment's file or on one that is not there."""
    hashes = files.fingerprints(spark, _segment_files(spark, sf_dir)).select(_segment(F.col("path")).alias("storage_path"), "sha256")
    customers = load(spark, sf_dir, "customer")
    catalog = customers.groupBy("c_mktsegment").agg(F.min("c_custkey").alias("k")).join(
        hashes, F.col("c_mktsegment") == F.col("storage_path")
    ).select(
        F.col("c_mktsegment").alias("id"), (F.col("c_mktsegment") != "MACHINERY").alias("is_valid"),
        F.when(F.col("c_mktsegment") == "BUILDING", "nowhere").otherwise(F.col("storage_path")).alias("storage_path"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "stale").otherwise(F.col("sha256")).alias("content_hash"),
    )
    wanted = F.when(F.col("c_acctbal") < 0, "UNKNOWN").otherwise(F.col("c_mktsegment"))
    return files.integrity(customers.select("c_custkey", wanted.alias("dataset_id")), catalog, hashes)


def file_existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = files.list_files(spark, _segment_files(spark, sf_dir))
    catalog = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") < 0, "UNKNOWN").otherwise(F.col("c_mktsegment")).alias("storage_path")
    )
    return files.existing(catalog, listed, _segment(F.col("path"))).select("id", "storage_path", "file_exists")


def artifact_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with a model file in a listing that has other files, and files of no run, as well."""
    listing = load(spark, sf_dir, "lineitem").selectExpr(
        """concat('artifacts/', CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE CAST(l_orderkey AS STRING) END,
            CASE WHEN l_linenumber % 2 = 0 THEN '/model/part-' ELSE '/logs/' END, l_linenumber) AS path"""
    )
    return files.verified_runs(listing, F.regexp_extract("path", "^artifacts/([^/]*)/model/", 1))


def landing_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines of two datasets landed, one of them twice, and counted per dataset."""
    path = new_workspace(spark, "landing")
    raw = load(spark, sf_dir, "raw_lines")
    tables.land_rows(raw, "a", path)
    tables.land_rows(raw.where("flag = 'R'"), "b", path)
    tables.land_rows(raw.where("flag = 'N'"), "b", path)
    return spark.read.parquet(path).groupBy("dataset_id", "flag").agg(F.count(F.lit(1)).alias("n_rows"))


def dataset_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV upload, of as many files as its rows need, from files to catalog row."""
    path = new_workspace(spark, "upload")
    csv.write_raw_csv(load(spark, sf_dir, "raw_lines"), path, max_records=UPLOAD_ROWS)
    root = new_workspace(spark, "ingest")
    row = ingest_csv(
        spark, path, RAW_CONTRACT, dataset_id="d1", filename="lines.csv", landing=f"{root}/landing",
        catalog=f"{root}/datasets", as_of=moment("2001-12-01 00:00:00"),
    )
    return row.select("id", "filename", "schema_name", "n_rows", "n_columns", "is_valid", F.get_json_object("quality_report", "$.duplicate_row_count").cast("bigint").alias("duplicates"))


def prediction_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log written in two appends and read back for one version and a span of days."""
    path = f"{new_workspace(spark, 'log')}/predictions"
    predictions = load(spark, sf_dir, "predictions")
    cut = moment("2000-01-01 00:00:00")
    tables.append_predictions(predictions.where(F.col("created_at") < cut), path, period="month")
    tables.append_predictions(predictions.where(F.col("created_at") >= cut), path, period="month")
    log = spark.read.parquet(path).where("model_version_id = '7' AND dt BETWEEN '1999-07-01' AND '2000-06-30'")
    return log.select("id", "request_id", "prediction", *r6("probability"))


def registry_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry published twice; readers see the second state."""
    path = new_workspace(spark, "registry")
    versions = load(spark, sf_dir, "model_versions").select("id", "stage")
    tables.publish(versions, path)
    tables.publish(versions.where("stage <> 'archived'"), path)
    return tables.latest(spark, path)


def access_log_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access log written as JSON lines and counted again through the fixed schema."""
    path = new_workspace(spark, "access")
    load(spark, sf_dir, "access_log").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), F.lit("INFO").alias("level"), F.lit("access").alias("name"),
        F.when(F.col("status_code") == 500, "request_failed").otherwise("request_completed").alias("message"),
        F.col("event_id").cast("string").alias("request_id"), "method", F.col("endpoint").alias("path"), "status_code",
        (F.col("latency_s") * 1000).alias("latency_ms"),
    ).write.json(path)
    return monitoring.counters(logs.read_access_log(spark, path), ["method", "path", "status_code"])


QUERIES = {
    f.__name__: f
    for f in (
        raw_csv_roundtrip, corrupt_rows, file_admission, file_fingerprints, integrity_check, file_existence, artifact_runs, landing_sink,
        dataset_ingest, prediction_log_append, registry_publish, access_log_json,
    )
}

_LINE = "concat(CAST(c_custkey AS STRING), ',', c_name)"

ORACLES = {
    "artifact_runs": "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS run_id FROM lineitem WHERE l_orderkey % 5 <> 0 AND l_linenumber % 2 = 0",
    "raw_csv_roundtrip": with_tables(
        """SELECT line_id, quantity, discount, nullif(tax, '') AS tax, linestatus, flag, supplier_hint,
        concat('said "', supplier_hint, '", then', chr(10), line_id, ' left') AS note FROM raw_lines""", "raw_lines"
    ),
    "corrupt_rows": "SELECT CAST(c_custkey AS STRING) AS id, c_mktsegment AS segment, c_name AS name, 'Jr.' AS first_extra FROM customer WHERE c_acctbal < 0",
    "file_admission": f"""SELECT c_mktsegment AS segment, CAST(sum(strlen({_LINE}) + 1) AS BIGINT) AS length,
        'Unsupported file type ''.txt''. Only CSV files are accepted.' AS reject_reason FROM customer GROUP BY 1""",
    "file_fingerprints": f"""SELECT c_mktsegment AS segment, CAST(sum(strlen({_LINE}) + 1) AS BIGINT) AS length,
        sha256(string_agg({_LINE} || chr(10), '' ORDER BY c_custkey)) AS sha256 FROM customer GROUP BY 1""",
    "integrity_check": """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' ELSE c_mktsegment END AS dataset_id,
        CASE WHEN c_acctbal < 0 THEN 'not_found' WHEN c_mktsegment = 'MACHINERY' THEN 'invalid' WHEN c_mktsegment = 'BUILDING' THEN 'missing_file'
             WHEN c_mktsegment = 'FURNITURE' THEN 'hash_mismatch' ELSE 'ok' END AS status FROM customer""",
    "file_existence": """SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' ELSE c_mktsegment END AS storage_path, c_acctbal >= 0 AS file_exists FROM customer""",
    "landing_sink": with_tables(
        """SELECT 'a' AS dataset_id, flag, CAST(count(*) AS BIGINT) AS n_rows FROM raw_lines GROUP BY flag
        UNION ALL SELECT 'b', flag, CAST(count(*) AS BIGINT) FROM raw_lines WHERE flag = 'N' GROUP BY flag""", "raw_lines",
    ),
    "dataset_ingest": with_tables(
        """SELECT 'd1' AS id, 'lines.csv' AS filename, 'raw_lines' AS schema_name, CAST(count(*) AS BIGINT) AS n_rows, 7 AS n_columns, FALSE AS is_valid,
        CAST(count(*) - count(DISTINCT (quantity, discount, nullif(tax, ''), linestatus, flag, supplier_hint)) AS BIGINT) AS duplicates FROM raw_lines""",
        "raw_lines",
    ),
    "prediction_log_append": with_tables(
        """SELECT id, request_id, prediction, round(probability, 6) AS probability FROM predictions
        WHERE model_version_id = '7' AND created_at >= TIMESTAMP '1999-07-01' AND created_at < TIMESTAMP '2000-07-01'""", "predictions",
    ),
    "registry_publish": with_tables("SELECT id, stage FROM model_versions WHERE stage <> 'archived'", "model_versions"),
    "access_log_json": with_tables(
        """WITH c AS (SELECT method, endpoint AS path, status_code, CAST(count(*) AS BIGINT) AS n FROM access_log WHERE status_code <> 500 GROUP BY 1, 2, 3)
        SELECT *, FALSE AS is_total FROM c UNION ALL SELECT NULL, NULL, NULL, CAST(sum(n) AS BIGINT), TRUE FROM c""", "access_log",
    ),
}
