"""Quality queries over a damaged, all-text copy of the line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.functions.coerce import null_na_tokens
from tabwatch.operators import quality
from tabwatch.queries.tables import RAW_CONTRACT, load, with_tables

CONTRACT = RAW_CONTRACT


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "raw_lines")


def _metric(spark: SparkSession, sf_dir: str, metric: str, *columns) -> DataFrame:
    return quality.profile(_raw(spark, sf_dir), CONTRACT).where(F.col("metric") == metric).select(*columns)


def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile(_raw(spark, sf_dir), CONTRACT).select("metric", "name", "value")


def quality_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quality.column_counts(_raw(spark, sf_dir), CONTRACT).where(F.col("metric") == "missing")
    return counts.select(
        F.col("name").alias("column_name"), F.col("value").alias("missing_count"),
        F.round(F.col("value") / F.col("n_rows"), 6).alias("missing_fraction"),
    )


def quality_non_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quality.column_counts(_raw(spark, sf_dir), CONTRACT).where(F.col("metric") == "non_numeric")
    return counts.select(F.col("name").alias("column_name"), F.col("value").alias("invalid_count"))


def _keys(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return quality.key_counts(load(spark, sf_dir, "raw_lines"), RAW_CONTRACT, only=[kind])


def quality_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(spark, sf_dir, "duplicate_ids").select(F.col("value").alias("duplicate_id_count"))


def quality_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(spark, sf_dir, "duplicate_rows").select(F.col("value").alias("duplicate_row_count"))


def quality_duplicate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order status, how many orders repeat an earlier order of the same customer and priority."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    flagged = quality.duplicate_flags(orders, ["o_custkey", "o_orderpriority"], ["o_orderkey"])
    return flagged.groupBy("o_orderstatus").agg(
        F.count_if("is_duplicate").alias("n_duplicate"), F.count_if(~F.col("is_duplicate")).alias("n_first")
    )


def quality_class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.class_balance(_raw(spark, sf_dir), CONTRACT)


def quality_label_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof = quality.profile(_raw(spark, sf_dir), CONTRACT)
    return quality.label_findings(prof, CONTRACT).select("kind", "n", F.array_join("labels", ", ").alias("labels"))


def quality_column_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without two contract columns: only column, emptiness and content checks apply."""
    raw = _raw(spark, sf_dir).drop("discount", "flag")
    found = quality.issues(raw, CONTRACT)
    return found.select("check", "severity", "message", F.to_json("details").alias("details"))


def quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.issues(_raw(spark, sf_dir), CONTRACT)
    return found.select("check", "severity", "message", "position", F.array_join(F.map_keys("details"), ",").alias("keys"))


def quality_small_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads of growing size, checked in one job; those below the least number of rows."""
    order = F.split_part("line_id", F.lit("-"), F.lit(1)).cast("bigint")
    uploads = _raw(spark, sf_dir).withColumn("upload", F.floor(F.sqrt(order)).cast("string"))
    found = quality.issues(uploads, CONTRACT, by=["upload"]).where(F.col("check") == "minimum_row_count")
    counts = [F.col("details")[k].cast("bigint").alias(k) for k in ("row_count", "minimum_required")]
    return found.select("upload", "check", "severity", "message", *counts)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = quality.report(_raw(spark, sf_dir), CONTRACT)
    return nested.select(
        "n_rows", "n_columns", "is_valid", "duplicate_row_count",
        F.size("issues").cast("bigint").alias("n_issues"),
        F.array_join(F.transform("issues", lambda i: i["check"]), ",").alias("checks"),
        F.element_at("column_null_counts", "linestatus").alias("missing_linestatus"),
        F.element_at("class_balance", "R").alias("n_positive"),
    )


def quality_na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing counts after NA texts have been turned into nulls."""
    clean = null_na_tokens(_raw(spark, sf_dir))
    return clean.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("quantity", "discount", "tax", "linestatus", "flag")])


def row_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per distinct set of input-contract breaches; tax is optional, quantity an integer."""
    checked = quality.row_violations(_raw(spark, sf_dir), CONTRACT, integers=["quantity"], optional=["tax"])
    return checked.groupBy(F.array_join("violations", "; ").alias("violations")).agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES = {
    f.__name__: f
    for f in (
        quality_profile, quality_missing, quality_non_numeric, quality_duplicate_ids, quality_duplicate_rows,
        quality_duplicate_flags, quality_class_balance, quality_label_issues, quality_column_issues,
        quality_issues, quality_small_uploads, quality_report, quality_na_tokens, row_contract_violations,
    )
}

# The oracle's own reading of "blank" and "not a number".
_BLANK = "({c} IS NULL OR trim({c}, ' \t\n\r') = '')"
_BAD = "({c} IS NOT NULL AND trim({c}, ' \t\n\r') <> '' AND NOT regexp_full_match(trim({c}, ' \t\n\r'), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?'))"
_FEATURES = ("quantity", "discount", "tax", "linestatus")


def _sql(body: str) -> str:
    return with_tables(body, "raw_lines")


_MISSING = " UNION ALL ".join(
    f"SELECT 'missing' AS metric, '{c}' AS name, count(*) FILTER ({_BLANK.format(c=c)}) AS value FROM raw_lines" for c in _FEATURES
)
_INVALID = " UNION ALL ".join(
    f"SELECT 'non_numeric' AS metric, '{c}' AS name, count(*) FILTER ({_BAD.format(c=c)}) AS value FROM raw_lines"
    for c in ("quantity", "discount", "tax")
)
_CONTENT = "quantity, discount, tax, linestatus, flag, supplier_hint"
_PROFILE = f"""
    SELECT metric, name, CAST(value AS BIGINT) AS value FROM (
      SELECT 'n_rows' AS metric, CAST(NULL AS VARCHAR) AS name, count(*) AS value FROM raw_lines
      UNION ALL {_MISSING} UNION ALL {_INVALID}
      UNION ALL SELECT 'missing_target', 'flag', count(*) FILTER (flag IS NULL) FROM raw_lines
      UNION ALL SELECT 'duplicate_ids', NULL, sum(n - 1) FROM (SELECT count(*) AS n FROM raw_lines GROUP BY line_id) a
      UNION ALL SELECT 'duplicate_rows', NULL, sum(n - 1) FROM (SELECT count(*) AS n FROM raw_lines GROUP BY {_CONTENT}) b
      UNION ALL SELECT 'label', flag, count(*) FROM raw_lines WHERE flag IS NOT NULL GROUP BY flag) p"""

_ISSUES = """
        SELECT 'unexpected_columns' AS "check", 'warning' AS severity,
               'Dataset contains columns not in the expected schema; they will be ignored.' AS message, 2 AS position, 'extra_columns' AS keys
        UNION ALL SELECT metric, 'error', 'Found ' || value || ' duplicate value(s) in id column ''line_id''.', 4, 'duplicate_id_count'
          FROM prof WHERE metric = 'duplicate_ids' AND value > 0
        UNION ALL SELECT metric, 'warning', 'Found ' || value || ' row(s) with duplicate feature values (different ids).', 5, 'duplicate_row_count'
          FROM prof WHERE metric = 'duplicate_rows' AND value > 0
        UNION ALL SELECT 'missing_values', 'warning', 'Column ''' || name || ''' has ' || value || ' missing/blank value(s); will be imputed during preprocessing.',
          13, 'column,missing_count' FROM prof WHERE metric = 'missing' AND name = 'tax' AND value > 0
        UNION ALL SELECT 'missing_values', CASE WHEN value > 0.5 * n THEN 'error' ELSE 'warning' END,
          'Column ''' || name || ''' has ' || value || ' missing/blank value(s) (' || printf('%.1f', 100.0 * value / n) || '%).',
          CASE name WHEN 'quantity' THEN 11 WHEN 'discount' THEN 12 ELSE 14 END, 'column,missing_count,missing_fraction'
          FROM prof, total WHERE metric = 'missing' AND name <> 'tax' AND value > 0
        UNION ALL SELECT 'missing_target', 'error', 'Target column ''flag'' has ' || value || ' missing value(s).', 15, 'missing_count'
          FROM prof WHERE metric = 'missing_target' AND value > 0
        UNION ALL SELECT 'dtype_numeric', CASE WHEN name = 'tax' THEN 'warning' ELSE 'error' END,
          CASE WHEN name = 'tax' THEN 'Column ''tax'' has ' || value || ' non-numeric value(s); will be coerced/imputed.'
               ELSE 'Column ''' || name || ''' expected numeric values but found ' || value || ' that aren''t.' END,
          CASE name WHEN 'quantity' THEN 25 WHEN 'discount' THEN 26 ELSE 27 END, 'column,invalid_count'
          FROM prof WHERE metric = 'non_numeric' AND value > 0
        UNION ALL SELECT 'target_labels', 'error', 'Target column ''flag'' has unexpected label(s).', 37, 'unexpected_labels'
          WHERE EXISTS (SELECT 1 FROM prof WHERE metric = 'label' AND name NOT IN ('R', 'N'))"""

ORACLES = {
    "quality_small_uploads": _sql(
        """SELECT CAST(CAST(floor(sqrt(CAST(split_part(line_id, '-', 1) AS BIGINT))) AS BIGINT) AS VARCHAR) AS upload, 'minimum_row_count' AS "check",
            'error' AS severity, concat('Dataset has ', count(*), ' rows; at least 50 are required for training.') AS message,
            CAST(count(*) AS BIGINT) AS row_count, CAST(50 AS BIGINT) AS minimum_required
        FROM raw_lines GROUP BY 1 HAVING count(*) < 50"""
    ),
    "quality_profile": _sql(_PROFILE),
    "quality_missing": _sql(
        f"""SELECT name AS column_name, CAST(value AS BIGINT) AS missing_count,
            round(value / (SELECT count(*) FROM raw_lines), 6) AS missing_fraction FROM ({_MISSING}) m"""
    ),
    "quality_non_numeric": _sql(f"SELECT name AS column_name, CAST(value AS BIGINT) AS invalid_count FROM ({_INVALID}) m"),
    "quality_duplicate_ids": _sql(
        "SELECT CAST(count(*) - count(DISTINCT line_id) AS BIGINT) AS duplicate_id_count FROM raw_lines"
    ),
    "quality_duplicate_rows": _sql(
        f"SELECT CAST((SELECT count(*) FROM raw_lines) - (SELECT count(*) FROM (SELECT DISTINCT {_CONTENT} FROM raw_lines) d) AS BIGINT) AS duplicate_row_count"
    ),
    "quality_duplicate_flags": """
        SELECT o_orderstatus, CAST(count(*) FILTER (rn > 1) AS BIGINT) AS n_duplicate, CAST(count(*) FILTER (rn = 1) AS BIGINT) AS n_first
        FROM (SELECT o_orderstatus, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) o
        GROUP BY o_orderstatus""",
    "quality_class_balance": _sql(
        "SELECT flag AS label, CAST(count(*) AS BIGINT) AS n_rows FROM raw_lines WHERE flag IS NOT NULL GROUP BY flag"
    ),
    "quality_label_issues": _sql(
        """SELECT 'target_unexpected' AS kind, CAST(count(DISTINCT flag) AS BIGINT) AS n,
                  string_agg(DISTINCT CASE WHEN flag NOT IN ('R', 'N') THEN flag END, ', ') AS labels
           FROM raw_lines HAVING count(DISTINCT CASE WHEN flag NOT IN ('R', 'N') THEN flag END) > 0"""
    ),
    "quality_column_issues": _sql(
        """SELECT * FROM (VALUES
             ('required_columns', 'error', 'Dataset is missing 2 required column(s).', '{"missing_columns":"discount, flag"}'),
             ('unexpected_columns', 'warning', 'Dataset contains columns not in the expected schema; they will be ignored.',
              '{"extra_columns":"supplier_hint"}')) v("check", severity, message, details)
           WHERE EXISTS (SELECT 1 FROM raw_lines)"""
    ),
    "quality_issues": _sql(f"WITH prof AS ({_PROFILE}), total AS (SELECT value AS n FROM prof WHERE metric = 'n_rows') {_ISSUES}"),
    "quality_report": _sql(
        f"""WITH prof AS ({_PROFILE}), total AS (SELECT value AS n FROM prof WHERE metric = 'n_rows'), found AS ({_ISSUES})
        SELECT (SELECT value FROM prof WHERE metric = 'n_rows') AS n_rows, CAST(7 AS INT) AS n_columns,
               NOT EXISTS (SELECT 1 FROM found WHERE severity = 'error') AS is_valid,
               (SELECT value FROM prof WHERE metric = 'duplicate_rows') AS duplicate_row_count,
               (SELECT CAST(count(*) AS BIGINT) FROM found) AS n_issues,
               (SELECT string_agg("check", ',' ORDER BY position) FROM found) AS checks,
               (SELECT value FROM prof WHERE metric = 'missing' AND name = 'linestatus') AS missing_linestatus,
               (SELECT value FROM prof WHERE metric = 'label' AND name = 'R') AS n_positive"""
    ),
    "quality_na_tokens": _sql(
        "SELECT " + ", ".join(
            f"CAST(count(*) FILTER ({c} IS NULL OR {c} IN ('', 'NA', 'N/A', 'n/a', 'null', 'NULL', 'nan', 'NaN', 'None')) AS BIGINT) AS {c}"
            for c in ("quantity", "discount", "tax", "linestatus", "flag")
        ) + " FROM raw_lines"
    ),
    "row_contract_violations": _sql(
        f"""SELECT array_to_string(list_sort(list_filter([
              CASE WHEN quantity IS NULL THEN 'quantity: required' WHEN {_BAD.format(c="quantity")} OR trim(quantity) = '' THEN 'quantity: not a number' END,
              CASE WHEN discount IS NULL THEN 'discount: required' WHEN {_BAD.format(c="discount")} OR trim(discount) = '' THEN 'discount: not a number' END,
              CASE WHEN tax IS NOT NULL AND ({_BAD.format(c="tax")} OR trim(tax) = '') THEN 'tax: not a number' END,
              CASE WHEN linestatus IS NULL THEN 'linestatus: required' END], lambda v: v IS NOT NULL)), '; ') AS violations,
            CAST(count(*) AS BIGINT) AS n_rows FROM raw_lines GROUP BY 1"""
    ),
}
