"""From an uploaded CSV to a catalog row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.operators import quality
from tabwatch.schema import DatasetContract, MonitorConfig
from tabwatch.sources import csv, files, tables


class RejectedUpload(ValueError):
    """The file cannot be read as a dataset at all: wrong type, too large, empty or malformed."""


def ingest_csv(
    spark: SparkSession,
    path: str,
    contract: DatasetContract,
    *,
    dataset_id: str,
    filename: str,
    landing: str,
    catalog: str,
    as_of: Column,
    config: MonitorConfig = MonitorConfig(),
) -> DataFrame:
    """Admits, lands and checks one upload and appends its catalog row, which is returned.

    The rows are landed before the verdict, so an invalid dataset can still be inspected; whether it
    is valid stands in the row, together with the report. The raw file is parsed once: the checks
    read the landed Parquet.
    """
    admitted = files.admission(files.list_files(spark, path), config)
    first = admitted.orderBy(F.col("reject_reason").isNull(), "path").head(1)
    if not first:
        raise RejectedUpload(files.EMPTY)
    if first[0]["reject_reason"]:
        raise RejectedUpload(first[0]["reject_reason"])
    rows, rejects = csv.split_malformed(csv.read_raw_csv(spark, path))
    bad = rejects.head(1)
    if bad:
        raise RejectedUpload(f"Could not parse file as CSV: a record does not fit the columns, at {bad[0][csv.OVERFLOW]!r}")
    tables.land_rows(rows, dataset_id, landing)
    landed = spark.read.parquet(landing).where(F.col("dataset_id") == dataset_id).select(*[f"`{c}`" for c in rows.columns])
    digest = files.content_hash(files.fingerprints(spark, path), path).scalar()
    report = quality.report(landed, contract, config)
    row = report.select(
        F.lit(dataset_id).alias("id"),
        F.lit(filename).alias("filename"),
        F.lit(contract.name).alias("schema_name"),
        F.lit(path).alias("storage_path"),
        digest.alias("content_hash"),
        "n_rows",
        "n_columns",
        "is_valid",
        F.to_json(F.struct(*report.columns)).alias("quality_report"),
        as_of.alias("uploaded_at"),
    )
    tables.append(row, catalog)
    return spark.read.parquet(catalog).where(F.col("id") == dataset_id)
