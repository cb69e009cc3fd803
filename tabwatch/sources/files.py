"""Whole files: admission, fingerprints, existence and integrity."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.functions.text import file_suffix
from tabwatch.schema import MonitorConfig


EMPTY = "Uploaded file is empty."  # fixed value


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length); the content column is pruned, so nothing is read.

    The source leaves out files of zero bytes: an empty upload is one that is not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length")


def _max_bytes(config: MonitorConfig) -> int:
    return config.max_upload_mb * 1024 * 1024


def admission(files: DataFrame, config: MonitorConfig = MonitorConfig()) -> DataFrame:
    """Adds `reject_reason`; null for files that may be ingested."""
    suffix = file_suffix(F.col("path"))
    mb = F.col("length") / (1024 * 1024)
    # Texts of the refusals.
    reason = (
        F.when(~suffix.isin(*config.allowed_suffixes), F.concat(F.lit("Unsupported file type '"), suffix, F.lit("'. Only CSV files are accepted.")))
        .when(F.col("length") > _max_bytes(config), F.format_string(f"File size %.1fMB exceeds the {config.max_upload_mb}MB limit.", mb))
        .when(F.col("length") == 0, EMPTY)
    )
    return files.withColumn("reject_reason", reason)


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of every stored file, whatever its size: refusing an upload is for `admission`.

    A file is one row, so it is bounded by what the binary file source reads into one (2 GB).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def content_hash(hashes: DataFrame, root: str) -> DataFrame:
    """One row: the hash of an upload. That of a single file is the file's; several files have that of their sorted
    list of relative path and hash, so a change in any of them shows."""
    relative = F.regexp_replace("path", F.lit("^.*" + re.escape(root.rstrip("/").rpartition("/")[2])), F.lit(""))
    parts = F.array_sort(F.collect_list(F.struct(relative.alias("name"), "sha256")))
    listed = F.sha2(F.array_join(F.transform(parts, lambda p: F.concat_ws(":", p["name"], p["sha256"])), "\n"), 256)
    return hashes.agg(F.when(F.count("*") == 1, F.min("sha256")).otherwise(listed).alias("content_hash"))


def existing(datasets: DataFrame, files: DataFrame, key: Column) -> DataFrame:
    """Catalog rows with `file_exists`; `key` derives a file's storage path from its listing."""
    listed = files.select(key.alias("storage_path")).distinct().withColumn("_found", F.lit(True))
    return datasets.join(listed, "storage_path", "left").withColumn("file_exists", F.coalesce("_found", F.lit(False))).drop("_found")


def verified_runs(artifacts: DataFrame, run_id: Column) -> DataFrame:
    """Run ids that have at least one artifact file; anything not listed counts as absent."""
    return artifacts.select(run_id.alias("run_id")).where(F.length("run_id") > 0).distinct()


def integrity(requested: DataFrame, datasets: DataFrame, hashes: DataFrame) -> DataFrame:
    """Status of each requested dataset before training.

    `requested` has dataset_id; `hashes` has storage_path and sha256 of what is stored now. The first
    failing check names the status: not_found, invalid, missing_file, hash_mismatch, else ok.
    """
    return _compared(requested, datasets, hashes).select(*requested.columns, "status")


def integrity_errors(requested: DataFrame, datasets: DataFrame, hashes: DataFrame) -> DataFrame:
    """`requested` with the `error` that stops a training job, null where its dataset may be used."""
    named = F.concat(F.lit("Dataset "), F.coalesce("dataset_id", F.lit("None")))
    # The messages of refused training jobs.
    error = (
        F.when(F.col("status") == "not_found", F.concat(named, F.lit(" not found.")))
        .when(F.col("status") == "invalid", F.concat(named, F.lit(" failed validation at ingestion and cannot be used for training.")))
        .when(F.col("status") == "missing_file", F.concat(F.lit("Dataset file is missing: "), "_path"))
        .when(F.col("status") == "hash_mismatch", F.concat(
            named, F.lit(" content hash mismatch: recorded "), "_recorded", F.lit(", file on disk now hashes to "), "_now",
            F.lit(". The file may have been modified since ingestion — refusing to train on it."),
        ))
    )
    return _compared(requested, datasets, hashes).select(*requested.columns, error.alias("error"))


def _compared(requested: DataFrame, datasets: DataFrame, hashes: DataFrame) -> DataFrame:
    known = datasets.select(
        F.col("id").alias("_id"), F.col("is_valid").alias("_valid"), F.col("storage_path").alias("_path"),
        F.col("content_hash").alias("_recorded"), F.lit(True).alias("_known"),
    )
    now = hashes.select(F.col("storage_path").alias("_at"), F.col("sha256").alias("_now"))
    status = (
        F.when(F.col("_known").isNull(), "not_found")
        .when(~F.col("_valid"), "invalid")
        .when(F.col("_now").isNull(), "missing_file")
        .when(F.col("_now") != F.col("_recorded"), "hash_mismatch")
        .otherwise("ok")
    )
    found = requested.join(known, F.col("dataset_id") == F.col("_id"), "left").join(now, F.col("_path") == F.col("_at"), "left")
    return found.withColumn("status", status)
