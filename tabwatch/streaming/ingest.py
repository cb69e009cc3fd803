"""Exactly-once ingestion of a directory of uploaded files behind the quality gate."""

from __future__ import annotations

import csv as csv_lines
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwatch.operators import quality
from tabwatch.schema import DatasetContract, MonitorConfig
from tabwatch.session import stored
from tabwatch.sources import csv, files

# Layout of the binary file source.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_stream(
    spark: SparkSession,
    directory: str,
    contract: DatasetContract,
    catalog: str,
    checkpoint: str,
    *,
    config: MonitorConfig = MonitorConfig(),
    pattern: str = "*",
    max_files: int = 100,
    keep_hashes: str = "7 days",
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Checks every new file once and writes (path, length, sha256, reject_reason, n_rows, n_errors, checks, is_valid).

    The stream's checkpoint remembers the files seen, a second copy of the same bytes is dropped by
    its hash, and a replayed batch overwrites its own output. Admitted files of a micro-batch with the
    same header line are profiled in one job, grouped by path.
    """
    arriving = (
        spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).load(directory)
    )
    listed = files.admission(arriving, config).select(
        "path", "modificationTime", "length", "reject_reason",
        # The bytes of refused files are not hashed; each of these counts as its own content.
        F.when(F.col("reject_reason").isNull(), F.sha2("content", 256)).otherwise(F.col("path")).alias("sha256"),
        F.when(F.col("reject_reason").isNull(), _header_line(F.col("content"))).alias("header"),
    )
    fresh = listed.withWatermark("modificationTime", keep_hashes).dropDuplicatesWithinWatermark(["sha256"])

    def write(batch: DataFrame, batch_id: int) -> None:
        check_batch(batch, contract, config).write.mode("overwrite").parquet(f"{catalog}/batch_id={batch_id}")

    writer = fresh.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def _header_line(content: Column) -> Column:
    text = F.regexp_replace(F.decode(content, "UTF-8"), "^\ufeff", "")
    return F.regexp_replace(F.substring_index(text, "\n", 1), "\r$", "")


def _names(header: str) -> list[str]:
    """Column names of a header line; a name that comes again gets its place, so that names stay apart."""
    found = next(csv_lines.reader([header]), [])
    return [n if n not in found[:k] else f"{n}.{k}" for k, n in enumerate(found)]


def check_batch(batch: DataFrame, contract: DatasetContract, config: MonitorConfig) -> DataFrame:
    """Quality verdict per file of a batch (path, length, sha256, reject_reason, header).

    Columns are known by the names in each file's own header line, in any order. `checks` lists the findings;
    a file with a header only has 0 rows, which is an error, and so are records that do not fit the columns.
    """
    spark = batch.sparkSession
    # The paths and header lines of one micro-batch, at most max_files of them.
    by_header: dict[str, list[str]] = {}
    for r in batch.where(F.col("reject_reason").isNull()).select("path", "header").collect():
        by_header.setdefault(r["header"], []).append(r["path"])
    own = batch.select("path", "length", F.when(F.col("reject_reason").isNull(), F.col("sha256")).alias("sha256"), "reject_reason")
    found = [_check_files(spark, paths, _names(header), contract, config) for header, paths in by_header.items()]
    if not found:
        nothing = {"n_rows": "bigint", "n_errors": "bigint", "checks": "string", "is_valid": "boolean"}
        return own.withColumns({n: F.lit(None).cast(t) for n, t in nothing.items()})
    checked = functools.reduce(DataFrame.unionByName, found)
    return own.withColumn("_key", _key("path")).join(checked, "_key", "left").drop("_key").withColumn("is_valid", F.col("n_errors") == 0)


def _key(path: str) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def _check_files(spark: SparkSession, paths: list[str], names: list[str], contract: DatasetContract, config: MonitorConfig) -> DataFrame:
    """(_key, n_rows, n_errors, checks) of files with the same header."""
    raw = csv.read_raw_csv(spark, paths, columns=names, header=True).withColumn("path", F.col("_metadata.file_path"))
    rows, rejects = csv.split_malformed(raw)
    malformed = rejects.groupBy("path").agg(F.lit("malformed_records").alias("check"), F.lit(quality.ERROR).alias("severity"))
    prof = stored(quality.profile(rows, contract, ["path"]), "profile") if not quality.missing_columns(rows, contract) else None
    if prof is None:  # values are checked only where all columns are there
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"))
        issues = sizes.select("path", F.lit("required_columns").alias("check"), F.lit(quality.ERROR).alias("severity"))
        if [c for c in quality.unexpected_columns(rows, contract) if c != "path"]:
            warning = F.lit(quality.WARNING).alias("severity")
            issues = issues.unionByName(sizes.select("path", F.lit("unexpected_columns").alias("check"), warning))
    else:
        sizes = prof.transform(quality.of_metric, "n_rows").select("path", F.col("value").alias("n_rows"))
        issues = quality.issues(rows, contract, config, prof, ["path"]).select("path", "check", "severity")
    issues = issues.unionByName(malformed)
    every = spark.createDataFrame([(p,) for p in paths], "path string").select(_key("path").alias("_key"))
    sized = sizes.groupBy(_key("path").alias("_key")).agg(F.max("n_rows").alias("n_rows"))
    empty = every.join(sized.where("n_rows > 0"), "_key", "left_anti")
    none = [("non_empty", quality.ERROR)] + ([("required_columns", quality.ERROR)] if set(contract.required) - set(names) else [])
    listed = issues.select(_key("path").alias("_key"), "check", "severity")
    for check, severity in none:
        listed = listed.unionByName(empty.select("_key", F.lit(check).alias("check"), F.lit(severity).alias("severity")))
    verdict = listed.groupBy("_key").agg(
        F.count_if(F.col("severity") == quality.ERROR).alias("n_errors"),
        F.array_join(F.array_sort(F.collect_set("check")), ",").alias("checks"),
    )
    return every.join(sized, "_key", "left").join(verdict, "_key", "left").select(
        "_key", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce("n_errors", F.lit(0)).cast("bigint").alias("n_errors"), F.coalesce("checks", F.lit("")).alias("checks"),
    )
