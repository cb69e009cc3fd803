"""Session helpers: settings, table reads and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tabwatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _local_fallback(app_id: str) -> str:
    return tempfile.mkdtemp(prefix="tabwatch-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's `spark.checkpoint.dir`.

    A temporary folder stands in only for a local master, where driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors.")
        configured = _local_fallback(context.applicationId)
    return configured.rstrip("/")


def new_workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh, unused folder below the shared one."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"



def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes an intermediate table to the shared folder and returns it read back.

    For aggregated tables that several branches of a plan read: the input is scanned once whatever
    the optimizer shares, a lost executor costs no second pass over it, and later joins know its size.
    """
    path = new_workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
