"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabwatch.queries import (
    drift_queries,
    feature_queries,
    file_queries,
    listing_queries,
    monitoring_queries,
    quality_queries,
    registry_queries,
    stream_queries,
    training_queries,
)

_MODULES = (
    drift_queries, quality_queries, monitoring_queries, listing_queries, registry_queries,
    feature_queries, training_queries, file_queries, stream_queries,
)

Query = Callable[[SparkSession, str], DataFrame]


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def all_queries() -> dict[str, Query]:
    return {name: _in_utc(q) for module in _MODULES for name, q in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
