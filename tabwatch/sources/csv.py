"""Raw CSV scans: every column is text, nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwatch.functions.coerce import null_na_tokens

OVERFLOW = "_overflow"
# What a field beyond the last column holds if it is empty, and a record that cannot be parsed at all.
EMPTY_FIELD, BROKEN = "(empty)", "(broken record)"
_CORRUPT = "_corrupt"


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line; only that line is parsed."""
    return spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"').columns


def read_raw_csv(
    spark: SparkSession, path: str | list[str], *, columns: Sequence[str] | None = None, header: bool | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """String-typed rows with NA texts as nulls, plus `_overflow`.

    `path` may be local or on any Hadoop file system; its scheme decides. Without `columns` the names
    come from the header line; with them the files have no header line unless `header` says so. A quoted field may hold line breaks,
    which keeps a file whole in one task; `multi_line=False` splits large files and is for data known to
    have none. `_overflow` is set for malformed rows: it holds the first field beyond the last column,
    EMPTY_FIELD if that is empty, or BROKEN if a quote is never closed. Short rows are filled with nulls.
    """
    names = header_columns(spark, path) if columns is None else list(columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, _CORRUPT)])
    # The header was read above, so names are taken by position. Records are only compared with the columns if all
    # of their fields are parsed, hence no column pruning.
    raw = spark.read.schema(schema).option("columnPruning", "false").csv(
        path, header=columns is None if header is None else header, enforceSchema=True, quote='"', escape='"', multiLine=multi_line,
        mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT,
    )
    return null_na_tokens(_with_overflow(raw, names), names)


def _with_overflow(raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """`_overflow` from the text that the parser keeps of records with another number of fields than columns."""
    text = F.col(_CORRUPT)
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"')))
    commas = F.length(F.regexp_replace(F.regexp_replace(text, '"(?:[^"]|"")*+"', ""), "[^,]", ""))
    layout = ", ".join(f"c{k} string" for k in range(len(names) + 1))
    field = F.from_csv(text, layout, {"quote": '"', "escape": '"'})[f"c{len(names)}"]
    fault = F.when(quotes % 2 == 1, BROKEN).when(commas >= len(names), F.coalesce(F.nullif(field, F.lit("")), F.lit(EMPTY_FIELD)))
    # Spark refuses plans that read nothing but the kept text, so the first column is named too; it adds nothing.
    nothing = F.nullif(F.col(f"`{names[0]}`"), F.col(f"`{names[0]}`"))
    return raw.withColumn(OVERFLOW, F.coalesce(fault, nothing)).drop(_CORRUPT)


def split_malformed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of `read_raw_csv`."""
    return raw.where(F.col(OVERFLOW).isNull()).drop(OVERFLOW), raw.where(F.col(OVERFLOW).isNotNull())


def write_raw_csv(df: DataFrame, path: str, max_records: int = 0) -> None:
    """CSV that reads back unchanged: the writer would trim blanks by default. `max_records` bounds each file's rows."""
    df.write.option("maxRecordsPerFile", max_records).csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
