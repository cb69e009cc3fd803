"""Data-quality checks of a raw, string-typed dataset against its contract.

`profile` measures everything in two passes over the data: one wide aggregate over all columns, and
one grouping that serves duplicate ids, duplicate contents and label counts together. `issues` turns
the small profile into findings; `report` nests them into one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwatch.functions.coerce import is_blank, is_non_numeric, strip, stripped_to_numeric, to_numeric
from tabwatch.schema import DatasetContract, MonitorConfig
from tabwatch.session import stored

ERROR, WARNING = "error", "warning"

# Message texts of the findings.
MESSAGES = {
    "non_empty": "Uploaded dataset has zero rows.",
    "required_columns": "Dataset is missing %d required column(s).",
    "unexpected_columns": "Dataset contains columns not in the expected schema; they will be ignored.",
    "minimum_row_count": "Dataset has %d rows; at least %d are required for training.",
    "duplicate_ids": "Found %d duplicate value(s) in id column '%s'.",
    "duplicate_rows": "Found %d row(s) with duplicate feature values (different ids).",
    "missing_coercible": "Column '%s' has %d missing/blank value(s); will be imputed during preprocessing.",
    "missing_values": "Column '%s' has %d missing/blank value(s) (%.1f%%).",
    "missing_target": "Target column '%s' has %d missing value(s).",
    "dtype_coercible": "Column '%s' has %d non-numeric value(s); will be coerced/imputed.",
    "dtype_numeric": "Column '%s' expected numeric values but found %d that aren't.",
    "target_unexpected": "Target column '%s' has unexpected label(s).",
    "target_classes": "Target column '%s' must have at least 2 distinct classes; found %d.",
}


def missing_columns(df: DataFrame, contract: DatasetContract) -> list[str]:
    return [c for c in contract.required if c not in df.columns]


def unexpected_columns(df: DataFrame, contract: DatasetContract) -> list[str]:
    return [c for c in df.columns if c not in contract.required]


def content_key(columns: Sequence[str]) -> Column:
    """256-bit fingerprint of the listed columns; null and empty text differ, null equals null.

    It stands in for the row itself in the shuffle, whose width then does not depend on the table.
    """
    return F.unhex(F.sha2(F.to_json(F.array(*[F.col(f"`{c}`").cast("string") for c in columns])), 256))


def _entry(metric: str, column: str | None, value: Column) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"), F.lit(column).cast("string").alias("name"), value.cast("bigint").alias("value")
    )


def column_counts(df: DataFrame, contract: DatasetContract, by: Sequence[str] = ()) -> DataFrame:
    """(by, metric, name, value, n_rows) for missing, non-numeric and missing-target counts: one aggregate."""
    missing = set(missing_columns(df, contract))
    measures = {("n_rows", None): F.count(F.lit(1))}
    if not missing:
        for c in contract.features:
            measures["missing", c] = F.count_if(is_blank(F.col(f"`{c}`")))
        target = contract.target_column
        measures["missing_target", target] = F.count_if(F.col(f"`{target}`").isNull())
        for c in contract.numeric_columns:
            measures["non_numeric", c] = F.count_if(is_non_numeric(F.col(f"`{c}`")))
    wide = df.groupBy(*by).agg(*[m.alias(f"_m{i}") for i, m in enumerate(measures.values())])
    entries = [_entry(metric, c, F.col(f"_m{i}")) for i, (metric, c) in enumerate(measures)]
    return wide.select(*by, F.col("_m0").alias("n_rows"), F.explode(F.array(*entries)).alias("_e")).select(*by, "_e.*", "n_rows")


KEY_KINDS = ("duplicate_rows", "duplicate_ids", "label")


def key_counts(df: DataFrame, contract: DatasetContract, by: Sequence[str] = (), only: Sequence[str] = KEY_KINDS) -> DataFrame:
    """(by, metric, name, value) for duplicate ids, duplicate contents and one row per label, or `only` some of them.

    Every row is spread over the keys it is counted under, so the table is read once and the
    rows of a very frequent key meet in the map-side partial aggregate. Null keys count as equal.
    """
    content = [c for c in df.columns if c != contract.id_column and c not in by]
    kinds = [F.struct(F.lit("duplicate_rows").alias("kind"), F.base64(content_key(content)).alias("key"))]
    if not missing_columns(df, contract):
        for kind, c in (("duplicate_ids", contract.id_column), ("label", contract.target_column)):
            kinds.append(F.struct(F.lit(kind).alias("kind"), F.col(f"`{c}`").cast("string").alias("key")))
    kinds = [k for kind, k in zip(KEY_KINDS, kinds) if kind in only]
    per_key = (
        df.select(*by, F.explode(F.array(*kinds)).alias("_k"))
        .groupBy(*by, "_k.kind", "_k.key").agg(F.count(F.lit(1)).alias("n"))
    )
    is_label = F.col("kind") == "label"
    return (
        per_key.groupBy(*by, F.col("kind").alias("metric"), F.when(is_label, F.col("key")).alias("name"))
        .agg(F.sum(F.when(is_label, F.col("n")).otherwise(F.col("n") - 1)).alias("value"))
        .where((F.col("metric") != "label") | F.col("name").isNotNull())
    )


def profile(df: DataFrame, contract: DatasetContract, by: Sequence[str] = ()) -> DataFrame:
    """Long profile (by, metric, name, value, n_rows): everything the findings are decided on.

    With `by` (for example a file path) many datasets of the same layout are profiled in one job.
    """
    return column_counts(df, contract, by).unionByName(
        key_counts(df, contract, by).withColumn("n_rows", F.lit(None).cast("bigint"))
    )


def of_metric(prof: DataFrame, *metrics: str, above: int = -1) -> DataFrame:
    """Profile rows of the given metrics with a value above a bound."""
    return prof.where(F.col("metric").isin(*metrics) & (F.col("value") > above))


def class_balance(df: DataFrame, contract: DatasetContract) -> DataFrame:
    """Rows per label, most frequent first."""
    label = F.col(f"`{contract.target_column}`")
    return (
        df.where(label.isNotNull()).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.col("n_rows").desc(), "label")
    )


def label_findings(prof: DataFrame, contract: DatasetContract, by: Sequence[str] = ()) -> DataFrame:
    """At most one row (by, kind, n, labels) per dataset: unexpected labels win over too few classes."""
    valid = [contract.positive_label, contract.negative_label]
    # The row count is part of every profile, so a dataset without any label still gets its row.
    labels = of_metric(prof, "label", "n_rows")
    is_label = F.col("metric") == "label"
    unexpected = is_label & ~F.col("name").isin(valid)
    seen = labels.groupBy(*by).agg(
        F.count_if(is_label).alias("n"),
        F.count_if(unexpected).alias("n_unexpected"),
        F.sort_array(F.collect_list(F.when(unexpected, F.col("name")))).alias("bad"),
        F.sort_array(F.collect_list(F.when(is_label & ~unexpected, F.col("name")))).alias("good"),
    )
    return seen.select(
        *by,
        F.when(F.col("n_unexpected") > 0, "target_unexpected").when(F.col("n") < 2, "target_classes").alias("kind"),
        "n",
        F.when(F.col("n_unexpected") > 0, F.col("bad")).otherwise(F.col("good")).alias("labels"),
    ).where(F.col("kind").isNotNull())


_NO_DETAILS = "map<string,string>"


def _finding(check: str | Column, severity: str | Column, message: Column, details: dict[str, Column], order: Column) -> list[Column]:
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return [
        (F.lit(check) if isinstance(check, str) else check).alias("check"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        message.alias("message"),
        (F.create_map(*pairs) if pairs else F.lit(None)).cast(_NO_DETAILS).alias("details"),
        order.cast("int").alias("position"),
    ]


def _position(names: Sequence[str], base: int) -> Column:
    return F.array_position(F.array(*[F.lit(n) for n in names]), F.col("name")) + base


def issues(
    df: DataFrame,
    contract: DatasetContract,
    config: MonitorConfig = MonitorConfig(),
    prof: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Findings (by, check, severity, message, details, position) in report order.

    When required columns are missing only the column and emptiness checks apply.
    """
    # Many findings read the profile; it is small, and stored it costs exactly its two passes.
    prof = stored(profile(df, contract, by), "profile") if prof is None else prof
    value = F.col("value")
    absent = missing_columns(df, contract)
    extra = [c for c in unexpected_columns(df, contract) if c not in by]
    total = of_metric(prof, "n_rows")
    parts = [
        total.where((value == 0) | F.lit(not df.columns)).select(
            *by, *_finding("non_empty", ERROR, F.lit(MESSAGES["non_empty"]), {}, F.lit(0))
        )
    ]
    if absent:
        text = F.lit(MESSAGES["required_columns"] % len(absent))
        details = {"missing_columns": F.lit(", ".join(absent))}
        parts.append(total.select(*by, *_finding("required_columns", ERROR, text, details, F.lit(1))))
    if extra:
        text = F.lit(MESSAGES["unexpected_columns"])
        details = {"extra_columns": F.lit(", ".join(extra))}
        parts.append(total.select(*by, *_finding("unexpected_columns", WARNING, text, details, F.lit(2))))
    if not absent:
        parts.append(_value_findings(prof, contract, config, by))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _value_findings(prof: DataFrame, contract: DatasetContract, config: MonitorConfig, by: Sequence[str]) -> DataFrame:
    name, value, n_rows = F.col("name"), F.col("value"), F.col("n_rows")
    coercible = name.isin(*contract.coercible_numeric_columns) if contract.coercible_numeric_columns else F.lit(False)
    fraction = value / n_rows

    def metric(m: str) -> DataFrame:
        return of_metric(prof, m, above=0)

    few = of_metric(prof, "n_rows").where(value < config.min_rows)
    features, numeric = contract.features, contract.numeric_columns
    # Positions keep the report order: whole-dataset checks, columns, target, types, labels.
    after_columns = 10 + len(features)
    parts = [
        few.select(*by, *_finding(
            "minimum_row_count", ERROR, F.format_string(MESSAGES["minimum_row_count"], value, F.lit(config.min_rows)),
            {"row_count": value, "minimum_required": F.lit(config.min_rows)}, F.lit(3),
        )),
        metric("duplicate_ids").select(*by, *_finding(
            "duplicate_ids", ERROR, F.format_string(MESSAGES["duplicate_ids"], value, F.lit(contract.id_column)),
            {"duplicate_id_count": value}, F.lit(4),
        )),
        metric("duplicate_rows").select(*by, *_finding(
            "duplicate_rows", WARNING, F.format_string(MESSAGES["duplicate_rows"], value),
            {"duplicate_row_count": value}, F.lit(5),
        )),
        metric("missing").where(coercible).select(*by, *_finding(
            "missing_values", WARNING, F.format_string(MESSAGES["missing_coercible"], name, value),
            {"column": name, "missing_count": value}, _position(features, 10),
        )),
        metric("missing").where(~coercible).select(*by, *_finding(
            "missing_values", F.when(fraction > 0.5, ERROR).otherwise(WARNING),
            F.format_string(MESSAGES["missing_values"], name, value, fraction * 100),
            {"column": name, "missing_count": value, "missing_fraction": F.round(fraction, 4)}, _position(features, 10),
        )),
        metric("missing_target").select(*by, *_finding(
            "missing_target", ERROR, F.format_string(MESSAGES["missing_target"], name, value),
            {"missing_count": value}, F.lit(after_columns + 1),
        )),
        metric("non_numeric").select(*by, *_finding(
            "dtype_numeric", F.when(coercible, WARNING).otherwise(ERROR),
            F.when(coercible, F.format_string(MESSAGES["dtype_coercible"], name, value)).otherwise(
                F.format_string(MESSAGES["dtype_numeric"], name, value)
            ),
            {"column": name, "invalid_count": value}, _position(numeric, after_columns + 10),
        )),
    ]
    target = F.lit(contract.target_column)
    unexpected = F.col("kind") == "target_unexpected"
    listed = F.array_join("labels", ", ")
    parts.append(
        label_findings(prof, contract, by).select(
            *by,
            F.lit("target_labels").alias("check"),
            F.lit(ERROR).alias("severity"),
            F.when(unexpected, F.format_string(MESSAGES["target_unexpected"], target))
            .otherwise(F.format_string(MESSAGES["target_classes"], target, F.col("n"))).alias("message"),
            F.when(unexpected, F.create_map(F.lit("unexpected_labels"), listed))
            .otherwise(F.create_map(F.lit("observed_labels"), listed)).alias("details"),
            F.lit(after_columns + 20 + len(numeric)).cast("int").alias("position"),
        )
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def report(df: DataFrame, contract: DatasetContract, config: MonitorConfig = MonitorConfig()) -> DataFrame:
    """One row with the whole report nested. Size follows columns and distinct labels, not rows."""
    prof = stored(profile(df, contract), "profile")
    whole = not missing_columns(df, contract)

    def one(metric: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("metric") == metric, F.col("value"))), F.lit(0)).cast("bigint")

    def as_map(metric: str) -> Column:
        return F.map_from_entries(
            F.sort_array(F.collect_list(F.when(F.col("metric") == metric, F.struct("name", "value"))))
        )

    summary = prof.agg(
        one("n_rows").alias("n_rows"),
        one("duplicate_rows").alias("duplicate_row_count"),
        as_map("missing").alias("column_null_counts"),
        (as_map("label") if whole else F.lit(None).cast("map<string,bigint>")).alias("class_balance"),
    ).withColumn("_one", F.lit(1))
    listed = (
        issues(df, contract, config, prof)
        .select(F.struct("position", "check", "severity", "message", F.to_json("details").alias("details")).alias("i"))
        .agg(F.count_if(F.col("i.severity") == ERROR).alias("_errors"), F.sort_array(F.collect_list("i")).alias("_issues"))
        .withColumn("_one", F.lit(1))
    )
    return summary.join(F.broadcast(listed), "_one").select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        (F.col("_errors") == 0).alias("is_valid"),
        "duplicate_row_count",
        "column_null_counts",
        "class_balance",
        F.transform(
            "_issues",
            lambda i: F.struct(
                i["check"].alias("check"), i["severity"].alias("severity"), i["message"].alias("message"),
                F.from_json(i["details"], _NO_DETAILS).alias("details"),
            ),
        ).alias("issues"),
    )


def report_json(df: DataFrame, contract: DatasetContract, config: MonitorConfig = MonitorConfig()) -> DataFrame:
    nested = report(df, contract, config)
    return nested.select(F.to_json(F.struct("*")).alias("quality_report"))


def duplicate_flags(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds `is_duplicate`: true for every row but the first of its key, null keys being equal.

    The first row is found by an aggregate and not by a window over the key, so a key that holds a
    large part of the table is reduced map-side. `order` must tell the rows of a key apart.
    """
    firsts = (
        df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)])
        .agg(F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
    )
    same_key = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)])
    later = F.coalesce(F.struct(*order) > F.col("_first"), F.lit(False))
    return df.join(firsts, same_key, "left").select(*df.columns, later.alias("is_duplicate"))


def row_violations(
    df: DataFrame, contract: DatasetContract, *, integers: Sequence[str] = (), optional: Sequence[str] = ()
) -> DataFrame:
    """Adds `violations`, the sorted input-contract breaches of each row.

    Every feature is required except the optional ones; numerics must be numbers >= 0, the listed
    integers without a fractional part. Each text is stripped and parsed once: Spark writes projected expressions out
    wherever a filter on `violations` names them, but not those of a generator.
    """
    found = []
    numeric = [c for c in contract.features if c in contract.numeric_columns]
    names = {c: (f"_violations_text_{k}", f"_violations_value_{k}") for k, c in enumerate(numeric)}
    rows = df
    if numeric:
        once = lambda columns: F.inline(F.array(F.struct(*columns)))
        rows = rows.select("*", once([strip(F.col(f"`{c}`").cast("string")).alias(names[c][0]) for c in numeric]))
        rows = rows.select("*", once([stripped_to_numeric(F.col(names[c][0])).alias(names[c][1]) for c in numeric]))
    for c in contract.features:
        col = F.col(f"`{c}`")
        if c in contract.numeric_columns:
            value = F.col(names[c][1])
            absent = F.lit(None).cast("string") if c in optional else F.lit(f"{c}: required")
            check = F.when(col.isNull(), absent).when(value.isNull(), f"{c}: not a number").when(value < 0, f"{c}: negative")
            if c in integers:
                check = check.when(value != F.floor(value), f"{c}: not an integer")
        else:
            check = F.when(col.isNull(), f"{c}: required")
        found.append(check)
    checked = rows.withColumn("violations", F.array_sort(F.filter(F.array(*found), lambda v: v.isNotNull())))
    return checked.drop(*[n for pair in names.values() for n in pair])


def split_by_violations(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of `row_violations`."""
    clean = F.size("violations") == 0
    return checked.where(clean).drop("violations"), checked.where(~clean)
