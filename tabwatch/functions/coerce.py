"""Text-to-value rules for string-typed raw data, as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The texts a default pandas CSV read turns into a missing value (exact, case-sensitive).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Every character that Unicode-aware stripping removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def null_na_tokens(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn NA texts into nulls after a string-typed scan (the CSV reader knows only one token)."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        *[
            F.when(~F.col(f"`{c}`").isin(*NA_TOKENS), F.col(f"`{c}`")).alias(c) if c in chosen else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """Null, empty or whitespace-only."""
    return col.isNull() | (strip(col) == "")


def to_numeric(col: Column) -> Column:
    """Double value of a text, null where it is not a plain decimal number.

    A double parse also takes Java type suffixes (`1d`, `1f`), hexadecimal floats and `NaN`, and
    overflows to infinity; none of these is a number here. A written infinity is kept.
    """
    return stripped_to_numeric(strip(col.cast("string")))


def stripped_to_numeric(text: Column) -> Column:
    """to_numeric of a text without white space around it."""
    value = text.try_cast("double")
    written_inf = F.lower(text).isin("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")
    java_only = F.lower(F.right(text, F.lit(1))).isin("d", "f") | F.lower(text).contains("x")
    finite = (F.abs(value) < float("inf")) & ~java_only
    return F.when(written_inf | finite, value)


def is_non_numeric(col: Column) -> Column:
    """A value is present but is not a number."""
    return ~is_blank(col) & to_numeric(col).isNull()


def binary_label(col: Column, positive: str) -> Column:
    return F.coalesce(col == positive, F.lit(False)).cast("int")


def label_text(predicted: Column, positive: str, negative: str) -> Column:
    return F.when(predicted == 1, positive).otherwise(negative)
