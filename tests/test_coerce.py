import datetime
import math

import pytest
from pyspark.sql import functions as F

from tabwatch.functions import coerce, text


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("s"))).collect()]


NOT_NUMBERS = ["1d", "1f", "1D", "1_000", "1,000", "0x10", "0x1p3", "True", "1e400", "-1e999", "NaN", "nan", "abc", "", " ", "\t"]


@pytest.mark.parametrize("value", NOT_NUMBERS)
def test_not_a_number(spark, value):
    assert column(spark, [value], coerce.to_numeric) == [None]


def test_numbers_keep_their_value(spark):
    values = ["5", " 5\t", "+3", "-2.5", ".5", "5.", "1e3", "inf", "-Infinity", " 7"]
    expected = [5.0, 5.0, 3.0, -2.5, 0.5, 5.0, 1000.0, math.inf, -math.inf, 7.0]
    assert column(spark, values, coerce.to_numeric) == expected


def test_blank_is_unicode_whitespace_or_null(spark):
    values = [None, "", "  ", "\t\n", "  ", "　", "x", " x ", "0"]
    assert column(spark, values, coerce.is_blank) == [True] * 6 + [False] * 3


def test_invalid_numeric_excludes_blank(spark):
    assert column(spark, [None, " ", "x", "1"], coerce.is_non_numeric) == [False, False, True, False]


def test_na_tokens_are_exact_and_case_sensitive(spark):
    kept = ["none", "Null", "na", " NA", " ", "0"]
    df = spark.createDataFrame([(v,) for v in [*coerce.NA_TOKENS, *kept]], "s string")
    out = [r[0] for r in coerce.null_na_tokens(df).collect()]
    assert out == [None] * len(coerce.NA_TOKENS) + kept


def test_binary_label_null_is_negative(spark):
    assert column(spark, ["Yes", "No", None, "yes"], lambda c: coerce.binary_label(c, "Yes")) == [1, 0, 0, 0]


def test_durations(spark):
    assert column(spark, [None, 12.34, 59.99, 60.0, 125.0], text.duration_text, "double") == ["—", "12.3s", "60.0s", "1m 0s", "2m 5s"]


def test_relative_time(spark):
    now = datetime.datetime(2024, 1, 10)
    ages = [3, 30, 90, 7200, 36 * 3600, 10 * 86400]
    values = [now - datetime.timedelta(seconds=s) for s in ages] + [None]
    as_of = F.lit(now)
    out = column(spark, values, lambda c: text.relative_time_text(c, as_of), "timestamp")
    assert out == ["just now", "30s ago", "2m ago", "2h ago", "2d ago", "10d ago", "—"]


def test_percent_and_ids(spark):
    assert column(spark, [None, 0.1234, float("nan")], text.percent_text, "double") == ["—", "12.3%", "—"]
    assert column(spark, ["abcdefghij", "", None], text.short_id) == ["abcdefgh", "—", "—"]
    assert column(spark, ["a/B.CSV", "x.tar.gz", "noext", "dir.d/.hidden", "a."], text.file_suffix) == [".csv", ".gz", "", "", ""]


def test_attempt_key(spark):
    df = spark.createDataFrame([(" Bob@X.com ", "10.0.0.1", "1.1.1.1, 2.2.2.2"), ("bob@x.com", "10.0.0.1", "")], "e string, c string, f string")
    keys = [tuple(r) for r in df.select(text.attempt_key(F.col("e"), F.col("c")), text.attempt_key(F.col("e"), F.col("c"), F.col("f"))).collect()]
    assert keys == [("bob@x.com:10.0.0.1", "bob@x.com:1.1.1.1"), ("bob@x.com:10.0.0.1", "bob@x.com:10.0.0.1")]
