"""Display text: dates, durations, percentages and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"


def iso(ts: Column) -> Column:
    """ISO-8601 text with microseconds and the UTC offset; timestamps are UTC throughout."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def seconds_between(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)


def _known(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value.cast("double"))


def percent_text(value: Column, digits: int = 1) -> Column:
    return F.when(_known(value), F.format_string(f"%.{digits}f%%", value * 100)).otherwise(DASH)


def number_text(value: Column, digits: int = 3) -> Column:
    return F.when(_known(value), F.format_string(f"%.{digits}f", value.cast("double"))).otherwise(DASH)


def integer_text(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_number(value.cast("bigint"), 0)).otherwise(DASH)


def duration_text(seconds: Column) -> Column:
    return (
        F.when(~_known(seconds), DASH)
        .when(seconds < 60, F.format_string("%.1fs", seconds))
        .otherwise(
            F.format_string(
                "%dm %ds",
                F.floor(seconds / 60).cast("bigint"),
                F.floor(seconds - F.floor(seconds / 60) * 60 + 0.5).cast("bigint"),
            )
        )
    )


def relative_time_text(ts: Column, as_of: Column) -> Column:
    """`5m ago` style age of a timestamp; each unit is rounded from the one below it."""

    def rounded(x: Column) -> Column:
        return F.floor(x + 0.5).cast("bigint")

    sec = rounded(seconds_between(ts, as_of))
    minute = rounded(sec / 60)
    hour = rounded(minute / 60)
    day = rounded(hour / 24)
    return (
        F.when(ts.isNull(), DASH)
        .when(sec < 5, "just now")
        .when(sec < 60, F.concat(sec, F.lit("s ago")))
        .when(minute < 60, F.concat(minute, F.lit("m ago")))
        .when(hour < 24, F.concat(hour, F.lit("h ago")))
        .otherwise(F.concat(day, F.lit("d ago")))
    )


def short_id(value: Column, length: int = 8) -> Column:
    return F.when(F.length(value) > 0, F.substring(value, 1, length)).otherwise(DASH)


def error_text(value: Column) -> Column:
    """Error messages are stored up to 2000 characters."""
    return F.substring(value, 1, 2000)


def file_suffix(name: Column) -> Column:
    """Lower-cased last suffix; a leading dot alone is a hidden file, not a suffix."""
    return F.lower(F.regexp_extract(name, r"[^/](\.[^./]+)$", 1))


def s3_bucket(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^s3a?://([^/]*)", 1)


def s3_key(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^s3a?://[^/]*/(.*)$", 1)


def attempt_key(email: Column, client: Column, forwarded: Column | None = None) -> Column:
    """Identity of a login attempt: normalised email plus client address.

    Pass `forwarded` only behind a proxy that sets it; its left-most entry is then the client.
    """
    address = client
    if forwarded is not None:
        address = F.when(F.length(forwarded) > 0, F.trim(F.split(forwarded, ",")[0])).otherwise(client)
    return F.concat(F.lower(F.trim(email)), F.lit(":"), address)
