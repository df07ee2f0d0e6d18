"""Timestamp column helpers. Naive timestamps are UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The extended and the basic form. Spark's cast alone would also take a bare year, or a bare time as a time of today.
_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)?"
_FRACTION = r"([.,]\d+)?"
ISO_TEXT = (
    rf"^(\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{2}}:\d{{2}}(:\d{{2}}{_FRACTION})?{_ZONE})?"
    rf"|\d{{8}}(T\d{{4}}(\d{{2}}{_FRACTION})?{_ZONE})?)\z"
)


# Date, time, and seconds that the basic form leaves out.
_TO_EXTENDED = (
    (r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3"),
    (r"T(\d{2})(\d{2})(\d{2})?", "T$1:$2:$3"),
    (r":(?=$|[Z+-])", ":00"),
)


def naive_utc(text: Column) -> Column:
    """ISO-8601 text to a naive UTC timestamp; NULL where it does not parse.

    A text with an offset is shifted to UTC, one without is taken as it is. Digits of a second
    beyond the sixth are cut off.
    """
    extended = text
    for pattern, plain in _TO_EXTENDED:
        extended = F.regexp_replace(extended, pattern, plain)
    spelled = F.when(text.rlike(r"^\d{8}"), extended).otherwise(text)
    spelled = F.regexp_replace(F.regexp_replace(spelled, r"[.,](\d{1,6})\d*", ".$1"), r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(text.rlike(ISO_TEXT), spelled.try_cast("timestamp").cast("timestamp_ntz"))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a naive UTC timestamp."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def elapsed_days(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(86_400_000_000.0)


def plus_millis(ts: Column, ms: Column) -> Column:
    return from_micros(micros(ts) + ms.cast("long") * 1000)


def end_of_day_range(last_day: Column) -> Column:
    """End of a date range: the last timestamp plus 23 hours and 59 minutes."""
    return last_day + F.expr("INTERVAL '23:59' HOUR TO MINUTE")


def key_text(ts: Column) -> Column:
    """Timestamp text used inside event keys: no fraction, or exactly six digits of it."""
    text = ts.cast("string")
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)
