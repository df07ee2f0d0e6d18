"""Text column helpers: normalisation, device ids, question routing, statement audit."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as surrounding white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The words that send a question to a report.
INVESTIGATION_WORDS = (
    "why", "degraded", "degrade", "wrong", "problem", "issue", "unhealthy",
    "investigate", "failure", "failing", "anomaly", "anomalies",
)
CRITICAL_PHRASES = ("critical incident", "critical incidents", "critical issue", "critical issues")
RANKING_WORDS = (
    "highest", "lowest", "largest", "smallest", "most", "least", "max", "maximum", "min", "minimum",
)
LOWEST_WORDS = ("lowest", "smallest", "least", "minimum", "min ")

# What a read-only statement may start with, and what it may not contain.
READ_COMMANDS = ("SELECT", "SHOW", "DESCRIBE", "WITH", "EXPLAIN")
WRITE_COMMANDS = (
    "INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "CREATE", "TRUNCATE", "MERGE", "CALL", "GRANT", "REVOKE",
)

DEVICE_ID_FORMAT = r"DEV\d{3}"


def strip(c: Column) -> Column:
    """Remove surrounding white space of any kind; plain ``trim`` removes blanks only."""
    return F.btrim(c, F.lit(WHITESPACE))


def upper_stripped(c: Column) -> Column:
    return F.upper(strip(c))


def lower_stripped(c: Column) -> Column:
    return F.lower(strip(c))


def coded(prefix: str, number: Column, width: int) -> Column:
    """An id such as ``DEV007``; numbers with more digits than ``width`` keep them all."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def _mentions(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(words))


def valid_device_id(c: Column) -> Column:
    """The normalised device id, or NULL where it does not have the required format."""
    normal = upper_stripped(c)
    return F.when(normal.rlike(f"^{DEVICE_ID_FORMAT}\\z"), normal)


def require_device_id(c: Column) -> Column:
    """As :func:`valid_device_id`, but a bad id ends the query."""
    message = F.concat(F.lit("invalid device id: "), F.coalesce(c, F.lit("NULL")))
    return F.coalesce(valid_device_id(c), F.raise_error(message).cast("string"))


def device_id_of(given: str) -> str:
    """A device id that a caller gave, normalised; ValueError if it does not have the required format."""
    normal = given.strip().upper()
    if not re.fullmatch(DEVICE_ID_FORMAT, normal, re.ASCII):
        raise ValueError(f"invalid device id: {given}")
    return normal


def mentioned_device_id(text: Column) -> Column:
    """The first device id that stands as a word of its own in a free text, upper-cased."""
    found = F.regexp_extract(text, rf"(?iU)\b{DEVICE_ID_FORMAT}\b", 0)
    return F.upper(F.nullif(found, F.lit("")))


def question_route(text: Column) -> Column:
    """Which report answers a question; the first matching route wins."""
    low = F.lower(text)
    ranking = low.contains("queue") & low.contains("depth") & _mentions(low, RANKING_WORDS)
    return (
        F.when(mentioned_device_id(text).isNotNull() & _mentions(low, INVESTIGATION_WORDS), "device_investigation")
        .when(_mentions(low, CRITICAL_PHRASES), "critical_incidents")
        .when(ranking, "queue_ranking")
        .otherwise("general")
    )


def ranking_direction(text: Column) -> Column:
    return F.when(_mentions(F.lower(text), LOWEST_WORDS), "ASC").otherwise("DESC")


def statement_verdict(statement: Column, strict: bool = False) -> Column:
    """NULL for a read-only statement, else the reason why it is refused.

    By default a write command counts only between two blanks; ``strict`` also finds it
    next to line breaks, brackets and semicolons.
    """
    cleaned = F.upper(strip(F.coalesce(statement, F.lit(""))))
    first_word = F.regexp_extract(cleaned, r"(?U)^\S+", 0)
    padded = F.concat(F.lit(" "), cleaned, F.lit(" "))
    verdict = F.when(cleaned == "", "empty").when(~first_word.isin(*READ_COMMANDS), "not_read_only")
    for word in WRITE_COMMANDS:
        found = cleaned.rlike(rf"\b{word}\b") if strict else padded.contains(f" {word} ")
        verdict = verdict.when(found, f"blocked:{word}")
    return verdict
