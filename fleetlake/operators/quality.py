"""Data-quality checks on bronze telemetry, the gate, and row-level quarantine."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.numbers import no_nan
from fleetlake.functions.rules import VALID_STATUSES
from fleetlake.functions.text import upper_stripped
from fleetlake.operators.cleaning import IDENTITY, REQUIRED

# Inclusive operating ranges.
RANGES = {
    "temperature_mk": (5, 40),
    "cpu_usage_pct": (0, 100),
    "memory_usage_pct": (0, 100),
    "queue_depth": (0, 500),
    "active_jobs": (0, 500),
    "signal_noise_ratio": (0, 100),
    "cryogenic_pressure_mbar": (0, 5),
    "hardware_error_rate": (0, 1),
}

# What a violation says.
MISSING_COLUMNS = "Missing required columns: %s"
NULL_VALUES = "%s contains %d NULL values."
OUTSIDE_RANGE = "%s has %d values outside [%d, %d]."
INVALID_STATUS = "system_status has %d invalid values: %s."
SURPLUS_EVENTS = "Found %d duplicate telemetry events based on device_id + event_timestamp."
NO_ROWS = "Telemetry dataset is empty."
NO_TIMES = "No valid event timestamps found."
STALE = "Telemetry is stale. Latest event: %s."

CHECKS = ("required_columns", "not_null", "ranges", "status_values", "uniqueness", "freshness")

# The checks that stay meaningful when a batch was delivered twice.
REPLAY_TOLERANT = ("required_columns", "not_null")


class QualityError(RuntimeError):
    """The gate refused a batch."""


def _bad_status(status: Column) -> Column:
    return ~upper_stripped(status).isin(*VALID_STATUSES)


def _out_of_range(df: DataFrame, name: str) -> Column:
    """NULL and NaN are missing, not out of range."""
    low, high = RANGES[name]
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    value = no_nan(F.col(name)) if floating else F.col(name)
    return ~value.between(low, high)


def _entry(check: str, subject: str, violations: Column, message: Column) -> Column:
    """One report row; the message is set only when there is a violation."""
    count = violations.cast("long")
    return F.struct(
        F.lit(check).alias("check_name"),
        F.lit(subject).alias("subject"),
        count.alias("violations"),
        (count == 0).alias("passed"),
        F.when(count > 0, message).alias("message"),
    )


def surplus_copies(df: DataFrame, keys=IDENTITY) -> DataFrame:
    """How many rows repeat an earlier key; NULL keys are equal to each other."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return sizes.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus"))


def invalid_statuses(df: DataFrame) -> DataFrame:
    """Every status text outside the accepted set, with its number of rows."""
    return (
        df.filter(_bad_status(F.col("system_status")))
        .groupBy(upper_stripped(F.col("system_status")).alias("system_status"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("system_status")
    )


def quality_report(df: DataFrame, as_of: datetime, max_age_hours: int = 24) -> DataFrame:
    """All checks as rows ``(check_name, subject, violations, passed, message)``.

    The message on statuses names them in order, from a pass over that column.
    """
    return report_of(quality_measures(df), df, as_of, max_age_hours)


def quality_measures(df: DataFrame) -> DataFrame:
    """What the checks count, as one row: all rows, surplus copies, missing and unfit values, the latest event.

    All but the copies come out of one aggregate without a shuffle of rows. Copies are counted by a shuffle of the
    two identity columns, read once more: identities are nearly as many as rows, so counting everything per
    identity would shuffle all counts instead.
    """
    present = set(df.columns)
    counted = {f"null_{c}": F.col(c).isNull() for c in REQUIRED if c in present}
    counted |= {f"range_{c}": _out_of_range(df, c) for c in RANGES if c in present}
    if "system_status" in present:
        counted["bad_status"] = _bad_status(F.col("system_status"))
    measures = [F.count(F.lit(1)).alias("rows"), *[F.count_if(v).alias(k) for k, v in counted.items()]]
    if "event_timestamp" in present:
        measures.append(F.max(F.col("event_timestamp").try_cast("timestamp_ntz")).alias("latest"))
    measured = df.agg(*measures)
    if set(IDENTITY) <= present:
        keys = df.select(
            upper_stripped(F.col("device_id")).alias("device_id"),
            F.col("event_timestamp").try_cast("timestamp_ntz").alias("event_timestamp"),
        )
        measured = measured.withColumn("surplus", surplus_copies(keys).scalar())
    return measured


def report_of(measured: DataFrame, df: DataFrame, as_of: datetime, max_age_hours: int = 24) -> DataFrame:
    """The checks on ``df`` from its :func:`quality_measures`."""
    present = set(df.columns)
    missing = [c for c in REQUIRED if c not in present]
    ranged = [c for c in RANGES if c in present]
    required = [c for c in REQUIRED if c in present]

    rows = [_entry("required_columns", "", F.lit(len(missing)), F.lit(MISSING_COLUMNS % missing))]
    for c in required:
        n = F.col(f"null_{c}")
        rows.append(_entry("not_null", c, n, F.format_string(NULL_VALUES, F.lit(c), n)))
    for c in ranged:
        n = F.col(f"range_{c}")
        rows.append(_entry("ranges", c, n, F.format_string(OUTSIDE_RANGE, F.lit(c), n, *map(F.lit, RANGES[c]))))
    if "system_status" in present:
        n = F.col("bad_status")
        named = invalid_statuses(df).agg(F.array_join(F.array_sort(F.collect_list("system_status")), ", ").alias("named"))
        measured = measured.withColumn("named", named.scalar())
        rows.append(_entry("status_values", "system_status", n, F.format_string(INVALID_STATUS, n, F.col("named"))))
    if "event_timestamp" in present:
        oldest = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(max_age_hours)} HOURS")
        stale = F.coalesce(F.col("latest") < oldest, F.lit(True))
        why = (
            F.when(F.col("rows") == 0, NO_ROWS)
            .when(F.col("latest").isNull(), NO_TIMES)
            .otherwise(F.format_string(STALE, F.col("latest").cast("string")))
        )
        rows.append(_entry("freshness", "event_timestamp", stale.cast("long"), why))
    if set(IDENTITY) <= present:
        n = F.col("surplus")
        rows.append(_entry("uniqueness", "device_id + event_timestamp", n, F.format_string(SURPLUS_EVENTS, n)))
    return measured.select(F.inline(F.array(*rows)))


def check_summary(report: DataFrame) -> DataFrame:
    """One row per check, and one for all of them together."""
    return (
        report.groupingSets([["check_name"], []], "check_name")
        .agg(F.count_if(~F.col("passed")).alias("error_count"), F.every("passed").alias("passed"))
        .select(F.coalesce("check_name", F.lit("overall")).alias("check_name"), "passed", "error_count")
    )


def gate(report: DataFrame, fail_on: Collection[str] = CHECKS) -> None:
    """Raise unless all checks named in ``fail_on`` passed.

    Ingestion delivers at least once, so with the default a repeated batch blocks the
    pipeline although cleaning would remove it; ``REPLAY_TOLERANT`` lets it through.
    The report has a fixed handful of rows, which is what is collected here.
    """
    failed = report.filter(~F.col("passed") & F.col("check_name").isin(*fail_on))
    messages = [row["message"] for row in failed.select("message").collect()]
    if messages:
        raise QualityError(f"bronze telemetry failed {len(messages)} quality checks: " + " ".join(messages))


def _row_rules(df: DataFrame) -> dict[str, Column]:
    """The rules that one row can break by itself; NULL counts as kept."""
    rules = {f"not_null:{c}": F.col(c).isNull() for c in REQUIRED}
    rules |= {f"range:{c}": _out_of_range(df, c) for c in RANGES if c in df.columns}
    rules["status_values:system_status"] = _bad_status(F.col("system_status"))
    return rules


def with_violations(df: DataFrame) -> DataFrame:
    """Add ``violations``: the names of the row rules each row breaks."""
    broken = [F.when(condition, F.lit(name)) for name, condition in _row_rules(df).items()]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows with their violations)."""
    bad = F.coalesce(reduce(Column.__or__, _row_rules(df).values()), F.lit(False))
    return df.filter(~bad), with_violations(df.filter(bad))
