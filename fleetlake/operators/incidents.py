"""Threshold rules, incident identity, and incident summaries."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlake.functions.rules import severity_rank
from fleetlake.functions.text import device_id_of, upper_stripped
from fleetlake.functions.times import key_text
from fleetlake.operators.cleaning import on_dates
from fleetlake.operators.health import health_report
from fleetlake.schemas import EVENT_DATE

# Alarm thresholds. They differ from the limits that set a device's status.
TEMPERATURE_ABOVE = 18.0
ERROR_RATE_ABOVE = 0.005
QUEUE_ABOVE = 80
SNR_BELOW = 20.0


# What an incident says.
HOT = f"%s temperature reached %.2f mK, above threshold {TEMPERATURE_ABOVE:.2f} mK."
ERRORS = f"%s hardware error rate reached %.6f, above threshold {ERROR_RATE_ABOVE:.6f}."
QUEUE = f"%s queue depth reached %d, above threshold {QUEUE_ABOVE}."
NOISE = f"%s signal-to-noise ratio dropped to %.2f, below threshold {SNR_BELOW:.2f}."
STATUS = "%s reported %s system status."


class Rule(NamedTuple):
    incident_type: str
    severity: str
    fires: Column
    description: Column


def _status_rule(name: str, severity: str) -> Rule:
    text = F.format_string(STATUS, F.col("device_id"), F.lit(name))
    return Rule(f"DEVICE_{name}", severity, upper_stripped(F.col("system_status")) == name, text)


def rules() -> list[Rule]:
    """The six rules. A NULL reading makes ``fires`` NULL, which counts as not firing."""
    device = F.col("device_id")
    temperature, errors = F.col("temperature_mk"), F.col("hardware_error_rate")
    queue, snr = F.col("queue_depth"), F.col("signal_noise_ratio")
    return [
        Rule("HIGH_TEMPERATURE", "HIGH", temperature > TEMPERATURE_ABOVE, F.format_string(HOT, device, temperature)),
        Rule("HARDWARE_ERROR_SPIKE", "CRITICAL", errors > ERROR_RATE_ABOVE, F.format_string(ERRORS, device, errors)),
        Rule("QUEUE_PRESSURE", "MEDIUM", queue > QUEUE_ABOVE, F.format_string(QUEUE, device, queue)),
        Rule("LOW_SNR", "HIGH", snr < SNR_BELOW, F.format_string(NOISE, device, snr)),
        _status_rule("DEGRADED", "HIGH"),
        _status_rule("CRITICAL", "CRITICAL"),
    ]


def event_key(device_id: Column, event_timestamp: Column, incident_type: Column) -> Column:
    """The same event and rule give the same key in every run."""
    identity = F.concat_ws("|", device_id, key_text(event_timestamp), incident_type)
    return F.concat(F.lit("EVT-"), F.upper(F.substring(F.sha2(identity, 256), 1, 24)))


def _by_rule(pick) -> Column:
    """``pick`` of the rule that fired; only that rule's expression is evaluated."""
    choice = F.col("_rule")
    out = None
    for number, rule in enumerate(rules()):
        out = F.when(choice == number, pick(rule)) if out is None else out.when(choice == number, pick(rule))
    return out


def detect(events: DataFrame) -> DataFrame:
    """All incidents of all events: one narrow pass without a shuffle.

    Rows unfold into the numbers of their rules; texts and keys are made afterwards, for
    rules that fired and only if a query asks for them.
    """
    numbers = F.array(*[F.when(rule.fires, F.lit(number)) for number, rule in enumerate(rules())])
    fired = events.withColumn("_rule", F.explode(numbers)).filter(F.col("_rule").isNotNull())
    typed = fired.withColumns(
        {
            "incident_type": _by_rule(lambda rule: F.lit(rule.incident_type)),
            "severity": _by_rule(lambda rule: F.lit(rule.severity)),
            "description": _by_rule(lambda rule: rule.description),
        }
    )
    key = event_key(F.col("device_id"), F.col("event_timestamp"), F.col("incident_type"))
    return typed.select(
        key.alias("event_key"), "device_id", "incident_type", "severity", "description", "event_timestamp"
    )


def absent(found: DataFrame, existing: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """One row per event key that the incident table does not hold yet.

    A key contains its event's time, so ``dates`` (see ``touched_dates``) cuts the table to the dates of the
    batch. Choosing one row per key reuses the join's partitioning.
    """
    new_ones = found.join(on_dates(existing, dates).select("event_key"), "event_key", "left_anti")
    one = Window.partitionBy("event_key").orderBy("severity", "description")
    return new_ones.withColumn("_n", F.row_number().over(one)).filter("_n = 1").drop("_n").select(found.columns)


def opened(found: DataFrame, detected_at: datetime) -> DataFrame:
    """Incident rows as they are inserted: open, not resolved, detected at the given time."""
    return found.select(
        "event_key",
        "device_id",
        "incident_type",
        "severity",
        "description",
        "event_timestamp",
        F.lit(detected_at).cast("timestamp_ntz").alias("detected_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit("OPEN").alias("status"),
    )


def _occurrences() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("occurrence_count"),
        F.min("event_timestamp").alias("incident_start"),
        F.max("event_timestamp").alias("incident_end"),
        F.min("detected_at").alias("first_detected_at"),
        F.max("detected_at").alias("last_detected_at"),
    ]


def type_summary(incidents: DataFrame) -> DataFrame:
    """Open incidents by device, type and severity."""
    return incidents.filter(F.col("status") == "OPEN").groupBy("device_id", "incident_type", "severity").agg(*_occurrences())


def daily_summary(incidents: DataFrame) -> DataFrame:
    """As :func:`type_summary`, also by the date of the events: what is added up to it."""
    day = F.to_date("event_timestamp").alias(EVENT_DATE)
    return (
        incidents.filter(F.col("status") == "OPEN")
        .groupBy("device_id", "incident_type", "severity", day)
        .agg(*_occurrences())
    )


def summary_of_days(daily: DataFrame) -> DataFrame:
    """The :func:`type_summary` of all incidents from their daily summaries."""
    return daily.groupBy("device_id", "incident_type", "severity").agg(
        F.sum("occurrence_count").alias("occurrence_count"),
        F.min("incident_start").alias("incident_start"),
        F.max("incident_end").alias("incident_end"),
        F.min("first_detected_at").alias("first_detected_at"),
        F.max("last_detected_at").alias("last_detected_at"),
    )


def _device_totals() -> list[Column]:
    """Aggregates over the summary by type that describe one device."""

    def of(severity: str) -> Column:
        return F.sum(F.when(F.col("severity") == severity, F.col("occurrence_count")).otherwise(0))

    return [
        F.sum("occurrence_count").alias("raw_incident_count"),
        F.count_distinct("incident_type").alias("incident_type_count"),
        of("CRITICAL").alias("critical_count"),
        of("HIGH").alias("high_count"),
        of("MEDIUM").alias("medium_count"),
        F.min("incident_start").alias("incident_start"),
        F.max("incident_end").alias("incident_end"),
    ]


def device_totals(summary: DataFrame) -> DataFrame:
    """A :func:`type_summary` by device. It has a row for each type, so counting them needs no incident."""
    return summary.groupBy("device_id").agg(*_device_totals())


def device_summary(incidents: DataFrame) -> DataFrame:
    """Open incidents by device, added up from the summary by type."""
    return device_totals(type_summary(incidents))


def summary_of(incidents: DataFrame, device_id: str) -> DataFrame:
    """The summary of one device; no row when it has no open incident. A malformed id is refused."""
    return device_summary(incidents.filter(F.col("device_id") == device_id_of(device_id)))


def open_ranked(summary: DataFrame, device_id: str | None = None) -> DataFrame:
    """Open incident types, most severe first."""
    if device_id is not None:
        summary = summary.filter(F.col("device_id") == device_id_of(device_id))
    return summary.orderBy(severity_rank(F.col("severity")), "device_id", "incident_type")


def critical(summary: DataFrame) -> DataFrame:
    return (
        summary.filter(F.col("severity") == "CRITICAL")
        .select("device_id", "incident_type", "severity", "occurrence_count", "incident_start", "incident_end")
        .orderBy(F.desc("occurrence_count"), "device_id", "incident_type")
    )


def type_listing(summary: DataFrame) -> DataFrame:
    """Incident types by device; here the severity is ordered as a text."""
    return summary.select(
        "device_id", "incident_type", "severity", "occurrence_count", "incident_start", "incident_end"
    ).orderBy("device_id", "severity", "incident_type")


def severity_histogram(incidents: DataFrame) -> DataFrame:
    return incidents.groupBy("severity").agg(F.count(F.lit(1)).alias("incident_count")).orderBy(
        F.desc("incident_count"), "severity"
    )


def newest(incidents: DataFrame, top: int = 20) -> DataFrame:
    return (
        incidents.select(
            "event_key", "device_id", "incident_type", "severity", "event_timestamp", "detected_at", "status"
        )
        .orderBy(F.desc("detected_at"), F.desc("event_key"))
        .limit(top)
    )


def device_evidence(devices: DataFrame, gold: DataFrame, incidents: DataFrame) -> DataFrame:
    """Health, incident summary and open incident types of each device, one document per row.

    Totals and list come from one grouping. The list holds one entry per incident type and
    severity of a device, of which the rules make six, not one per incident.
    """
    listed = (
        "incident_type",
        "severity",
        "occurrence_count",
        "incident_start",
        "incident_end",
        "first_detected_at",
        "last_detected_at",
    )
    totals = device_summary(incidents).columns[1:]
    entry = F.struct(severity_rank(F.col("severity")).alias("rank"), *listed)
    open_types = (
        type_summary(incidents)
        .groupBy("device_id")
        .agg(*_device_totals(), F.sort_array(F.collect_list(entry)).alias("open_incidents"))
        .select("device_id", F.struct(*totals).alias("incident_summary"), "open_incidents")
    )
    report = health_report(devices, gold)
    health = report.select("device_id", F.struct(*report.columns).alias("device_health"))
    return health.join(open_types, "device_id", "left")


def evidence_json(evidence: DataFrame) -> DataFrame:
    """The evidence as JSON text per device; timestamps become texts."""
    return evidence.select("device_id", F.to_json(F.struct(*evidence.columns)).alias("document"))
