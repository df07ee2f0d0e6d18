"""Silver to gold: per-device health, rankings and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.numbers import settle
from fleetlake.functions.rules import health_score
from fleetlake.functions.text import device_id_of
from fleetlake.schemas import EVENT_DATE

AVERAGED = (
    "temperature_mk",
    "cpu_usage_pct",
    "memory_usage_pct",
    "queue_depth",
    "active_jobs",
    "signal_noise_ratio",
    "cryogenic_pressure_mbar",
    "hardware_error_rate",
)

# Decimals shown in reports.
REPORT_DIGITS = {
    "avg_temperature_mk": 2,
    "avg_cpu_usage_pct": 2,
    "avg_memory_usage_pct": 2,
    "avg_queue_depth": 2,
    "avg_active_jobs": 2,
    "avg_signal_noise_ratio": 2,
    "avg_cryogenic_pressure_mbar": 4,
    "avg_hardware_error_rate": 6,
    "health_score": 2,
}


def daily_health(silver: DataFrame) -> DataFrame:
    """Per device and date what adds up to its health: counts, sums and the last event."""
    status = F.col("system_status")
    sums = [F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in AVERAGED]
    counts = [F.count(c).alias(f"n_{c}") for c in AVERAGED]
    return silver.groupBy("device_id", F.to_date("event_timestamp").alias(EVENT_DATE)).agg(
        F.count(F.lit(1)).alias("total_events"),
        *sums,
        *counts,
        F.count_if(status == "HEALTHY").alias("healthy_events"),
        F.count_if(status == "DEGRADED").alias("degraded_events"),
        F.count_if(status == "CRITICAL").alias("critical_events"),
        F.max("event_timestamp").alias("latest_event_timestamp"),
        F.min("event_timestamp").alias("first_event_timestamp"),
    )


def _scored(counted: DataFrame) -> DataFrame:
    score = health_score(
        F.col("healthy_events"), F.col("degraded_events"), F.col("critical_events"), F.col("total_events")
    )
    return counted.select(
        "device_id",
        "total_events",
        *[f"avg_{c}" for c in AVERAGED],
        "healthy_events",
        "degraded_events",
        "critical_events",
        score.alias("health_score"),
        "latest_event_timestamp",
    )


def health_of_days(daily: DataFrame) -> DataFrame:
    """Device health from daily sums; the same result as from the events themselves."""
    averages = [settle(F.sum(f"sum_{c}") / F.nullif(F.sum(f"n_{c}"), F.lit(0)), 6).alias(f"avg_{c}") for c in AVERAGED]
    events = [F.sum(c).alias(c) for c in ("total_events", "healthy_events", "degraded_events", "critical_events")]
    return _scored(
        daily.groupBy("device_id").agg(*events, *averages, F.max("latest_event_timestamp").alias("latest_event_timestamp"))
    )


def device_health(silver: DataFrame) -> DataFrame:
    """One row per device: event counts by status, average readings, score, last event.

    All buffers have a fixed width, so this is a hash aggregate with a partial stage:
    a device with a large share of the events costs one row per task in the shuffle.
    """
    status = F.col("system_status")
    averages = [settle(F.avg(c), 6).alias(f"avg_{c}") for c in AVERAGED]
    return _scored(
        silver.groupBy("device_id").agg(
            F.count(F.lit(1)).alias("total_events"),
            *averages,
            F.count_if(status == "HEALTHY").alias("healthy_events"),
            F.count_if(status == "DEGRADED").alias("degraded_events"),
            F.count_if(status == "CRITICAL").alias("critical_events"),
            F.max("event_timestamp").alias("latest_event_timestamp"),
        )
    )


def _reported(name: str) -> Column:
    return settle(F.col(name), REPORT_DIGITS[name]).alias(name)


def health_report(devices: DataFrame, gold: DataFrame, device_id: str | None = None) -> DataFrame:
    """Registry data and rounded health of all devices, or of one; no events gives NULLs. A malformed id is refused."""
    if device_id is not None:
        devices = devices.filter(F.col("device_id") == device_id_of(device_id))
    return devices.join(gold, "device_id", "left").select(
        "device_id",
        "device_name",
        "location",
        "qubit_count",
        "operational_status",
        "total_events",
        *[_reported(c) for c in REPORT_DIGITS],
        "latest_event_timestamp",
    )


def health_listing(gold: DataFrame) -> DataFrame:
    return gold.select(
        "device_id", "total_events", _reported("avg_temperature_mk"), _reported("health_score")
    ).orderBy("device_id")


def current_health_listing(current: DataFrame) -> DataFrame:
    return current.select(
        "device_id",
        "total_events",
        "healthy_events",
        "degraded_events",
        "critical_events",
        "health_score",
        "latest_event_timestamp",
    ).orderBy("device_id")


def queue_ranking(silver: DataFrame, direction: str = "DESC", top: int = 5) -> DataFrame:
    """The ``top`` devices by average queue depth; equal averages are ordered by device."""
    average = F.col("avg_queue_depth")
    ranked = silver.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("event_count"), settle(F.avg("queue_depth"), 2).alias("avg_queue_depth")
    )
    order = average.asc() if direction.upper() == "ASC" else average.desc()
    return ranked.orderBy(order, "device_id").limit(top)
