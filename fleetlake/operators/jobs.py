"""Job history: failure rates, timelines, failure probability, registry checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.numbers import clamp, settle
from fleetlake.functions.times import plus_millis
from fleetlake.operators.calibration import daily_health

# Parts of the failure probability and its limits.
BASE_FAILURE = 0.03
GATE_WEIGHT, READOUT_WEIGHT, FAILED_WEIGHT = 3, 0.4, 0.005
LOWEST_FAILURE, HIGHEST_FAILURE = 0.01, 0.35


def failed() -> Column:
    return F.col("status") == "FAILED"


def failure_rates(jobs: DataFrame) -> DataFrame:
    """Share of failed jobs per device in percent, highest first."""
    rate = settle(F.avg(failed().cast("double")) * 100, 2)
    return jobs.groupBy("device_id").agg(rate.alias("failure_rate_pct")).orderBy(
        F.desc("failure_rate_pct"), "device_id"
    )


def rate_against_fleet(jobs: DataFrame) -> DataFrame:
    """Each device's failure rate next to the unweighted mean of the other devices' rates."""
    rates = failure_rates(jobs)
    fleet = rates.agg(F.struct(F.sum("failure_rate_pct").alias("total"), F.count("*").alias("n")).alias("fleet"))
    own = F.col("failure_rate_pct")
    others = F.col("fleet.n") - 1
    mean = F.when(others > 0, settle((F.col("fleet.total") - own) / others, 6))
    return rates.withColumn("fleet", fleet.scalar()).select(
        "device_id", own, mean.alias("other_devices_pct"), (own > mean).alias("elevated")
    )


def timeline(jobs: DataFrame) -> DataFrame:
    """Start and completion from the queueing time and the durations in milliseconds."""
    started = plus_millis(F.col("queued_at"), F.col("queue_time_ms"))
    return jobs.withColumn("started_at", started).withColumn(
        "completed_at", plus_millis(F.col("started_at"), F.col("execution_time_ms"))
    )


def failure_probability(jobs: DataFrame, calibrations: DataFrame) -> DataFrame:
    """Expected failure probability of each job from its device's calibrations that day.

    A job without calibrations that day has exactly the base probability.
    """
    daily = daily_health(calibrations).select(
        "device_id", "date", "avg_gate_error", "avg_readout_error", "failed_calibrations"
    )
    loaded = (
        BASE_FAILURE
        + F.col("avg_gate_error") * GATE_WEIGHT
        + F.col("avg_readout_error") * READOUT_WEIGHT
        + F.col("failed_calibrations") * FAILED_WEIGHT
    )
    probability = F.when(F.col("failed_calibrations").isNull(), F.lit(BASE_FAILURE)).otherwise(
        clamp(loaded, LOWEST_FAILURE, HIGHEST_FAILURE)
    )
    return (
        jobs.withColumn("date", F.to_date("submitted_at"))
        .join(daily, ["device_id", "date"], "left")
        .withColumn("failure_probability", probability)
        .select(*jobs.columns, "failure_probability")
    )


def unknown_devices(devices: DataFrame, **datasets: DataFrame) -> DataFrame:
    """Device ids of each data set that the registry does not have."""
    used = None
    for name, df in datasets.items():
        ids = df.select(F.lit(name).alias("dataset"), "device_id").distinct()
        used = ids if used is None else used.unionByName(ids)
    return used.join(devices.select("device_id"), "device_id", "left_anti").select("dataset", "device_id")
