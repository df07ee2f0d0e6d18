"""Calibration history: daily health, latest records and status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlake.functions.rules import calibration_status

LATEST_RECORDS = 10

ENTITY = ("device_id", "qubit_id")


def daily_health(calibrations: DataFrame) -> DataFrame:
    """Average errors and coherence times and the number of failures per device and day."""
    return calibrations.groupBy("device_id", F.to_date("calibration_timestamp").alias("date")).agg(
        F.avg("gate_error").alias("avg_gate_error"),
        F.avg("readout_error").alias("avg_readout_error"),
        F.avg("t1_us").alias("avg_t1_us"),
        F.avg("t2_us").alias("avg_t2_us"),
        F.count_if(F.col("calibration_status") == "FAIL").alias("failed_calibrations"),
    )


def with_status(calibrations: DataFrame) -> DataFrame:
    status = calibration_status(
        F.col("gate_error"), F.col("readout_error"), F.col("t1_us"), F.col("t2_us")
    )
    return calibrations.withColumn("calibration_status", status)


def latest_records(calibrations: DataFrame, count: int = LATEST_RECORDS, entity=ENTITY) -> DataFrame:
    """The last ``count`` records of each entity with their ``recency`` (1 = newest).

    Each task keeps ``count`` rows per entity before the shuffle.
    """
    newest = Window.partitionBy(*entity).orderBy(F.desc("calibration_timestamp"), F.desc("calibration_id"))
    return calibrations.withColumn("recency", F.row_number().over(newest)).filter(F.col("recency") <= count)


def distinct_counts(calibrations: DataFrame) -> DataFrame:
    """Rows, devices and (device, qubit) pairs. A pair with a NULL counts, a NULL device does not."""
    pairs = calibrations.groupBy(*ENTITY).agg(F.count(F.lit(1)).alias("n"))
    devices = pairs.groupBy("device_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pairs"))
    return devices.agg(
        F.sum("n").alias("records"),
        F.count("device_id").alias("devices"),
        F.sum("pairs").alias("device_qubits"),
    )
