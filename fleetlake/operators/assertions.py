"""End-to-end expectations on the data sets, as rows with a verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.operators.calibration import latest_records
from fleetlake.operators.jobs import rate_against_fleet, unknown_devices


def _verdicts(df: DataFrame, *checks: tuple[str, Column, str, Column]) -> DataFrame:
    """One aggregate of ``df``, one row per check ``(name, observed, expected, passed)``."""
    rows = [
        F.struct(
            F.lit(name).alias("assertion"),
            observed.cast("double").alias("observed"),
            F.lit(expected).alias("expected"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )
        for name, observed, expected, passed in checks
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def incident_assertions(
    devices: DataFrame,
    calibrations: DataFrame,
    jobs: DataFrame,
    telemetry: DataFrame,
    device_id: str = "DEV002",
    qubit_id: str = "Q017",
) -> DataFrame:
    """The known incident of a device shows in calibrations, telemetry and jobs; ids are valid."""
    qubit = calibrations.filter((F.col("device_id") == device_id) & (F.col("qubit_id") == qubit_id))
    fails = F.count_if(F.col("calibration_status") == "FAIL")
    events = telemetry.filter(F.col("device_id") == device_id)
    degraded, critical = (F.count_if(F.col("system_status") == s) for s in ("DEGRADED", "CRITICAL"))
    rate = rate_against_fleet(jobs).filter(F.col("device_id") == device_id)
    uplift = F.max(F.col("failure_rate_pct") - F.col("other_devices_pct"))
    unknown = unknown_devices(devices, calibrations=calibrations, jobs=jobs, telemetry=telemetry)
    strangers = {name: F.count_if(F.col("dataset") == name) for name in ("calibrations", "jobs", "telemetry")}
    rows = [
        _verdicts(latest_records(qubit), ("calibration_reaches_fail", fails, "> 0", fails > 0)),
        _verdicts(
            events,
            ("telemetry_has_degraded", degraded, "> 0", degraded > 0),
            ("telemetry_has_critical", critical, "> 0", critical > 0),
        ),
        _verdicts(rate, ("job_failures_above_others", F.round(uplift, 6), "> 0", F.max("elevated"))),
        _verdicts(unknown, *[(f"{name}_devices_known", n, "= 0", n == 0) for name, n in strangers.items()]),
    ]
    return reduce(DataFrame.unionByName, rows)
