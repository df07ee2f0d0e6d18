"""Domain rules as column expressions: scores, classifications and thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions.numbers import settle

VALID_STATUSES = ("HEALTHY", "DEGRADED", "CRITICAL")

# Severity order in incident listings; anything else comes last.
SEVERITY_ORDER = ("CRITICAL", "HIGH", "MEDIUM", "LOW")

# Fixed values: (temperature above, signal-to-noise below, queue above, error rate above).
DEGRADED_LIMITS = (22, 20, 90, 0.008)
CRITICAL_LIMITS = (28, 15, 130, 0.015)

# A calibration fails beyond any of these.
MAX_GATE_ERROR, MAX_READOUT_ERROR, MIN_T1_US, MIN_T2_US = 0.01, 0.08, 40, 30


def health_score(healthy: Column, degraded: Column, critical: Column, total: Column) -> Column:
    """100 for all healthy, minus 25 and 75 weighted shares, kept within 0..100."""
    raw = healthy / total * 100 - degraded / total * 25 - critical / total * 75
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw))
    return F.when(total == 0, F.lit(0.0)).otherwise(settle(bounded, 2))


def severity_rank(severity: Column) -> Column:
    rank = F.when(severity == SEVERITY_ORDER[0], 1)
    for position, name in enumerate(SEVERITY_ORDER[1:], start=2):
        rank = rank.when(severity == name, position)
    return rank.otherwise(len(SEVERITY_ORDER) + 1)


def _beyond(limits: tuple, temperature: Column, snr: Column, queue: Column, error_rate: Column | None) -> Column:
    hot, noisy, long_queue, errors = limits
    out = (temperature > hot) | (snr < noisy) | (queue > long_queue)
    return out if error_rate is None else out | (error_rate > errors)


def operating_status(
    temperature: Column, snr: Column, queue: Column, error_rate: Column | None = None
) -> Column:
    """Status from readings. Version 1 readings have no error rate, version 2 pass it too."""
    return (
        F.when(_beyond(CRITICAL_LIMITS, temperature, snr, queue, error_rate), "CRITICAL")
        .when(_beyond(DEGRADED_LIMITS, temperature, snr, queue, error_rate), "DEGRADED")
        .otherwise("HEALTHY")
    )


def calibration_status(gate: Column, readout: Column, t1: Column, t2: Column) -> Column:
    failed = (gate > MAX_GATE_ERROR) | (readout > MAX_READOUT_ERROR) | (t1 < MIN_T1_US) | (t2 < MIN_T2_US)
    return F.when(failed, "FAIL").otherwise("PASS")
