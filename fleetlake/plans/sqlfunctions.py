"""The domain's columns as SQL functions of a session, spelled out by Spark from the columns themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions import rules, text
from fleetlake.operators.incidents import event_key

#: By name: parameters with their types, the result's type, and the column over parameters of these names.
FUNCTIONS: dict[str, tuple[str, str, Callable[[], Column]]] = {}


def _function(name: str, parameters: str, result: str, build: Callable[..., Column]) -> None:
    names = [p.split()[0] for p in parameters.split(", ")]
    FUNCTIONS[name] = (parameters, result, lambda: build(*map(F.col, names)))


_function("health_score", "healthy BIGINT, degraded BIGINT, critical BIGINT, total BIGINT", "DOUBLE", rules.health_score)
_function("severity_rank", "severity STRING", "INT", rules.severity_rank)
_function("event_key", "device_id STRING, event_timestamp TIMESTAMP_NTZ, incident_type STRING", "STRING", event_key)
_function(
    "operating_status",
    "temperature_mk DOUBLE, signal_noise_ratio DOUBLE, queue_depth INT, hardware_error_rate DOUBLE",
    "STRING",
    rules.operating_status,
)
_function("calibration_status", "gate DOUBLE, readout DOUBLE, t1 DOUBLE, t2 DOUBLE", "STRING", rules.calibration_status)
_function("valid_device_id", "device_id STRING", "STRING", text.valid_device_id)
_function("mentioned_device_id", "question STRING", "STRING", text.mentioned_device_id)
_function("question_route", "question STRING", "STRING", text.question_route)
_function("ranking_direction", "question STRING", "STRING", text.ranking_direction)


def _spelled(spark: SparkSession, parameters: str, column: Column) -> str:
    """The column as SQL over its parameters, with the casts that their types ask for."""
    frame = spark.createDataFrame([], parameters).select(column)
    return frame._jdf.queryExecution().analyzed().expressions().apply(0).child().sql()


def register_functions(spark: SparkSession) -> list[str]:
    """Make the scalar functions known to the session; returns their names. They are SQL, so a query stays one plan."""
    for name, (parameters, result, column) in FUNCTIONS.items():
        body = _spelled(spark, parameters, column())
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
