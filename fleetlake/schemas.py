"""Table schemas of the lake; the single place where column order and types are declared."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
_TS, _DT = T.TimestampNTZType(), T.DateType()


# The partition column of event tables, and the one of tables that are filled batch by batch.
EVENT_DATE = "event_date"
BATCH = "batch"

# The partition columns of the batch ledger, and of state tables that are merged bucket by bucket.
DAY = "day"
BUCKET = "bucket"


def _schema(*columns: tuple) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], nullable="req" not in c[2:]) for c in columns])


PAYLOAD = _schema(
    ("device_id", _S, "req"),
    ("event_timestamp", _TS, "req"),
    ("temperature_mk", _D),
    ("cpu_usage_pct", _D),
    ("memory_usage_pct", _D),
    ("queue_depth", _I),
    ("active_jobs", _I),
    ("signal_noise_ratio", _D),
    ("cryogenic_pressure_mbar", _D),
    ("hardware_error_rate", _D),
    ("system_status", _S),
    ("schema_version", _S, "req"),
)

LINEAGE = _schema(("ingested_at", _TS), ("kafka_partition", _I), ("kafka_offset", _L))

TELEMETRY = T.StructType(PAYLOAD.fields + LINEAGE.fields)

V2_ONLY = ("cryogenic_pressure_mbar", "hardware_error_rate")

DEVICE_HEALTH = _schema(
    ("device_id", _S, "req"),
    ("total_events", _L, "req"),
    ("avg_temperature_mk", _D),
    ("avg_cpu_usage_pct", _D),
    ("avg_memory_usage_pct", _D),
    ("avg_queue_depth", _D),
    ("avg_active_jobs", _D),
    ("avg_signal_noise_ratio", _D),
    ("avg_cryogenic_pressure_mbar", _D),
    ("avg_hardware_error_rate", _D),
    ("healthy_events", _L, "req"),
    ("degraded_events", _L, "req"),
    ("critical_events", _L, "req"),
    ("health_score", _D, "req"),
    ("latest_event_timestamp", _TS, "req"),
)

# Sums per device and day, from which the health above is added up.
_READINGS = [f.name for f in PAYLOAD.fields if isinstance(f.dataType, (T.DoubleType, T.IntegerType))]
DEVICE_HEALTH_DAILY = _schema(
    ("device_id", _S, "req"),
    ("total_events", _L, "req"),
    *[(f"sum_{c}", _D) for c in _READINGS],
    *[(f"n_{c}", _L) for c in _READINGS],
    ("healthy_events", _L, "req"),
    ("degraded_events", _L, "req"),
    ("critical_events", _L, "req"),
    ("latest_event_timestamp", _TS, "req"),
    ("first_event_timestamp", _TS),
)

DEVICES = _schema(
    ("device_id", _S, "req"),
    ("device_name", _S),
    ("location", _S),
    ("qubit_count", _I),
    ("operational_status", _S),
    ("created_at", _TS),
)

DEVICE_HEALTH_CURRENT = T.StructType(
    [T.StructField(f.name, f.dataType, nullable=f.name != "device_id") for f in DEVICE_HEALTH.fields]
    + [T.StructField("updated_at", _TS)]
)

INCIDENTS = _schema(
    ("event_key", _S, "req"),
    ("device_id", _S),
    ("incident_type", _S),
    ("severity", _S),
    ("description", _S),
    ("event_timestamp", _TS),
    ("detected_at", _TS),
    ("resolved_at", _TS),
    ("status", _S),
)

# Open incidents per device, type, severity and day, from which the summaries are added up.
INCIDENT_DAILY = _schema(
    ("device_id", _S),
    ("incident_type", _S),
    ("severity", _S),
    ("occurrence_count", _L, "req"),
    ("incident_start", _TS),
    ("incident_end", _TS),
    ("first_detected_at", _TS),
    ("last_detected_at", _TS),
)

REJECTED = _schema(
    ("reject_reason", _S),
    ("value", _S),
    ("kafka_partition", _I),
    ("kafka_offset", _L),
    ("ingested_at", _TS),
)

# Events with all fields as they were sent, for columns that are added later.
PAYLOADS = _schema(
    ("device_id", _S, "req"), ("event_timestamp", _TS, "req"), ("payload", T.VariantType()), *[(f.name, f.dataType) for f in LINEAGE.fields]
)

# What became of the messages of a micro-batch: kept aside, taken into the stream's table, or neither, as they
# were copies, known already, or not valid.
STREAM_BATCHES = _schema(
    ("stream", _S),
    ("batch_number", _L),
    ("messages", _L),
    ("rejected", _L),
    ("accepted", _L),
    ("surplus", _L),
    ("started_at", _TS),
    ("completed_at", _TS),
)

PIPELINE_RUNS = _schema(
    ("pipeline_name", _S),
    ("run_status", _S),
    ("bronze_rows", _L),
    ("silver_rows", _L),
    ("gold_rows", _L),
    ("started_at", _TS),
    ("completed_at", _TS),
    ("created_at", _TS),
)

# What happened to each write of a batch, named by its commit: it began, it left rows of a date, it ended.
BATCHES = _schema(
    ("batch", _S, "req"),
    ("commit_id", _S, "req"),
    ("state", _S, "req"),
    ("batch_date", _DT),
    ("row_count", _L),
    ("latest_event", _TS),
    ("noted_at", _TS, "req"),
)

# The dates of commits that a successful run of the batch job has taken.
BATCHES_DONE = _schema(("commit_id", _S, "req"), ("batch_date", _DT), ("noted_at", _TS, "req"))

JOB_EVENT = _schema(
    ("job_id", _S),
    ("device_id", _S),
    ("user_id", _S),
    ("submitted_at", _S),
    ("queue_time_ms", _L),
    ("execution_time_ms", _L),
    ("shots", _I),
    ("circuit_depth", _I),
    ("status", _S),
    ("error_code", _S),
    ("schema_version", _S),
)

# A job event next to its key and position in the topic.
JOBS = T.StructType(
    [T.StructField("device_key", _S), *LINEAGE.fields[1:], LINEAGE.fields[0], *JOB_EVENT.fields]
)

# A bronze event next to the row rules it breaks.
QUARANTINE = T.StructType(
    [T.StructField(f.name, f.dataType) for f in TELEMETRY.fields] + [T.StructField("violations", T.ArrayType(_S))]
)

# One message per row, as a broker delivers it.
ENVELOPE = _schema(
    ("key", _S), ("value", _S), ("partition", _I), ("offset", _L), ("timestamp", T.TimestampType())
)

DEVICES_CSV = _schema(
    ("device_id", _S),
    ("device_name", _S),
    ("qubit_count", _I),
    ("processor_generation", _S),
    ("location", _S),
    ("operational_status", _S),
    ("commission_date", _DT),
)

CALIBRATIONS_CSV = _schema(
    ("calibration_id", _S),
    ("device_id", _S),
    ("qubit_id", _S),
    ("calibration_timestamp", _TS),
    ("t1_us", _D),
    ("t2_us", _D),
    ("gate_error", _D),
    ("readout_error", _D),
    ("frequency_ghz", _D),
    ("calibration_status", _S),
)

JOBS_CSV = _schema(
    ("job_id", _S),
    ("user_id", _S),
    ("device_id", _S),
    ("submitted_at", _TS),
    ("queued_at", _TS),
    ("started_at", _TS),
    ("completed_at", _TS),
    ("queue_time_ms", _L),
    ("execution_time_ms", _L),
    ("shots", _I),
    ("circuit_depth", _I),
    ("status", _S),
    ("error_code", _S),
)

TELEMETRY_CSV = _schema(
    ("telemetry_id", _S),
    ("device_id", _S),
    ("event_timestamp", _TS),
    ("temperature_mk", _D),
    ("cpu_usage_pct", _D),
    ("memory_usage_pct", _D),
    ("queue_depth", _I),
    ("active_jobs", _I),
    ("signal_noise_ratio", _D),
    ("uptime_hours", _D),
    ("system_status", _S),
    ("schema_version", _S),
)
