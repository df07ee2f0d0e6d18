"""The named queries once more, as SQL for an independent engine.

Each text stands on its own: the data sets it needs are spelled out as common table
expressions over the benchmark tables.
"""

from __future__ import annotations


def _r(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(27,9)), {digits}) AS DOUBLE)"


def _code(prefix: str, number: str, width: int) -> str:
    return f"printf('{prefix}%0{width}d', {number})"


def _trim(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


RAW = f"""
sent AS (
  SELECT
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN event_id % 5 = 0 THEN ' ' || lower({_code('DEV', 'user_id', 3)}) || chr(9)
         ELSE {_code('DEV', 'user_id', 3)} END AS device_id,
    CASE WHEN event_id % 4 = 0 THEN CAST(date_trunc('second', ts) AS TIMESTAMP) ELSE ts END AS event_timestamp,
    value AS temperature_mk,
    value % 100 AS cpu_usage_pct,
    (value * 2) % 100 AS memory_usage_pct,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS queue_depth,
    CAST(json_extract_string(props, '$.k') AS INTEGER) // 3 AS active_jobs,
    CAST(15 + event_id % 20 AS DOUBLE) AS signal_noise_ratio,
    CASE WHEN event_id % 3 <> 0 THEN 1e0 + (event_id % 7) / 1e2 END AS cryogenic_pressure_mbar,
    CASE WHEN event_id % 3 <> 0 THEN (event_id % 10) / 1e3 END AS hardware_error_rate,
    CASE event_type WHEN 'view' THEN 'healthy' WHEN 'click' THEN ' Healthy ' WHEN 'purchase' THEN 'DEGRADED'
         WHEN 'error' THEN 'critical' ELSE 'unknown' END AS system_status,
    CASE WHEN event_id % 3 = 0 THEN 'v1' ELSE ' V2 ' END AS schema_version,
    ts AS ingested_at,
    CAST(user_id % 3 AS INTEGER) AS kafka_partition,
    event_id AS kafka_offset
  FROM events),
raw AS (
  SELECT * FROM sent
  UNION ALL
  SELECT * REPLACE (ingested_at + INTERVAL 1 HOUR AS ingested_at, kafka_partition + 3 AS kafka_partition,
                    CASE WHEN kafka_offset % 16 = 1 THEN 'unknown' ELSE system_status END AS system_status)
  FROM sent WHERE kafka_offset % 8 = 1)"""

STD = f"""
std AS (
  SELECT * REPLACE (upper({_trim('device_id')}) AS device_id, upper({_trim('system_status')}) AS system_status,
                    lower({_trim('schema_version')}) AS schema_version)
  FROM raw)"""

SILVER = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY device_id, event_timestamp
                               ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC) AS copy
  FROM std WHERE device_id IS NOT NULL AND event_timestamp IS NOT NULL AND schema_version IS NOT NULL),
silver AS (
  SELECT * EXCLUDE (copy) FROM ranked
  WHERE copy = 1 AND system_status IN ('HEALTHY', 'DEGRADED', 'CRITICAL')),
old_silver AS (SELECT * FROM silver WHERE event_timestamp < TIMESTAMP '2024-01-16')"""

_AVERAGED = [
    "temperature_mk", "cpu_usage_pct", "memory_usage_pct", "queue_depth", "active_jobs",
    "signal_noise_ratio", "cryogenic_pressure_mbar", "hardware_error_rate",
]


def _gold(name: str, source: str) -> str:
    averages = ", ".join(f"{_r(f'avg({c})', 6)} AS avg_{c}" for c in _AVERAGED)
    score = _r("greatest(0e0, least(100e0, h / n * 100 - d / n * 25 - c / n * 75))", 2)
    return f"""
{name}_counted AS (
  SELECT device_id, count(*) AS n, {averages},
         count(*) FILTER (system_status = 'HEALTHY') AS h,
         count(*) FILTER (system_status = 'DEGRADED') AS d,
         count(*) FILTER (system_status = 'CRITICAL') AS c,
         max(event_timestamp) AS latest_event_timestamp
  FROM {source} GROUP BY device_id),
{name} AS (
  SELECT device_id, n AS total_events, {", ".join(f"avg_{c}" for c in _AVERAGED)},
         h AS healthy_events, d AS degraded_events, c AS critical_events,
         {score} AS health_score, latest_event_timestamp
  FROM {name}_counted)"""


GOLD = _gold("gold", "silver")

DEVICES = f"""
devices AS (
  SELECT {_code('DEV', 's_suppkey', 3)} AS device_id, s_name AS device_name, n_name AS location,
         CAST(50 + s_suppkey % 3 * 25 AS INTEGER) AS qubit_count,
         CASE WHEN s_acctbal >= 0 THEN 'ACTIVE' ELSE 'MAINTENANCE' END AS operational_status
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

JOBS = f"""
jobs AS (
  SELECT {_code('JOB', 'o_orderkey', 8)} AS job_id, {_code('USR', 'o_custkey', 5)} AS user_id,
         {_code('DEV', 'o_custkey', 3)} AS device_id, o_orderdate AS submitted_at,
         o_orderdate + to_milliseconds(o_orderkey % 480 + 20) AS queued_at,
         o_orderkey % 5000 AS queue_time_ms, o_orderkey % 900 AS execution_time_ms,
         CAST(o_orderkey % 40 * 100 + 100 AS INTEGER) AS shots,
         CAST(o_orderkey % 245 + 5 AS INTEGER) AS circuit_depth,
         CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CASE WHEN o_orderstatus = 'F' THEN 'TIMEOUT' END AS error_code
  FROM orders),
timed_jobs AS (
  SELECT *, queued_at + to_milliseconds(queue_time_ms) AS started_at,
         queued_at + to_milliseconds(queue_time_ms) + to_milliseconds(execution_time_ms) AS completed_at
  FROM jobs)"""

JOB_TOPIC = """
job_topic AS (
  SELECT *, CAST(substr(job_id, 4) AS BIGINT) AS kafka_offset, job_id LIKE '%17' AS no_id,
         strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_text,
         CASE WHEN CAST(substr(job_id, 4) AS BIGINT) % 13 = 0 THEN 'malformed_json'
              WHEN job_id LIKE '%17' THEN 'missing_job_id' END AS reject_reason
  FROM jobs)"""

_FAIL = "gate_error > 0.01 OR readout_error > 0.08 OR t1_us < 40 OR t2_us < 30"
CALIBRATIONS = f"""
measured AS (
  SELECT {_code('CAL', 'l_orderkey', 8)} || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_shipdate AS DATE)
           || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS calibration_id,
         {_code('DEV', 'l_suppkey', 3)} AS device_id, {_code('Q', 'l_linenumber', 3)} AS qubit_id,
         l_shipdate AS calibration_timestamp, l_quantity * 4 AS t1_us, l_quantity * 3 AS t2_us,
         l_discount / 8 AS gate_error, l_tax * 1.5e0 AS readout_error, 4.5e0 + l_linenumber / 1e1 AS frequency_ghz
  FROM lineitem),
calibrations AS (
  SELECT *, CASE WHEN {_FAIL} THEN 'FAIL' ELSE 'PASS' END AS calibration_status FROM measured),
recent AS (
  SELECT *, row_number() OVER (PARTITION BY device_id, qubit_id
                               ORDER BY calibration_timestamp DESC, calibration_id DESC) AS recency
  FROM calibrations QUALIFY recency <= 10)"""

DAILY = """
daily AS (
  SELECT device_id, CAST(calibration_timestamp AS DATE) AS date, avg(gate_error) AS avg_gate_error,
         avg(readout_error) AS avg_readout_error, avg(t1_us) AS avg_t1_us, avg(t2_us) AS avg_t2_us,
         count(*) FILTER (calibration_status = 'FAIL') AS failed_calibrations
  FROM calibrations GROUP BY ALL)"""

RATES = f"""
rates AS (
  SELECT device_id, {_r("avg(CASE WHEN status = 'FAILED' THEN 1e0 ELSE 0e0 END) * 100", 2)} AS failure_rate_pct
  FROM jobs GROUP BY device_id),
rated AS (
  SELECT device_id, failure_rate_pct,
         {_r("(sum(failure_rate_pct) OVER () - failure_rate_pct) / (count(*) OVER () - 1)", 6)} AS other_devices_pct
  FROM rates)"""

_RULES = [
    ("HIGH_TEMPERATURE", "HIGH", "temperature_mk > 18.0",
     "printf('%s temperature reached %.2f mK, above threshold 18.00 mK.', device_id, temperature_mk)"),
    ("HARDWARE_ERROR_SPIKE", "CRITICAL", "hardware_error_rate > 0.005e0",
     "printf('%s hardware error rate reached %.6f, above threshold 0.005000.', device_id, hardware_error_rate)"),
    ("QUEUE_PRESSURE", "MEDIUM", "queue_depth > 80",
     "printf('%s queue depth reached %d, above threshold 80.', device_id, queue_depth)"),
    ("LOW_SNR", "HIGH", "signal_noise_ratio < 20.0",
     "printf('%s signal-to-noise ratio dropped to %.2f, below threshold 20.00.', device_id, signal_noise_ratio)"),
    ("DEVICE_DEGRADED", "HIGH", "system_status = 'DEGRADED'", "device_id || ' reported DEGRADED system status.'"),
    ("DEVICE_CRITICAL", "CRITICAL", "system_status = 'CRITICAL'", "device_id || ' reported CRITICAL system status.'"),
]
FOUND = (
    "\nfired AS (\n"
    + "\n  UNION ALL\n".join(
        f"  SELECT device_id, event_timestamp, '{t}' AS incident_type, '{s}' AS severity, {text} AS description"
        f" FROM silver WHERE {cond}"
        for t, s, cond, text in _RULES
    )
    + """),
found AS (
  SELECT 'EVT-' || upper(substr(sha256(device_id || '|' || strftime(event_timestamp, '%Y-%m-%d %H:%M:%S')
           || CASE WHEN epoch_us(event_timestamp) % 1000000 <> 0 THEN strftime(event_timestamp, '.%f') ELSE '' END || '|'
           || incident_type), 1, 24)) AS event_key, *
  FROM fired),
incidents AS (
  SELECT *, event_timestamp + INTERVAL 5 MINUTE AS detected_at,
         CASE WHEN event_timestamp < TIMESTAMP '2024-01-05' THEN 'RESOLVED' ELSE 'OPEN' END AS status
  FROM found),
by_type AS (
  SELECT device_id, incident_type, severity, count(*) AS occurrence_count, min(event_timestamp) AS incident_start,
         max(event_timestamp) AS incident_end, min(detected_at) AS first_detected_at, max(detected_at) AS last_detected_at
  FROM incidents WHERE status = 'OPEN' GROUP BY device_id, incident_type, severity),
by_device AS (
  SELECT device_id, count(*) AS raw_incident_count, count(DISTINCT incident_type) AS incident_type_count,
         count(*) FILTER (severity = 'CRITICAL') AS critical_count, count(*) FILTER (severity = 'HIGH') AS high_count,
         count(*) FILTER (severity = 'MEDIUM') AS medium_count,
         min(event_timestamp) AS incident_start, max(event_timestamp) AS incident_end
  FROM incidents WHERE status = 'OPEN' GROUP BY device_id)"""
)

REDELIVERED = """
redelivered AS (
  SELECT * FROM raw
  UNION ALL
  SELECT * REPLACE (ingested_at + INTERVAL 1 HOUR AS ingested_at) FROM raw WHERE system_status = 'DEGRADED'
  UNION ALL
  SELECT * REPLACE (event_timestamp + INTERVAL 1 DAY AS event_timestamp, ingested_at + INTERVAL 1 DAY AS ingested_at)
  FROM raw WHERE system_status = 'critical'),
positions AS (
  SELECT kafka_partition, kafka_offset, count(*) AS row_count,
         CASE WHEN count(DISTINCT event_timestamp) = 1 THEN 'replayed_ingestion' ELSE 'offset_reuse' END AS interpretation
  FROM redelivered GROUP BY ALL HAVING count(*) > 1)"""

QUESTIONS = """
questions AS (
  SELECT conv_id, turn,
    CASE WHEN conv_id % 4 = 0 THEN printf('why is dev%03d degraded? ', conv_id % 1000)
         WHEN conv_id % 4 = 1 THEN 'Any CRITICAL incidents? '
         WHEN conv_id % 4 = 2 AND turn % 2 = 0 THEN 'Which device has the lowest queue depth? '
         WHEN conv_id % 4 = 2 THEN 'Which device has the highest queue depth? '
         ELSE '' END || text AS text
  FROM conversations),
mentioned AS (
  SELECT *, nullif(upper(regexp_extract(text, '(?i)\\bDEV\\d{3}\\b')), '') AS device_id, lower(text) AS low
  FROM questions)"""

STATEMENTS = f"""
statements AS (
  SELECT conv_id, turn,
    CASE (conv_id * 3 + turn) % 8
      WHEN 0 THEN 'SELECT * FROM gold.device_health -- '
      WHEN 1 THEN '  show tables '
      WHEN 2 THEN 'drop table t; '
      WHEN 3 THEN 'with x as (select 1) delete from t '
      WHEN 4 THEN chr(10) || ' explain select 1;' || chr(10) || 'drop' || chr(10) || 'table t '
      WHEN 5 THEN 'insert into t values '
      WHEN 6 THEN 'Describe t; UPDATE t set a=1 '
      ELSE '' END || text AS statement
  FROM conversations),
cleaned AS (SELECT conv_id, turn, upper({_trim("statement")}) AS s FROM statements)"""

_WRITES = ["INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "CREATE", "TRUNCATE", "MERGE", "CALL", "GRANT", "REVOKE"]


def _verdict(found) -> str:
    cases = " ".join(f"WHEN {found(w)} THEN 'blocked:{w}'" for w in _WRITES)
    return (
        "CASE WHEN s = '' THEN 'empty' WHEN regexp_extract(s, '^\\S+') NOT IN "
        f"('SELECT', 'SHOW', 'DESCRIBE', 'WITH', 'EXPLAIN') THEN 'not_read_only' {cases} END"
    )


_TELEMETRY = (
    "device_id, event_timestamp, temperature_mk, cpu_usage_pct, memory_usage_pct, queue_depth, active_jobs, "
    "signal_noise_ratio, cryogenic_pressure_mbar, hardware_error_rate, system_status, schema_version, ingested_at, "
    "kafka_partition, kafka_offset"
)
_NO_INGEST = _TELEMETRY.replace("ingested_at, ", "")

_RANGES = {
    "temperature_mk": (5, 40), "cpu_usage_pct": (0, 100), "memory_usage_pct": (0, 100), "queue_depth": (0, 500),
    "active_jobs": (0, 500), "signal_noise_ratio": (0, 100), "cryogenic_pressure_mbar": (0, 5),
    "hardware_error_rate": (0, 1),
}
_REQUIRED = ["device_id", "event_timestamp", "schema_version"]
_BAD_STATUS = f"upper({_trim('system_status')}) NOT IN ('HEALTHY', 'DEGRADED', 'CRITICAL')"


def _quality() -> str:
    rows = ["SELECT 'required_columns' AS check_name, '' AS subject, 0 AS violations, CAST(NULL AS VARCHAR) AS said"]
    for c in _REQUIRED:
        n = f"count(*) FILTER ({c} IS NULL)"
        rows.append(f"SELECT 'not_null', '{c}', {n}, '{c} contains ' || {n} || ' NULL values.' FROM raw")
    for c, (low, high) in _RANGES.items():
        n = f"count(*) FILTER ({c} < {low} OR {c} > {high})"
        rows.append(f"SELECT 'ranges', '{c}', {n}, '{c} has ' || {n} || ' values outside [{low}, {high}].' FROM raw")
    n = f"count(*) FILTER ({_BAD_STATUS})"
    named = f"(SELECT string_agg(DISTINCT upper({_trim('system_status')}), ', ' ORDER BY upper({_trim('system_status')})) FROM raw WHERE {_BAD_STATUS})"
    rows.append(
        f"SELECT 'status_values', 'system_status', {n}, 'system_status has ' || {n} || ' invalid values: ' || {named} || '.' FROM raw"
    )
    n = "CAST(sum(n - 1) AS BIGINT)"
    rows.append(
        f"SELECT 'uniqueness', 'device_id + event_timestamp', {n}, 'Found ' || {n} || ' duplicate telemetry events "
        "based on device_id + event_timestamp.' FROM (SELECT count(*) AS n FROM std GROUP BY device_id, event_timestamp)"
    )
    rows.append(
        "SELECT 'freshness', 'event_timestamp', CASE WHEN max(event_timestamp) < TIMESTAMP '2024-01-30 12:00:00' "
        "THEN 1 ELSE 0 END, 'Telemetry is stale. Latest event: ' || max(event_timestamp) || '.' FROM raw"
    )
    return f"""
checked AS ({" UNION ALL ".join(rows)}),
report AS (
  SELECT check_name, subject, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed,
         CASE WHEN violations > 0 THEN said END AS message
  FROM checked)"""


def _violations() -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN 'not_null:{c}' END" for c in _REQUIRED]
    parts += [f"CASE WHEN {c} < {low} OR {c} > {high} THEN 'range:{c}' END" for c, (low, high) in _RANGES.items()]
    parts.append(f"CASE WHEN {_BAD_STATUS} THEN 'status_values:system_status' END")
    return f"concat_ws(';', {', '.join(parts)})"


def _profile(source: str) -> str:
    parts = [f"SELECT 'rows' AS section, CAST(NULL AS VARCHAR) AS value, count(*) AS row_count FROM {source}"]
    for c in ("schema_version", "system_status", "device_id"):
        parts.append(f"SELECT '{c}', {c}, count(*) FROM {source} GROUP BY {c}")
    return " UNION ALL ".join(parts)


def _operating(with_errors: bool) -> str:
    critical = "temperature_mk > 28 OR signal_noise_ratio < 15 OR queue_depth > 130"
    degraded = "temperature_mk > 22 OR signal_noise_ratio < 20 OR queue_depth > 90"
    if with_errors:
        critical += " OR hardware_error_rate > 0.015e0"
        degraded += " OR hardware_error_rate > 0.008e0"
    return f"CASE WHEN {critical} THEN 'CRITICAL' WHEN {degraded} THEN 'DEGRADED' ELSE 'HEALTHY' END"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_S = (RAW, STD, SILVER)
_I = (*_S, FOUND)

_REPORT = (
    "device_id, device_name, location, qubit_count, operational_status, total_events, "
    + ", ".join(
        f"{_r(c, d)} AS {c}"
        for c, d in {
            "avg_temperature_mk": 2, "avg_cpu_usage_pct": 2, "avg_memory_usage_pct": 2, "avg_queue_depth": 2,
            "avg_active_jobs": 2, "avg_signal_noise_ratio": 2, "avg_cryogenic_pressure_mbar": 4,
            "avg_hardware_error_rate": 6, "health_score": 2,
        }.items()
    )
    + ", latest_event_timestamp"
)


def _queue(direction: str) -> str:
    return _with(*_S) + (
        f"SELECT device_id, count(*) AS event_count, {_r('avg(queue_depth)', 2)} AS avg_queue_depth "
        f"FROM silver GROUP BY device_id ORDER BY avg_queue_depth {direction}, device_id LIMIT 5"
    )


_CURRENT = (
    *_S,
    _gold("old_gold", "old_silver"),
    "new_silver AS (SELECT * FROM silver WHERE event_timestamp >= TIMESTAMP '2024-01-16')",
    _gold("new_gold", "new_silver"),
    """current_health AS (
  SELECT *, TIMESTAMP '2024-01-31 12:00:00' AS updated_at FROM new_gold
  UNION ALL
  SELECT *, TIMESTAMP '2024-01-16' FROM old_gold WHERE device_id NOT IN (SELECT device_id FROM new_gold))""",
)

_GAPS = (
    *_S,
    """slots AS (SELECT DISTINCT device_id, epoch_us(event_timestamp) // 3600000000 AS slot FROM silver),
span AS (SELECT min(slot) AS low, max(slot) AS high FROM slots),
edges AS (
  SELECT device_id, lag(slot) OVER (PARTITION BY device_id ORDER BY slot) AS before, slot AS after FROM slots
  UNION ALL SELECT device_id, max(slot), (SELECT high + 1 FROM span) FROM slots GROUP BY device_id),
gaps AS (
  SELECT device_id, make_timestamp((coalesce(before, (SELECT low - 1 FROM span)) + 1) * 3600000000) AS gap_start,
         make_timestamp(after * 3600000000) AS gap_end,
         after - coalesce(before, (SELECT low - 1 FROM span)) - 1 AS missing_slots
  FROM edges WHERE after - coalesce(before, (SELECT low - 1 FROM span)) > 1)""",
)

ORACLE_SQL: dict[str, str] = {
    # Silver
    "clean_silver": _with(*_S) + f"SELECT {_TELEMETRY} FROM silver",
    "incremental_new": _with(*_S) + f"""SELECT {_TELEMETRY} FROM silver s
WHERE NOT EXISTS (SELECT 1 FROM old_silver o WHERE o.device_id = s.device_id AND o.event_timestamp = s.event_timestamp)""",
    "cleaning_funnel": _with(*_S) + """SELECT
  (SELECT count(*) FROM raw) AS received,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM ranked) AS missing_required,
  (SELECT count(*) FROM ranked WHERE copy > 1) AS duplicates,
  (SELECT count(*) FROM ranked WHERE copy = 1) - (SELECT count(*) FROM silver) AS invalid_status,
  (SELECT count(*) FROM silver) AS available,
  (SELECT count(*) FROM old_silver) AS already_processed,
  (SELECT count(*) FROM silver) - (SELECT count(*) FROM old_silver) AS new_events""",
    "schema_conform": _with(RAW) + f"""SELECT {_TELEMETRY} FROM (SELECT * REPLACE (
  CAST(NULL AS DOUBLE) AS cryogenic_pressure_mbar, CAST(NULL AS DOUBLE) AS hardware_error_rate) FROM raw)""",
    # Gold
    "device_health": _with(*_S, GOLD) + "SELECT * FROM gold ORDER BY device_id",
    "health_report": _with(*_S, GOLD, DEVICES) + f"SELECT {_REPORT} FROM devices LEFT JOIN gold USING (device_id)",
    "health_lookup": _with(*_S, GOLD, DEVICES)
    + f"SELECT {_REPORT} FROM devices LEFT JOIN gold USING (device_id) WHERE device_id = 'DEV002'",
    "health_listing": _with(*_S, GOLD) + f"""SELECT device_id, total_events,
  {_r('avg_temperature_mk', 2)} AS avg_temperature_mk, {_r('health_score', 2)} AS health_score FROM gold""",
    "queue_rank_high": _queue("DESC"),
    "queue_rank_low": _queue("ASC"),
    "upsert_devices": _with(*_S, DEVICES) + """SELECT
  coalesce(d.device_id, o.device_id) AS device_id,
  CASE WHEN o.device_id IS NULL THEN d.device_name ELSE 'Observed ' || o.device_id END AS device_name,
  CASE WHEN o.device_id IS NULL THEN d.location ELSE 'FIELD' END AS location,
  CASE WHEN o.device_id IS NULL THEN d.qubit_count ELSE o.depth END AS qubit_count,
  CASE WHEN o.device_id IS NULL THEN d.operational_status ELSE 'ACTIVE' END AS operational_status,
  CASE WHEN d.device_id IS NULL THEN TIMESTAMP '2024-01-31 12:00:00' ELSE TIMESTAMP '2024-01-16' END AS created_at
FROM devices d FULL JOIN (SELECT device_id, max(queue_depth) AS depth FROM silver GROUP BY device_id) o
  ON d.device_id = o.device_id""",
    "upsert_health_current": _with(*_CURRENT) + "SELECT * FROM current_health",
    "current_health_listing": _with(*_CURRENT) + """SELECT device_id, total_events, healthy_events, degraded_events,
  critical_events, health_score, latest_event_timestamp FROM current_health""",
    # Quality
    "quality_report": _with(RAW, STD, _quality()) + "SELECT * FROM report",
    "quality_summary": _with(RAW, STD, _quality()) + """SELECT coalesce(check_name, 'overall') AS check_name,
  bool_and(passed) AS passed, count(*) FILTER (NOT passed) AS error_count
FROM report GROUP BY GROUPING SETS ((check_name), ())""",
    "invalid_statuses": _with(RAW) + f"""SELECT upper({_trim('system_status')}) AS system_status, count(*) AS row_count
FROM raw WHERE {_BAD_STATUS} GROUP BY 1""",
    "quarantine_rows": _with(RAW) + f"""SELECT * FROM (
  SELECT kafka_offset, device_id, event_timestamp, {_violations()} AS violations FROM raw) WHERE violations <> ''""",
    "accepted_rows": _with(RAW) + f"SELECT {_TELEMETRY} FROM raw WHERE {_violations()} = ''",
    "duplicate_rows": _with(RAW, REDELIVERED) + """SELECT device_id, event_timestamp, schema_version, kafka_partition,
  kafka_offset, ingested_at FROM redelivered JOIN positions USING (kafka_partition, kafka_offset)""",
    "duplicate_pairs": _with(RAW, REDELIVERED) + "SELECT * FROM positions",
    "duplicate_totals": _with(RAW, REDELIVERED)
    + "SELECT count(*) AS duplicate_pairs, CAST(sum(row_count) AS BIGINT) AS rows_involved FROM positions",
    "profile": _with(RAW) + _profile("raw"),
    "silver_profile": _with(*_S) + _profile("silver"),
    "status_counts": _with(*_S) + "SELECT system_status, count(*) AS row_count FROM silver GROUP BY 1",
    "version_counts": _with(RAW) + "SELECT schema_version, count(*) AS row_count FROM raw GROUP BY 1",
    "status_crosstab": _with(*_S) + """SELECT device_id, count(*) FILTER (system_status = 'HEALTHY') AS healthy,
  count(*) FILTER (system_status = 'DEGRADED') AS degraded, count(*) FILTER (system_status = 'CRITICAL') AS critical
FROM silver GROUP BY device_id""",
    "registry_totals": _with(DEVICES)
    + "SELECT count(*) AS row_count, CAST(sum(qubit_count) AS BIGINT) AS total FROM devices",
    "lineage_sample": _with(RAW) + """SELECT device_id, kafka_partition, kafka_offset, ingested_at FROM raw
ORDER BY kafka_partition, kafka_offset, ingested_at LIMIT 10""",
    "bronze_head": _with(RAW) + f"SELECT {_TELEMETRY} FROM raw ORDER BY kafka_partition, kafka_offset, ingested_at LIMIT 10",
    # Incidents
    "incidents": _with(*_I)
    + "SELECT event_key, device_id, incident_type, severity, description, event_timestamp FROM found",
    "incidents_insert_absent": _with(*_I) + """SELECT event_key, device_id, incident_type, severity, description,
  event_timestamp, CASE WHEN event_timestamp < TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-01-16'
                        ELSE TIMESTAMP '2024-01-31 12:00:00' END AS detected_at,
  CAST(NULL AS TIMESTAMP) AS resolved_at, 'OPEN' AS status FROM found""",
    "incident_type_summary": _with(*_I) + "SELECT * FROM by_type",
    "device_incident_summary": _with(*_I) + "SELECT * FROM by_device",
    "incident_summary_lookup": _with(*_I) + "SELECT * FROM by_device WHERE device_id = 'DEV002'",
    "open_incidents_ranked": _with(*_I) + """SELECT * FROM by_type ORDER BY CASE severity WHEN 'CRITICAL' THEN 1
  WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'LOW' THEN 4 ELSE 5 END, device_id, incident_type""",
    "critical_incidents": _with(*_I) + """SELECT device_id, incident_type, severity, occurrence_count, incident_start,
  incident_end FROM by_type WHERE severity = 'CRITICAL' ORDER BY occurrence_count DESC, device_id""",
    "incident_type_listing": _with(*_I) + """SELECT device_id, incident_type, severity, occurrence_count, incident_start,
  incident_end FROM by_type ORDER BY device_id, severity, incident_type""",
    "severity_histogram": _with(*_I) + "SELECT severity, count(*) AS incident_count FROM incidents GROUP BY 1",
    "newest_incidents": _with(*_I) + """SELECT event_key, device_id, incident_type, severity, event_timestamp, detected_at,
  status FROM incidents ORDER BY detected_at DESC, event_key DESC LIMIT 20""",
    "device_evidence": _with(*_I, GOLD, DEVICES) + f"""SELECT d.*, s.* EXCLUDE (device_id), t.open_incidents
FROM (SELECT {_REPORT} FROM devices LEFT JOIN gold USING (device_id)) d
LEFT JOIN by_device s ON d.device_id = s.device_id
LEFT JOIN (
  SELECT device_id, string_agg(concat_ws('|', severity, incident_type, occurrence_count, incident_start, incident_end,
                                         first_detected_at, last_detected_at), ';'
           ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 ELSE 3 END, incident_type) AS open_incidents
  FROM by_type GROUP BY device_id) t ON d.device_id = t.device_id""",
    # Readings over time
    "status_classify_v1": _with(RAW) + f"SELECT kafka_offset, {_operating(False)} AS status FROM raw",
    "status_classify_v2": _with(RAW) + f"SELECT kafka_offset, {_operating(True)} AS status FROM raw",
    "running_uptime": _with(*_S) + """SELECT device_id, event_timestamp, 100 + 0.25e0 * row_number() OVER (
  PARTITION BY device_id ORDER BY event_timestamp) AS uptime_hours FROM silver""",
    "time_spine_gaps": _with(*_GAPS) + """SELECT device_id, gap_start, gap_end, missing_slots,
  (epoch_us(gap_end) - epoch_us(gap_start)) / 86400000000e0 AS gap_days FROM gaps""",
    "gap_summary": _with(*_GAPS) + """SELECT device_id, count(*) AS gaps, CAST(sum(missing_slots) AS BIGINT) AS missing_slots,
  min(gap_start) AS first_gap_start, max(gap_end) AS last_gap_end FROM gaps GROUP BY device_id""",
    # Calibrations and jobs
    "calibration_daily": _with(CALIBRATIONS, DAILY) + f"""SELECT device_id, date, {_r('avg_gate_error', 6)} AS avg_gate_error,
  {_r('avg_readout_error', 6)} AS avg_readout_error, {_r('avg_t1_us', 6)} AS avg_t1_us, {_r('avg_t2_us', 6)} AS avg_t2_us,
  failed_calibrations FROM daily""",
    "calibration_status": _with(CALIBRATIONS) + "SELECT * FROM calibrations",
    "calibration_last10": _with(CALIBRATIONS) + """SELECT device_id, qubit_id, CAST(recency AS INTEGER) AS recency, calibration_id,
  calibration_timestamp, calibration_status FROM recent""",
    "distinct_counts": _with(CALIBRATIONS) + """SELECT count(*) AS records, count(DISTINCT device_id) AS devices,
  count(DISTINCT (device_id, qubit_id)) AS device_qubits FROM measured""",
    "job_failure_rate": _with(JOBS, RATES) + "SELECT * FROM rates",
    "job_rate_vs_fleet": _with(JOBS, RATES)
    + "SELECT device_id, failure_rate_pct, other_devices_pct, failure_rate_pct > other_devices_pct AS elevated FROM rated",
    "job_timeline": _with(JOBS) + "SELECT job_id, submitted_at, queued_at, started_at, completed_at FROM timed_jobs",
    "job_failure_probability": _with(JOBS, CALIBRATIONS, DAILY) + f"""SELECT job_id, device_id, submitted_at,
  {_r('''CASE WHEN failed_calibrations IS NULL THEN 0.03e0 ELSE least(greatest(
    0.03e0 + avg_gate_error * 3 + avg_readout_error * 0.4e0 + failed_calibrations * 0.005e0,
    0.01e0), 0.35e0) END''', 6)} AS failure_probability
FROM (SELECT jobs.*, CAST(submitted_at AS DATE) AS job_date FROM jobs)
LEFT JOIN (SELECT device_id, date AS job_date, avg_gate_error, avg_readout_error, failed_calibrations FROM daily)
  USING (device_id, job_date)""",
    "fk_violations": _with(*_S, DEVICES, JOBS, CALIBRATIONS) + """SELECT DISTINCT dataset, device_id FROM (
  SELECT 'calibrations' AS dataset, device_id FROM measured
  UNION ALL SELECT 'jobs', device_id FROM jobs
  UNION ALL SELECT 'telemetry', device_id FROM silver)
WHERE device_id NOT IN (SELECT device_id FROM devices)""",
    "incident_assertions": _with(*_S, DEVICES, JOBS, CALIBRATIONS, RATES) + """SELECT assertion, observed, expected,
  CASE expected WHEN '> 0' THEN observed > 0 ELSE observed = 0 END AS passed
FROM (
  SELECT 'calibration_reaches_fail' AS assertion, CAST(count(*) AS DOUBLE) AS observed, '> 0' AS expected
  FROM recent WHERE device_id = 'DEV002' AND qubit_id = 'Q003' AND calibration_status = 'FAIL'
  UNION ALL SELECT 'telemetry_has_degraded', count(*), '> 0' FROM silver
  WHERE device_id = 'DEV002' AND system_status = 'DEGRADED'
  UNION ALL SELECT 'telemetry_has_critical', count(*), '> 0' FROM silver
  WHERE device_id = 'DEV002' AND system_status = 'CRITICAL'
  UNION ALL SELECT 'job_failures_above_others', round(failure_rate_pct - other_devices_pct, 6), '> 0' FROM rated
  WHERE device_id = 'DEV002'
  UNION ALL SELECT 'calibrations_devices_known', count(DISTINCT device_id), '= 0' FROM measured
  WHERE device_id NOT IN (SELECT device_id FROM devices)
  UNION ALL SELECT 'jobs_devices_known', count(DISTINCT device_id), '= 0' FROM jobs
  WHERE device_id NOT IN (SELECT device_id FROM devices)
  UNION ALL SELECT 'telemetry_devices_known', count(DISTINCT device_id), '= 0' FROM silver
  WHERE device_id NOT IN (SELECT device_id FROM devices))""",
    # Texts
    "device_id_extract": _with(QUESTIONS) + "SELECT conv_id, turn, device_id FROM mentioned",
    "device_id_check": _with(RAW, STD) + """SELECT kafka_offset,
  CASE WHEN regexp_full_match(device_id, 'DEV\\d{3}') THEN device_id END AS device_id FROM std""",
    "question_routing": _with(QUESTIONS) + """SELECT conv_id, turn,
  CASE WHEN device_id IS NOT NULL AND regexp_matches(low, 'why|degraded|degrade|wrong|problem|issue|unhealthy|investigate|failure|failing|anomaly|anomalies')
         THEN 'device_investigation'
       WHEN regexp_matches(low, 'critical incident|critical issue') THEN 'critical_incidents'
       WHEN contains(low, 'queue') AND contains(low, 'depth')
         AND regexp_matches(low, 'highest|lowest|largest|smallest|most|least|max|min') THEN 'queue_ranking'
       ELSE 'general' END AS route,
  CASE WHEN regexp_matches(low, 'lowest|smallest|least|minimum|min ') THEN 'ASC' ELSE 'DESC' END AS direction
FROM mentioned""",
    "sql_audit": _with(STATEMENTS) + f"""SELECT conv_id, turn,
  {_verdict(lambda w: f"contains(' ' || s || ' ', ' {w} ')")} AS verdict,
  {_verdict(lambda w: f"regexp_matches(s, '\\b{w}\\b')")} AS strict_verdict FROM cleaned""",
    "iso_timestamps": """SELECT event_id, CASE event_id % 3 WHEN 0 THEN ts - INTERVAL 2 HOUR
  WHEN 1 THEN ts + INTERVAL '5 hours 30 minutes' ELSE ts END AS event_timestamp FROM events""",
    # Messages and files
    "json_roundtrip": _with(RAW) + f"SELECT {_NO_INGEST} FROM raw WHERE device_id IS NOT NULL",
    "rejected_messages": _with(RAW)
    + "SELECT 'missing_device_id' AS reject_reason, kafka_partition, kafka_offset FROM raw WHERE device_id IS NULL",
    "telemetry_by_version": _with(RAW, STD) + """SELECT device_id AS device, kafka_partition, kafka_offset, event_timestamp,
  temperature_mk, queue_depth, signal_noise_ratio, system_status, schema_version,
  CASE WHEN schema_version = 'v2' THEN cryogenic_pressure_mbar END AS cryogenic_pressure_mbar,
  CASE WHEN schema_version = 'v2' THEN hardware_error_rate END AS hardware_error_rate
FROM std WHERE device_id IS NOT NULL""",
    "job_messages": _with(JOBS, JOB_TOPIC) + """SELECT device_id AS device_key, kafka_offset, job_id, status, error_code,
  queue_time_ms, execution_time_ms, 'v1' AS schema_version FROM job_topic WHERE reject_reason IS NULL""",
    "rejected_jobs": _with(JOBS, JOB_TOPIC) + """SELECT reject_reason, kafka_offset, CASE reject_reason
    WHEN 'malformed_json' THEN substr('{' || CASE WHEN no_id THEN '' ELSE '"job_id":"' || job_id || '",' END
                                      || '"device_id":"' || device_id || '",', 1, 20)
    ELSE '{"device_id":"' || device_id || '","user_id":"' || user_id || '","submitted_at":"' || submitted_text
      || '","queue_time_ms":' || CAST(CAST(queue_time_ms AS DOUBLE) AS VARCHAR) || ',"execution_time_ms":' || execution_time_ms
      || ',"shots":' || shots || ',"circuit_depth":' || circuit_depth || ',"status":"' || status || '"'
      || CASE WHEN error_code IS NULL THEN '' ELSE ',"error_code":"' || error_code || '"' END
      || ',"schema_version":"v1"}' END AS value
FROM job_topic WHERE reject_reason IS NOT NULL""",
    "stream_jobs": _with(JOBS, JOB_TOPIC) + """SELECT kafka_offset,
  CASE WHEN reject_reason IS NULL THEN job_id END AS job_id, reject_reason FROM job_topic""",
    "csv_roundtrip": _with(JOBS) + """SELECT job_id, user_id, device_id, submitted_at, queued_at, started_at, completed_at,
  queue_time_ms, execution_time_ms, shots, circuit_depth, status, error_code FROM timed_jobs""",
    # Tables
    "table_evolution": _with(RAW) + f"SELECT {_TELEMETRY} FROM raw",
    "table_listing": _with(RAW) + """SELECT 'jobs' AS table_name, 0 AS row_count, true AS other_dropped
UNION ALL SELECT 'telemetry', count(*), true FROM raw""",
    # Streaming and pipeline
    "stream_bronze": _with(RAW) + f"SELECT {_NO_INGEST} FROM raw WHERE device_id IS NOT NULL",
    "stream_silver": _with(*_S) + f"SELECT {_TELEMETRY} FROM silver",
    "stream_incidents": _with(*_I) + """SELECT event_key, device_id, incident_type, severity, description, event_timestamp,
  TIMESTAMP '2024-01-31 12:00:00' AS detected_at, 'OPEN' AS status FROM found""",
    "run_metrics": _with(*_S) + """SELECT 'telemetry' AS pipeline_name, 'SUCCESS' AS run_status,
  (SELECT count(*) FROM raw) AS bronze_rows, (SELECT count(*) FROM silver) AS silver_rows,
  (SELECT count(DISTINCT device_id) FROM silver) AS gold_rows""",
    "incidents_after_two_runs": _with(*_I) + """SELECT device_id, count(*) AS raw_incident_count,
  count(*) FILTER (severity = 'CRITICAL') AS critical_count FROM found GROUP BY device_id""",
    "runs_with_late_events": _with(
        RAW,
        """
timed AS (
  SELECT * REPLACE (CASE WHEN kafka_offset % 101 <> 0 THEN event_timestamp END AS event_timestamp) FROM raw)""",
        STD.replace("FROM raw", "FROM timed"),
        SILVER,
    )
    + """SELECT 'SUCCESS' AS run_status, (SELECT count(*) FROM timed WHERE event_timestamp >= TIMESTAMP '2024-01-16') AS bronze_rows,
  count(*) AS silver_rows, count(DISTINCT device_id) AS gold_rows,
  (SELECT count(*) FROM timed WHERE event_timestamp IS NULL) AS untimed_rows_kept
FROM silver WHERE event_timestamp >= TIMESTAMP '2024-01-16'
UNION ALL
SELECT 'SUCCESS', (SELECT count(*) FROM timed WHERE event_timestamp IS NULL OR event_timestamp < TIMESTAMP '2024-01-16'),
  (SELECT count(*) FROM old_silver), count(DISTINCT device_id), (SELECT count(*) FROM timed WHERE event_timestamp IS NULL)
FROM silver""",
    "incident_summary_kept_up": _with(*_I) + """SELECT device_id, incident_type, severity,
  CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'LOW' THEN 4 ELSE 5 END AS severity_rank,
  occurrence_count, incident_start, incident_end FROM by_type""",
    "stream_metrics": _with(
        *_S,
        """
counted AS (
  SELECT count(*) AS messages, count(*) FILTER (device_id IS NULL) AS rejected, (SELECT count(*) FROM silver) AS new
  FROM raw)""",
    )
    + """SELECT 'silver' AS stream, 0::BIGINT AS batch_number, messages, rejected, new AS accepted, messages - rejected - new AS surplus FROM counted
UNION ALL SELECT 'silver', 1, messages, rejected, 0, messages - rejected FROM counted""",
}

ORACLE_SQL["upsert_buckets"] = ORACLE_SQL["upsert_devices"]
ORACLE_SQL["uptime_from_carry"] = (
    f"SELECT * FROM ({ORACLE_SQL['running_uptime']}) WHERE event_timestamp >= TIMESTAMP '2024-01-16'"
)
ORACLE_SQL["gaps_from_carry"] = _with(
    *_S,
    """slots AS (SELECT DISTINCT device_id, epoch_us(event_timestamp) // 3600000000 AS slot FROM silver),
pairs AS (SELECT device_id, lag(slot) OVER (PARTITION BY device_id ORDER BY slot) AS before, slot AS after FROM slots)""",
) + """SELECT device_id, make_timestamp((before + 1) * 3600000000) AS gap_start, make_timestamp(after * 3600000000) AS gap_end,
  after - before - 1 AS missing_slots, (after - before - 1) / 24e0 AS gap_days
FROM pairs WHERE after - before > 1 AND after * 3600000000 >= epoch_us(TIMESTAMP '2024-01-16')"""
ORACLE_SQL["late_bound_column"] = _with(*_S) + """SELECT device_id, event_timestamp, kafka_offset,
  CASE WHEN kafka_offset % 3 <> 0 THEN 'S' || (kafka_offset % 5) END AS site FROM silver"""
