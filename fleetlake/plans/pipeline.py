"""The batch pipeline (gate, silver, gold, operational tables) and SQL over its tables."""

from __future__ import annotations

import re
from collections.abc import Collection
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.text import READ_COMMANDS, WRITE_COMMANDS
from fleetlake.operators.cleaning import (
    IDENTITY,
    clean,
    latest_copies,
    on_dates,
    standardize_identity,
    touched_dates,
    unseen,
)
from fleetlake.operators.health import daily_health, health_of_days
from fleetlake.operators.incidents import absent, daily_summary, detect, device_totals, opened, summary_of_days
from fleetlake.operators.quality import CHECKS, gate, quality_measures, report_of, split_quarantine
from fleetlake.operators.series import SLOT_MINUTES, gaps_ending_on, uptime_of_dates
from fleetlake.plans.readonly import require_known
from fleetlake.plans.sqlfunctions import FUNCTIONS, register_functions
from fleetlake.schemas import DEVICE_HEALTH, DEVICES, EVENT_DATE, QUARANTINE
from fleetlake.session import kept
from fleetlake.sources.tables import NAMESPACES, Lake, conform

def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


Dates = tuple[date, date] | DataFrame


def changed_dates(lake: Lake, pending: DataFrame | None = None) -> DataFrame | None:
    """The event dates of bronze's writes that no successful run has taken; None before the first run.

    The ledger tells, by commits and dates: an append that is committed after a run has looked is seen by the
    next one, however long it took, and so is a batch that was written again. NULL stands for rows without an
    event time. ``pending`` are the lake's ``pending_dates``.
    """
    if lake.read("ops.pipeline_runs").filter("run_status = 'SUCCESS'").isEmpty():
        return None
    return (lake.pending_dates() if pending is None else pending).select(EVENT_DATE).distinct()


def _read_dates(lake: Lake, table: str, dates: Dates | None) -> DataFrame:
    """An event table, cut to the date partitions asked for."""
    return _cut(lake.read(table), dates)


def _cut(rows: DataFrame, dates: Dates | None) -> DataFrame:
    """Rows without a date belong to every range, as no range would ever take them."""
    if dates is None or isinstance(dates, DataFrame):
        return on_dates(rows, dates)
    return rows.filter(F.col(EVENT_DATE).between(*dates) | F.col(EVENT_DATE).isNull())


def refresh_silver(lake: Lake, dates: Dates | None = None) -> int:
    """Append bronze events that silver lacks; returns their number."""
    bronze = _read_dates(lake, "bronze.telemetry", dates)
    silver = _read_dates(lake, "silver.telemetry", dates)
    return lake.append_events("silver.telemetry", unseen(clean(bronze), silver, standard=True), placed=True)


def fill_column(lake: Lake, name: str, kind: T.DataType, dates: Dates | None = None) -> None:
    """Give silver a column, and its events of ``dates`` the value that was sent, also where they came before the column.

    The value is that of the event's last copy among the payloads kept by the stream; it stays NULL where the event did not
    have the field or it does not fit the type. Values that are there already stay. The dates are written anew.
    """
    lake.add_missing_columns("silver.telemetry", T.StructType([T.StructField(name, kind)]))
    silver = _read_dates(lake, "silver.telemetry", dates)
    sent = standardize_identity(_read_dates(lake, "ops.payloads", dates))
    value = F.try_variant_get("payload", f"$.{name}", kind.simpleString())
    last = latest_copies(sent.withColumn("_sent", value).drop("payload")).select(*IDENTITY, "_sent")
    filled = silver.join(last, list(IDENTITY), "left").withColumn(name, F.coalesce(name, "_sent"))
    lake.replace_dates("silver.telemetry", kept(filled.select(silver.columns), "filled"))


def refresh_gold(lake: Lake, dates: Dates | None = None) -> int:
    """Rebuild device health; returns the number of devices.

    Silver is read for ``dates`` only (or all of it): its daily sums replace those dates,
    and health is added up from the sums of all days.
    """
    lake.replace_dates("gold.device_health_daily", daily_health(_read_dates(lake, "silver.telemetry", dates)))
    return lake.replace("gold.device_health", health_of_days(lake.read("gold.device_health_daily")))


def uptime_on(lake: Lake, dates: Dates | None, start: float = 0.0) -> DataFrame:
    """Silver's events of ``dates`` with their device's uptime so far; gold's daily counts carry that of earlier dates.

    A late date changes the uptime of all later ones, which the next call gives: no total is stored.
    """
    events = _read_dates(lake, "silver.telemetry", dates).drop(EVENT_DATE)
    return uptime_of_dates(events, lake.read("gold.device_health_daily"), start)


def gaps_on(lake: Lake, dates: Dates | None, step_minutes: int = SLOT_MINUTES) -> DataFrame:
    """The stretches without a reading that end on ``dates``; what came before these is told by gold's daily rows."""
    events = _read_dates(lake, "silver.telemetry", dates).drop(EVENT_DATE)
    return gaps_ending_on(events, lake.read("gold.device_health_daily"), step_minutes)


def refresh_quarantine(lake: Lake, dates: Dates | None = None) -> None:
    """Keep the bronze rows that break a row rule, with the rules, in place of those of the same dates."""
    bad = split_quarantine(_read_dates(lake, "bronze.telemetry", dates))[1]
    bad = conform(bad, QUARANTINE).withColumn(EVENT_DATE, F.to_date("event_timestamp"))
    lake.replace_dates("ops.quarantine", bad, cleared=_cut(lake.dates_of("ops.quarantine"), dates))


def sync_devices(lake: Lake, devices: DataFrame) -> None:
    """Upsert registry rows; a device keeps its creation time."""
    update = [c for c in DEVICES.fieldNames() if c not in ("device_id", "created_at")]
    source = devices.withColumn("created_at", F.current_timestamp().cast("timestamp_ntz"))
    lake.upsert("ops.devices", source, update)


def sync_current_health(lake: Lake, now: datetime | None = None) -> None:
    """Upsert gold into the current health; devices that gold lacks keep their last state."""
    stamp = F.lit(now or utc_now()).cast("timestamp_ntz")
    update = [c for c in DEVICE_HEALTH.fieldNames() if c != "device_id"]
    lake.upsert("ops.device_health_current", lake.read("gold.device_health"), update, {"updated_at": stamp})


def record_incidents(lake: Lake, detected_at: datetime | None = None, dates: Dates | None = None) -> int:
    """Insert the incidents of silver events that are not recorded yet, in one detection; returns their number.

    The daily summaries of the dates are renewed.
    """
    found = detect(_read_dates(lake, "silver.telemetry", dates))
    new_ones = absent(found, _read_dates(lake, "ops.incidents", dates))
    added = lake.append_events("ops.incidents", opened(new_ones, detected_at or utc_now()), placed=True)
    refresh_incident_summary(lake, dates)
    return added


def run_pipeline(
    lake: Lake,
    as_of: datetime | None = None,
    fail_on: Collection[str] = CHECKS,
    dates: Dates | None = None,
    full: bool = False,
) -> dict:
    """Gate, quarantine, silver, gold, current health, incidents; the outcome is kept in ``pipeline_runs``.

    All steps are limited to ``dates``, by default those that the ledger says no successful run has taken, or to
    nothing with ``full``; gold describes all of silver in any case. Rows without an event time are a date of
    their own, which every range includes. Without new events nothing is done. The gate's one pass over bronze also
    counts its rows; how fresh the data are is told by the latest event in all of bronze, so late data pass.
    """
    started = utc_now()
    run = {"pipeline_name": "telemetry", "run_status": "SUCCESS", "bronze_rows": 0, "silver_rows": 0, "gold_rows": None}
    try:
        pending = kept(lake.pending_dates(), "pending")  # as of now: later writes are the next run's
        if dates is None and not full:
            dates = changed_dates(lake, pending)
        bronze = _read_dates(lake, "bronze.telemetry", dates)
        measures = quality_measures(bronze)
        measured = measures.first()
        run["bronze_rows"] = measured["rows"]
        if measured["rows"] or dates is None or not isinstance(dates, DataFrame):
            latest = max(filter(None, (measured["latest"], lake.latest_event())), default=None)
            counted = lake.spark.createDataFrame([{**measured.asDict(), "latest": latest}], measures.schema)
            gate(report_of(counted, bronze, as_of or utc_now()), fail_on)
            refresh_quarantine(lake, dates)
            run["silver_rows"] = refresh_silver(lake, dates)
            run["gold_rows"] = refresh_gold(lake, dates)
            sync_current_health(lake, as_of)
            record_incidents(lake, as_of, dates)
            lake.mark_done(_cut(pending, dates))
    except Exception:
        run["run_status"] = "FAILED"
        raise
    finally:
        done = utc_now()
        row = {**run, "started_at": started, "completed_at": done, "created_at": done}
        schema = lake.read("ops.pipeline_runs").schema
        lake.append_rows("ops.pipeline_runs", lake.spark.createDataFrame([row], schema))
    return run


def refresh_incident_summary(lake: Lake, dates: Dates | None = None) -> None:
    """Add the incidents of ``dates`` up anew, by day; the days of a date without open incidents become empty."""
    daily = daily_summary(_read_dates(lake, "ops.incidents", dates))
    lake.replace_dates("gold.incident_daily", daily, cleared=_cut(lake.dates_of("gold.incident_daily"), dates))


def resolve_incidents(lake: Lake, resolved: DataFrame, resolved_at: datetime | None = None) -> None:
    """Resolve the open incidents named by ``event_key``; ``event_timestamp`` tells their dates, the only ones read.

    The dates are written anew, and the daily summaries of these dates with them. Unknown keys and
    incidents that are resolved already change nothing.
    """
    resolved = kept(resolved.select("event_key", "event_timestamp").distinct(), "resolved")
    dates = kept(touched_dates(resolved), "dates")
    table = _read_dates(lake, "ops.incidents", dates)
    named = resolved.select("event_key", F.lit(True).alias("_named")).distinct()
    ends = F.col("_named") & (F.col("status") == "OPEN")
    now = F.lit(resolved_at or utc_now()).cast("timestamp_ntz")
    changed = table.join(named, "event_key", "left").withColumns(
        {
            "resolved_at": F.when(ends, now).otherwise(F.col("resolved_at")),
            "status": F.when(ends, "RESOLVED").otherwise(F.col("status")),
        }
    )
    lake.replace_dates("ops.incidents", kept(changed.select(table.columns), "incidents"))
    refresh_incident_summary(lake, dates)


OPEN_INCIDENTS = "open_incidents"
VIEWS = ("incident_type_summary", "device_incident_summary")


def register_views(lake: Lake) -> None:
    """The two incident summaries as temporary views next to the tables, and the domain's SQL functions.

    The views add up the daily summaries, so no incident is read. ``open_incidents(device)`` is a table function.
    """
    by_type = summary_of_days(lake.read("gold.incident_daily"))
    by_type.createOrReplaceTempView(VIEWS[0])
    device_totals(by_type).createOrReplaceTempView(VIEWS[1])
    register_functions(lake.spark)
    lake.spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {OPEN_INCIDENTS}(device STRING) RETURNS TABLE (incident_type STRING, "
        "severity STRING, occurrence_count BIGINT, incident_start TIMESTAMP_NTZ, incident_end TIMESTAMP_NTZ) "
        "RETURN SELECT incident_type, severity, occurrence_count, incident_start, incident_end "
        f"FROM {VIEWS[0]} WHERE device_id = valid_device_id(device)"
    )


# Comments and quoted texts, in which a command is only a word. A backslash may or may not
# escape a quote (it does not in raw literals), so both readings have to be harmless.
_COMMENT = r"--[^\r\n]*|/\*.*?\*/|`[^`]*`"
_QUOTED = [
    re.compile(rf"""{_COMMENT}|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\"""", re.DOTALL),
    re.compile(rf"""{_COMMENT}|'[^']*'|"[^"]*\"""", re.DOTALL),
]
_WRITES = re.compile(rf"\b({'|'.join(WRITE_COMMANDS)})\b", re.IGNORECASE)


def require_read_only(statement: str) -> str:
    """The statement without surrounding blanks, if it only reads; otherwise ValueError."""
    text = statement.strip()
    first = re.match(r"\S*", text).group().upper()
    if first not in READ_COMMANDS:
        raise ValueError("only read-only statements are allowed")
    for quoted in _QUOTED:
        written = _WRITES.search(quoted.sub(" ", text))
        if written:
            raise ValueError(f"blocked operation: {written.group().upper()}")
    return text


def query(lake: Lake, statement: str) -> DataFrame:
    """Run one read-only statement over the lake's tables and views, with known functions (see ``plans/readonly.py``)."""
    text = require_read_only(statement)
    namespaces = {f"{lake.prefix}{n}" for n in NAMESPACES}
    tables = {f"{lake.prefix}{n}.{t}" for n in NAMESPACES for t in lake.list_tables(n)}
    require_known(lake.spark, text, tables | set(VIEWS), namespaces, {*FUNCTIONS, OPEN_INCIDENTS})
    return lake.spark.sql(text)
