"""The named queries: every operator of the lake applied to whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake import schemas
from fleetlake.functions import rules, text, times
from fleetlake.functions.numbers import settle
from fleetlake.operators import (
    assertions,
    calibration,
    cleaning,
    duplicates,
    health,
    incidents,
    jobs,
    profile,
    quality,
    series,
)
from fleetlake.plans import datasets, pipeline
from fleetlake.session import kept, scratch_dir
from fleetlake.sources import files, messages
from fleetlake.sources.tables import Lake, conform, merge_upsert
from fleetlake.streaming import ingest

SPLIT = datetime(2024, 1, 16)
AS_OF = datetime(2024, 1, 31, 12)
RESOLVED_BEFORE = datetime(2024, 1, 5)
SLOT_MINUTES = 60
TARGET_DEVICE, TARGET_QUBIT = "DEV002", "Q003"

Query = Callable[[SparkSession, str], DataFrame]
REPORTS: dict[str, Query] = {}


def report(fn: Query) -> Query:
    """Register a query under its function's name, without the underscore that avoids a clash."""
    REPORTS[fn.__name__.rstrip("_")] = fn
    return fn


# Shared inputs -----------------------------------------------------------------------


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.telemetry_raw(spark, sf)


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean(_raw(spark, sf))


def _silver_before_split(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(spark, sf).filter(F.col("event_timestamp") < F.lit(SPLIT).cast("timestamp_ntz"))


def _incidents(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents of all silver events, detected five minutes later, the earliest resolved."""
    return _incidents_of(_silver(spark, sf))


def _incidents_of(silver: DataFrame) -> DataFrame:
    old = F.col("event_timestamp") < F.lit(RESOLVED_BEFORE).cast("timestamp_ntz")
    found = incidents.detect(silver)
    return found.withColumn("detected_at", F.col("event_timestamp") + F.expr("INTERVAL 5 MINUTES")).withColumn(
        "status", F.when(old, "RESOLVED").otherwise("OPEN")
    )


def _type_summary(spark: SparkSession, sf: str) -> DataFrame:
    return incidents.type_summary(_incidents(spark, sf))


def _calibrations(spark: SparkSession, sf: str) -> DataFrame:
    return calibration.with_status(datasets.calibrations(spark, sf))


def _halves(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    before = F.col("event_timestamp") < F.lit(SPLIT).cast("timestamp_ntz")
    return silver.filter(before), silver.filter(~before)


def _messages(raw: DataFrame, *more: str) -> DataFrame:
    """Telemetry as a topic delivers it, with ``more`` columns as fields that no schema knows."""
    return messages.to_messages(raw, [*schemas.PAYLOAD.fieldNames(), *more]).select(
        "key",
        "value",
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ingested_at").cast("timestamp").alias("timestamp"),
    )


def _new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, scratch_dir(spark, "lake"), f"t{uuid.uuid4().hex[:10]}_").create_all()


# Silver ------------------------------------------------------------------------------


@report
def clean_silver(spark, sf):
    return _silver(spark, sf)


@report
def incremental_new(spark, sf):
    return cleaning.unseen(_silver(spark, sf), _silver_before_split(spark, sf))


@report
def cleaning_funnel(spark, sf):
    return cleaning.cleaning_funnel(_raw(spark, sf), _silver_before_split(spark, sf))


@report
def schema_conform(spark, sf):
    raw = _raw(spark, sf)
    old = raw.select([F.col(c).cast("string") for c in raw.columns if c not in schemas.V2_ONLY] + [F.lit(1).alias("extra")])
    return conform(old, schemas.TELEMETRY)


# Gold --------------------------------------------------------------------------------


@report
def device_health(spark, sf):
    return health.device_health(_silver(spark, sf)).orderBy("device_id")


@report
def health_report(spark, sf):
    return health.health_report(datasets.devices(spark, sf), health.device_health(_silver(spark, sf)))


@report
def health_lookup(spark, sf):
    gold = health.device_health(_silver(spark, sf))
    return health.health_report(datasets.devices(spark, sf), gold, TARGET_DEVICE)


@report
def health_listing(spark, sf):
    return health.health_listing(health.device_health(_silver(spark, sf)))


@report
def queue_rank_high(spark, sf):
    return health.queue_ranking(_silver(spark, sf), "DESC")


@report
def queue_rank_low(spark, sf):
    return health.queue_ranking(_silver(spark, sf), "ASC")


def _observed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """The registry, what was observed of devices, and the columns that observation renews."""
    registry = datasets.devices(spark, sf).withColumn("created_at", F.lit(SPLIT).cast("timestamp_ntz"))
    observed = (
        _silver(spark, sf)
        .groupBy("device_id")
        .agg(F.max("queue_depth").alias("qubit_count"))
        .select(
            "device_id",
            F.concat(F.lit("Observed "), "device_id").alias("device_name"),
            F.lit("FIELD").alias("location"),
            "qubit_count",
            F.lit("ACTIVE").alias("operational_status"),
            F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"),
        )
    )
    return registry, observed, ["device_name", "location", "qubit_count", "operational_status"]


@report
def upsert_devices(spark, sf):
    registry, observed, update = _observed(spark, sf)
    return merge_upsert(registry, observed, "device_id", update)


@report
def upsert_buckets(spark, sf):
    """As upsert_devices, in the lake's table, of which only the buckets that are touched are written anew."""
    registry, observed, update = _observed(spark, sf)
    lake = _new_lake(spark)
    lake.upsert("ops.devices", registry, update)
    lake.upsert("ops.devices", observed, update)
    return lake.read("ops.devices").select(schemas.DEVICES.fieldNames())


@report
def upsert_health_current(spark, sf):
    stamp = F.lit(SPLIT).cast("timestamp_ntz")
    before, after = _halves(kept(_silver(spark, sf)))
    current = health.device_health(before).withColumn("updated_at", stamp)
    gold = health.device_health(after)
    update = [c for c in gold.columns if c != "device_id"]
    merged = merge_upsert(
        current, gold, "device_id", update, {"updated_at": F.lit(AS_OF).cast("timestamp_ntz")}
    )
    return merged


@report
def current_health_listing(spark, sf):
    return health.current_health_listing(upsert_health_current(spark, sf))


# Quality -----------------------------------------------------------------------------


@report
def quality_report(spark, sf):
    return quality.quality_report(_raw(spark, sf), AS_OF)


@report
def quality_summary(spark, sf):
    return quality.check_summary(quality.quality_report(_raw(spark, sf), AS_OF))


@report
def invalid_statuses(spark, sf):
    return quality.invalid_statuses(_raw(spark, sf))


@report
def quarantine_rows(spark, sf):
    bad = quality.split_quarantine(_raw(spark, sf))[1]
    return bad.select(
        "kafka_offset", "device_id", "event_timestamp", F.array_join("violations", ";").alias("violations")
    )


@report
def accepted_rows(spark, sf):
    return quality.split_quarantine(_raw(spark, sf))[0]


@report
def duplicate_rows(spark, sf):
    return duplicates.duplicate_report(datasets.telemetry_redelivered(spark, sf))


@report
def duplicate_pairs(spark, sf):
    return duplicates.duplicate_positions(datasets.telemetry_redelivered(spark, sf))


@report
def duplicate_totals(spark, sf):
    return duplicates.duplicate_totals(datasets.telemetry_redelivered(spark, sf))


@report
def profile_(spark, sf):
    return profile.profile(_raw(spark, sf))


@report
def silver_profile(spark, sf):
    return profile.profile(_silver(spark, sf))


@report
def status_counts(spark, sf):
    return profile.value_counts(_silver(spark, sf), "system_status")


@report
def version_counts(spark, sf):
    return profile.value_counts(_raw(spark, sf), "schema_version", with_null=True)


@report
def status_crosstab(spark, sf):
    return profile.status_crosstab(_silver(spark, sf))


@report
def registry_totals(spark, sf):
    return profile.column_total(datasets.devices(spark, sf), "qubit_count")


@report
def lineage_sample(spark, sf):
    first = _raw(spark, sf).orderBy("kafka_partition", "kafka_offset", "ingested_at")
    return profile.lineage_sample(first)


@report
def bronze_head(spark, sf):
    return profile.head(_raw(spark, sf).orderBy("kafka_partition", "kafka_offset", "ingested_at"))


# Incidents ---------------------------------------------------------------------------


@report
def incidents_(spark, sf):
    return incidents.detect(_silver(spark, sf))


@report
def incidents_insert_absent(spark, sf):
    silver = kept(_silver(spark, sf))
    existing = incidents.opened(incidents.detect(_halves(silver)[0]), SPLIT)
    new_ones = incidents.absent(incidents.detect(silver), existing)
    return existing.unionByName(incidents.opened(new_ones, AS_OF))


@report
def incident_type_summary(spark, sf):
    return _type_summary(spark, sf)


@report
def device_incident_summary(spark, sf):
    return incidents.device_summary(_incidents(spark, sf))


@report
def incident_summary_lookup(spark, sf):
    return incidents.summary_of(_incidents(spark, sf), TARGET_DEVICE)


@report
def open_incidents_ranked(spark, sf):
    return incidents.open_ranked(_type_summary(spark, sf))


@report
def critical_incidents(spark, sf):
    return incidents.critical(_type_summary(spark, sf))


@report
def incident_type_listing(spark, sf):
    return incidents.type_listing(_type_summary(spark, sf))


@report
def severity_histogram(spark, sf):
    return incidents.severity_histogram(_incidents(spark, sf))


@report
def newest_incidents(spark, sf):
    return incidents.newest(_incidents(spark, sf))


@report
def device_evidence(spark, sf):
    silver = kept(_silver(spark, sf))
    found = incidents.device_evidence(datasets.devices(spark, sf), health.device_health(silver), _incidents_of(silver))
    times_ = ("incident_start", "incident_end", "first_detected_at", "last_detected_at")
    listed = F.transform(
        "open_incidents",
        lambda i: F.concat_ws(
            "|", i.severity, i.incident_type, i.occurrence_count.cast("string"), *[i[c].cast("string") for c in times_]
        ),
    )
    return found.select("device_health.*", "incident_summary.*", F.array_join(listed, ";").alias("open_incidents"))


# Readings over time ------------------------------------------------------------------


@report
def status_classify_v1(spark, sf):
    status = rules.operating_status(F.col("temperature_mk"), F.col("signal_noise_ratio"), F.col("queue_depth"))
    return _raw(spark, sf).select("kafka_offset", status.alias("status"))


@report
def status_classify_v2(spark, sf):
    status = rules.operating_status(
        F.col("temperature_mk"), F.col("signal_noise_ratio"), F.col("queue_depth"), F.col("hardware_error_rate")
    )
    return _raw(spark, sf).select("kafka_offset", status.alias("status"))


@report
def running_uptime(spark, sf):
    total = series.uptime_hours(_silver(spark, sf), 100.0)
    return total.select("device_id", "event_timestamp", "uptime_hours")


@report
def time_spine_gaps(spark, sf):
    return series.missing_slots(_silver(spark, sf), SLOT_MINUTES)


@report
def gap_summary(spark, sf):
    return series.gap_summary(_silver(spark, sf), SLOT_MINUTES)


# Calibrations and jobs ---------------------------------------------------------------


@report
def calibration_daily(spark, sf):
    daily = calibration.daily_health(_calibrations(spark, sf))
    averages = [c for c in daily.columns if c.startswith("avg_")]
    return daily.withColumns({c: settle(F.col(c), 6) for c in averages})


@report
def calibration_status(spark, sf):
    return _calibrations(spark, sf)


@report
def calibration_last10(spark, sf):
    return calibration.latest_records(_calibrations(spark, sf)).select(
        "device_id", "qubit_id", "recency", "calibration_id", "calibration_timestamp", "calibration_status"
    )


@report
def distinct_counts(spark, sf):
    return calibration.distinct_counts(datasets.calibrations(spark, sf))


@report
def job_failure_rate(spark, sf):
    return jobs.failure_rates(datasets.jobs(spark, sf))


@report
def job_rate_vs_fleet(spark, sf):
    return jobs.rate_against_fleet(datasets.jobs(spark, sf))


@report
def job_timeline(spark, sf):
    return jobs.timeline(datasets.jobs(spark, sf)).select(
        "job_id", "submitted_at", "queued_at", "started_at", "completed_at"
    )


@report
def job_failure_probability(spark, sf):
    scored = jobs.failure_probability(datasets.jobs(spark, sf), _calibrations(spark, sf))
    return scored.select(
        "job_id", "device_id", "submitted_at", settle(F.col("failure_probability"), 6).alias("failure_probability")
    )


@report
def fk_violations(spark, sf):
    return jobs.unknown_devices(
        datasets.devices(spark, sf),
        calibrations=datasets.calibrations(spark, sf),
        jobs=datasets.jobs(spark, sf),
        telemetry=_silver(spark, sf),
    )


@report
def incident_assertions(spark, sf):
    return assertions.incident_assertions(
        datasets.devices(spark, sf),
        _calibrations(spark, sf),
        datasets.jobs(spark, sf),
        kept(_silver(spark, sf)),
        TARGET_DEVICE,
        TARGET_QUBIT,
    )


# Texts -------------------------------------------------------------------------------


@report
def device_id_extract(spark, sf):
    return datasets.questions(spark, sf).select("conv_id", "turn", text.mentioned_device_id(F.col("text")).alias("device_id"))


@report
def device_id_check(spark, sf):
    return _raw(spark, sf).select("kafka_offset", text.valid_device_id(F.col("device_id")).alias("device_id"))


@report
def question_routing(spark, sf):
    return datasets.questions(spark, sf).select(
        "conv_id",
        "turn",
        text.question_route(F.col("text")).alias("route"),
        text.ranking_direction(F.col("text")).alias("direction"),
    )


@report
def sql_audit(spark, sf):
    return datasets.statements(spark, sf).select(
        "conv_id",
        "turn",
        text.statement_verdict(F.col("statement")).alias("verdict"),
        text.statement_verdict(F.col("statement"), strict=True).alias("strict_verdict"),
    )


@report
def iso_timestamps(spark, sf):
    e = datasets.table(spark, sf, "events")
    zone = F.when(F.col("event_id") % 3 == 0, "+02:00").when(F.col("event_id") % 3 == 1, "-05:30").otherwise("Z")
    extended = F.concat(F.regexp_replace(F.col("ts").cast("string"), " ", "T"), zone)
    digits = F.date_format("ts", "yyyyMMdd'T'HHmmss.SSSSSS")
    basic = F.concat(digits, F.lit("789"), F.regexp_replace(zone, ":", ""))
    iso = F.when(F.col("event_id") % 5 == 0, basic).otherwise(extended)
    return e.select("event_id", times.naive_utc(iso).alias("event_timestamp"))


# Messages and files ------------------------------------------------------------------


@report
def json_roundtrip(spark, sf):
    decoded = messages.decode_telemetry(_messages(_raw(spark, sf)))
    return messages.accepted(decoded).drop("ingested_at")


@report
def rejected_messages(spark, sf):
    decoded = messages.decode_telemetry(_messages(_raw(spark, sf)))
    return messages.rejected(decoded).select("reject_reason", "kafka_partition", "kafka_offset")


@report
def telemetry_by_version(spark, sf):
    return messages.telemetry_view(_messages(cleaning.standardize(_raw(spark, sf))))


def _job_topic(spark: SparkSession, sf: str) -> DataFrame:
    """Job events as a topic delivers them; every thirteenth is cut off, and every seventeenth has no id."""
    events = datasets.jobs(spark, sf).select(
        F.when(F.substring("job_id", -2, 2) != "17", F.col("job_id")).alias("job_id"),
        "device_id",
        "user_id",
        F.col("submitted_at").cast("string").alias("submitted_at"),
        F.col("queue_time_ms").cast("double").alias("queue_time_ms"),
        "execution_time_ms",
        "shots",
        "circuit_depth",
        "status",
        "error_code",
        F.lit("v1").alias("schema_version"),
        F.substring("job_id", 4, 20).cast("long").alias("offset"),
        F.lit(0).alias("partition"),
        F.col("submitted_at").cast("timestamp").alias("timestamp"),
    )
    topic = messages.to_messages(events, schemas.JOB_EVENT.fieldNames())
    cut = F.when(F.col("offset") % 13 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    return topic.withColumn("value", cut)


_JOB_COLUMNS = (
    "device_key", "kafka_offset", "job_id", "status", "error_code", "queue_time_ms", "execution_time_ms", "schema_version"
)


@report
def job_messages(spark, sf):
    decoded = messages.decode_jobs(_job_topic(spark, sf))
    return messages.accepted(decoded, schemas.JOBS).select(*_JOB_COLUMNS)


@report
def rejected_jobs(spark, sf):
    return messages.rejected(messages.decode_jobs(_job_topic(spark, sf))).select("reject_reason", "kafka_offset", "value")


@report
def stream_jobs(spark, sf):
    """Job messages in the bronze table next to those kept aside: every message is in one of the two."""
    lake, topic = _new_lake(spark), scratch_dir(spark, "topic")
    messages.write_messages(_job_topic(spark, sf), topic)
    ingest.ingest_jobs(lake, {"files": topic}, scratch_dir(spark, "progress")).awaitTermination()
    kept = lake.read("bronze.jobs").select("kafka_offset", "job_id", F.lit(None).cast("string").alias("reject_reason"))
    aside = lake.read("bronze.rejected").select("kafka_offset", F.lit(None).cast("string").alias("job_id"), "reject_reason")
    return kept.unionByName(aside)


@report
def csv_roundtrip(spark, sf):
    path = scratch_dir(spark, "jobs-csv")
    files.write_csv(jobs.timeline(datasets.jobs(spark, sf)).select(*schemas.JOBS_CSV.fieldNames()), path)
    return files.read_csv(spark, path, schemas.JOBS_CSV)


# Tables ------------------------------------------------------------------------------


@report
def table_evolution(spark, sf):
    """Rows of a table before and after it got the columns of the second version; adding them again changes nothing."""
    lake, name = _new_lake(spark), "bronze.versions"
    raw = _raw(spark, sf)
    first = T.StructType([f for f in schemas.TELEMETRY.fields if f.name not in schemas.V2_ONLY])
    lake.create_table(name, first)
    is_v1 = text.lower_stripped(F.col("schema_version")) == "v1"
    conform(raw.filter(is_v1), first).write.insertInto(lake.name(name))
    lake.add_missing_columns(name, schemas.TELEMETRY)
    lake.add_missing_columns(name, schemas.TELEMETRY)
    columns = lake.read(name).columns
    conform(raw.filter(~is_v1), schemas.TELEMETRY).select(columns).write.insertInto(lake.name(name))
    return lake.read(name).select(schemas.TELEMETRY.fieldNames())


@report
def table_listing(spark, sf):
    """The tables of a namespace with their rows, after one was dropped."""
    lake = _new_lake(spark)
    lake.append_events("bronze.telemetry", _raw(spark, sf))
    dropped = lake.drop_table("bronze.rejected")
    listed = None
    for name in lake.list_tables("bronze"):
        counted = lake.read(f"bronze.{name}").agg(F.count(F.lit(1)).alias("row_count"))
        row = counted.select(F.lit(name).alias("table_name"), "row_count", F.lit(dropped).alias("other_dropped"))
        listed = row if listed is None else listed.unionByName(row)
    return listed


# Streaming and pipeline --------------------------------------------------------------


@report
def stream_bronze(spark, sf):
    lake, topic = _new_lake(spark), scratch_dir(spark, "topic")
    messages.write_messages(_messages(_raw(spark, sf)), topic)
    ingest.ingest_bronze(lake, {"files": topic}, scratch_dir(spark, "progress")).awaitTermination()
    return lake.read("bronze.telemetry").drop("ingested_at", "event_date", "batch")


@report
def stream_silver(spark, sf):
    """Two runs; the second one delivers all messages of the first again."""
    lake, topic, progress = _new_lake(spark), scratch_dir(spark, "topic"), scratch_dir(spark, "progress")
    raw = _raw(spark, sf)
    split = F.lit(SPLIT).cast("timestamp_ntz")
    sent = F.col("timestamp").cast("timestamp_ntz")
    for part in (raw.filter(F.col("event_timestamp") < split), raw):
        messages.write_messages(_messages(part), topic)
        ingest.stream_silver(lake, {"files": topic}, progress, sent).awaitTermination()
    return lake.read("silver.telemetry").drop("event_date")


@report
def stream_incidents(spark, sf):
    """Messages arrive in two steps, and the stream detects in each what silver lacked."""
    lake, topic, progress = _new_lake(spark), scratch_dir(spark, "topic"), scratch_dir(spark, "progress")
    raw = _raw(spark, sf)
    before = F.col("event_timestamp") < F.lit(SPLIT).cast("timestamp_ntz")
    sent = F.col("timestamp").cast("timestamp_ntz")
    for part in (raw.filter(before), raw.filter(~before)):
        messages.write_messages(_messages(part), topic)
        ingest.stream_incidents(lake, {"files": topic}, progress, AS_OF, sent).awaitTermination()
    return lake.read("ops.incidents").drop("event_date", "resolved_at")


@report
def run_metrics(spark, sf):
    lake = _new_lake(spark)
    lake.append_events("bronze.telemetry", _raw(spark, sf))
    pipeline.run_pipeline(lake, AS_OF, fail_on=("required_columns",))
    return lake.read("ops.pipeline_runs").select("pipeline_name", "run_status", "bronze_rows", "silver_rows", "gold_rows")


@report
def incidents_after_two_runs(spark, sf):
    """The summary view after two runs of the batch job, asked for in SQL; the second run adds nothing."""
    lake = _new_lake(spark)
    lake.append_events("bronze.telemetry", _raw(spark, sf))
    for _ in range(2):
        pipeline.run_pipeline(lake, AS_OF, fail_on=("required_columns",))
    pipeline.register_views(lake)
    return pipeline.query(lake, "SELECT device_id, raw_incident_count, critical_count FROM device_incident_summary")


@report
def runs_with_late_events(spark, sf):
    """Runs over fresh events, then over late ones and rows without a time, both behind the gate on freshness."""
    lake = _new_lake(spark)
    untimed = F.col("kafka_offset") % 101 == 0
    raw = _raw(spark, sf).withColumn("event_timestamp", F.when(~untimed, F.col("event_timestamp")))
    fresh = F.coalesce(F.col("event_timestamp") >= F.lit(SPLIT).cast("timestamp_ntz"), F.lit(False))
    for part in (raw.filter(fresh), raw.filter(~fresh)):
        lake.append_events("bronze.telemetry", part)
        pipeline.run_pipeline(lake, AS_OF, fail_on=("required_columns", "freshness"))
    kept_aside = lake.read("ops.quarantine").filter("event_timestamp IS NULL").agg(F.count(F.lit(1)).alias("n"))
    runs = lake.read("ops.pipeline_runs").select("run_status", "bronze_rows", "silver_rows", "gold_rows")
    return runs.withColumn("untimed_rows_kept", kept_aside.scalar())


@report
def incident_summary_kept_up(spark, sf):
    """The summary by type after two runs, a resolution and a replay of everything; it reads daily summaries only."""
    lake = _new_lake(spark)
    raw = _raw(spark, sf)
    later = F.col("event_timestamp") >= F.lit(SPLIT).cast("timestamp_ntz")
    for part in (raw.filter(later), raw.filter(~later)):
        lake.append_events("bronze.telemetry", part)
        pipeline.run_pipeline(lake, AS_OF, fail_on=("required_columns",))
    old = F.col("event_timestamp") < F.lit(RESOLVED_BEFORE).cast("timestamp_ntz")
    pipeline.resolve_incidents(lake, lake.read("ops.incidents").filter(old), AS_OF)
    lake.append_events("bronze.telemetry", raw)
    pipeline.run_pipeline(lake, AS_OF, fail_on=("required_columns",))
    pipeline.register_views(lake)
    return pipeline.query(
        lake,
        "SELECT device_id, incident_type, severity, severity_rank(severity) AS severity_rank, occurrence_count, "
        "incident_start, incident_end FROM incident_type_summary",
    )


@report
def stream_metrics(spark, sf):
    """What each micro-batch of a stream took in and what became of it, after all messages came a second time."""
    lake, topic, progress = _new_lake(spark), scratch_dir(spark, "topic"), scratch_dir(spark, "progress")
    sent = F.col("timestamp").cast("timestamp_ntz")
    for _ in range(2):
        messages.write_messages(_messages(_raw(spark, sf)), topic)
        ingest.stream_silver(lake, {"files": topic}, progress, sent).awaitTermination()
    return lake.read("ops.stream_batches").select("stream", "batch_number", "messages", "rejected", "accepted", "surplus")


@report
def uptime_from_carry(spark, sf):
    """Uptime of the later dates after two runs, the earlier dates last; their events are counted by day only."""
    lake = _two_runs(spark, sf)
    total = pipeline.uptime_on(lake, _later_dates(lake), 100.0)
    return total.select("device_id", "event_timestamp", "uptime_hours")


@report
def gaps_from_carry(spark, sf):
    """Gaps that end on the later dates, after the same runs."""
    lake = _two_runs(spark, sf)
    return pipeline.gaps_on(lake, _later_dates(lake), SLOT_MINUTES)


def _two_runs(spark: SparkSession, sf: str) -> Lake:
    lake, raw = _new_lake(spark), _raw(spark, sf)
    later = F.col("event_timestamp") >= F.lit(SPLIT).cast("timestamp_ntz")
    for part in (raw.filter(later), raw.filter(~later)):
        lake.append_events("bronze.telemetry", part)
        pipeline.refresh_silver(lake)
        pipeline.refresh_gold(lake)
    return lake


def _later_dates(lake: Lake) -> DataFrame:
    return lake.dates_of("silver.telemetry").filter(F.col("event_date") >= F.lit(SPLIT.date()))


@report
def late_bound_column(spark, sf):
    """A field that no schema knew when its events came, as a column that silver got afterwards."""
    lake = _new_lake(spark)
    site = F.concat(F.lit("S"), F.col("kafka_offset") % 5)
    raw = _raw(spark, sf).withColumn("site", F.when(F.col("kafka_offset") % 3 != 0, site))
    decoded = messages.decode_telemetry(_messages(raw, "site"), F.col("timestamp").cast("timestamp_ntz"))
    lake.append_events("bronze.telemetry", messages.accepted(decoded))
    lake.append_messages("ops.payloads", messages.payloads(decoded))
    pipeline.refresh_silver(lake)
    pipeline.fill_column(lake, "site", T.StringType())
    return lake.read("silver.telemetry").select("device_id", "event_timestamp", "kafka_offset", "site")
