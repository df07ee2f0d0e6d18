"""Tables, merges, the pipeline, messages and streams."""

from __future__ import annotations

import json
import os
import random
import re
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from frames import DEGRADED, NOON, at, telemetry
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.operators import health, series
from fleetlake.operators.quality import REPLAY_TOLERANT, QualityError
from fleetlake.plans import pipeline
from fleetlake.sources import files, messages, tables
from fleetlake.sources.tables import Lake, conform, merge_upsert
from fleetlake.streaming import ingest

LATER = at(60)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_tables_are_created_once_and_listed(lake):
    lake.create_all()
    ops = ["batches", "batches_done", "device_health_current", "devices", "incidents", "payloads", "pipeline_runs", "quarantine"]
    ops += ["stream_batches"]
    assert lake.list_tables("ops") == ops
    assert lake.list_tables("bronze") == ["jobs", "rejected", "telemetry"]
    assert lake.read("silver.telemetry").columns == [*schemas.TELEMETRY.fieldNames(), "event_date"]


def test_columns_are_added_once(lake):
    old = schemas.INCIDENTS.fields[1:5]
    lake.spark.sql(f"DROP TABLE {lake.name('ops.incidents')}")
    narrow = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in old)
    lake.spark.sql(f"CREATE TABLE {lake.name('ops.incidents')} ({narrow}) USING parquet")
    lake.spark.sql(f"INSERT INTO {lake.name('ops.incidents')} VALUES ('DEV001', 'LOW_SNR', 'HIGH', 'x')")
    added = lake.add_missing_columns("ops.incidents", schemas.INCIDENTS)
    assert added == ["event_key", "event_timestamp", "detected_at", "resolved_at", "status"]
    assert lake.add_missing_columns("ops.incidents", schemas.INCIDENTS) == []
    assert rows(lake.read("ops.incidents"), "device_id", "event_key") == [("DEV001", None)]


def test_dropping_a_table(lake):
    assert lake.drop_table("silver.telemetry")
    assert not lake.drop_table("silver.telemetry")


def test_conform(spark):
    df = spark.createDataFrame([("DEV001", "7.5", "x", float("nan"))], "device_id string, temperature_mk string, queue_depth string, cpu_usage_pct double")
    out = conform(df, schemas.TELEMETRY)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in schemas.TELEMETRY.fields]
    r = out.first()
    assert (r.device_id, r.temperature_mk, r.queue_depth, r.cpu_usage_pct, r.kafka_offset) == ("DEV001", 7.5, None, None, None)
    with pytest.raises(Exception, match="event_timestamp must not be NULL"):
        conform(df, schemas.TELEMETRY, enforce=True).collect()


def test_upsert_keeps_what_the_source_does_not_touch(spark):
    schema = "device_id string, name string, note string, created_at int, updated_at int"
    target = spark.createDataFrame([("A", "a", "x", 1, 1), ("B", "b", "y", 1, 1)], schema)
    source = spark.createDataFrame([("B", "b2", 9), ("C", "c2", 9)], "device_id string, name string, created_at int")
    merged = merge_upsert(target, source, "device_id", ["name"], {"updated_at": F.lit(5)})
    assert rows(merged.na.fill("-"), *target.columns) == [("A", "a", "x", 1, 1), ("B", "b2", "y", 1, 5), ("C", "c2", "-", 9, 5)]
    again = merge_upsert(merged, source, "device_id", ["name"], {"updated_at": F.lit(5)})
    assert rows(again.na.fill("-"), *target.columns) == rows(merged.na.fill("-"), *target.columns)


def test_upsert_writes_null_over_a_value(spark):
    target = spark.createDataFrame([("A", 1.0)], "device_id string, v double")
    source = spark.createDataFrame([("A", None)], "device_id string, v double")
    assert merge_upsert(target, source, "device_id", ["v"]).first().v is None


def test_registry_sync_keeps_creation_time(lake):
    first = lake.spark.createDataFrame([("DEV001", "Alpha", "Lab", 127, "ACTIVE")], schemas.T.StructType(schemas.DEVICES.fields[:5]))
    pipeline.sync_devices(lake, first)
    created = lake.read("ops.devices").first().created_at
    pipeline.sync_devices(lake, first.withColumn("location", F.lit("Hall")))
    r = lake.read("ops.devices").first()
    assert (r.location, r.created_at) == ("Hall", created) and created is not None


def test_pipeline_twice_changes_nothing(lake):
    events = [{}, {"event_timestamp": at(15)}, {**DEGRADED, "cryogenic_pressure_mbar": 1.0, "event_timestamp": at(30 + 24 * 60)}]
    lake.append_events("bronze.telemetry", telemetry(lake.spark, *events))
    now = NOON + timedelta(days=1, hours=2)
    first = pipeline.run_pipeline(lake, now)
    assert (first["bronze_rows"], first["silver_rows"], first["gold_rows"]) == (3, 3, 2)
    state = {
        t: lake.read(t).collect() for t in ("silver.telemetry", "gold.device_health", "ops.incidents", "ops.device_health_current")
    }
    second = pipeline.run_pipeline(lake, now)
    assert second["silver_rows"] == 0
    for t, before in state.items():
        assert sorted(map(str, lake.read(t).collect())) == sorted(map(str, before)), t
    assert lake.read("ops.incidents").count() == 5
    assert rows(lake.read("ops.pipeline_runs"), "run_status", "silver_rows") == [("SUCCESS", 0), ("SUCCESS", 3)]


def test_gate_stops_the_pipeline(lake):
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}, {}))
    with pytest.raises(QualityError, match="duplicate"):
        pipeline.run_pipeline(lake, at(60))
    assert lake.read("silver.telemetry").count() == 0
    assert lake.read("ops.pipeline_runs").first().run_status == "FAILED"
    assert pipeline.run_pipeline(lake, at(60), fail_on=REPLAY_TOLERANT)["silver_rows"] == 1


def test_pipeline_over_some_dates(lake):
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}, {"event_timestamp": at(24 * 60)}))
    day = at(24 * 60).date()
    assert pipeline.run_pipeline(lake, at(24 * 60), dates=(day, day))["silver_rows"] == 1
    assert pipeline.run_pipeline(lake, at(24 * 60), full=True)["silver_rows"] == 1


def test_gold_from_daily_sums_equals_gold_from_events(lake):
    events = [
        {"event_timestamp": at(h * 60), "device_id": f"DEV{h % 3:03d}", "temperature_mk": 10 + h / 7, "queue_depth": None if h % 5 else h,
         "hardware_error_rate": None, "system_status": ("HEALTHY", "DEGRADED", "CRITICAL")[h % 4 % 3]}
        for h in range(100)
    ]
    df = telemetry(lake.spark, *events)
    lake.append_events("silver.telemetry", df)
    assert pipeline.refresh_gold(lake) == 3
    columns = schemas.DEVICE_HEALTH.fieldNames()
    key = lambda r: str(r)
    assert sorted(lake.read("gold.device_health").collect(), key=key) == sorted(
        health.device_health(df).select(columns).collect(), key=key
    )
    day = at(30 * 60).date()
    before = {r.device_id: r for r in lake.read("gold.device_health").collect()}
    lake.append_events("silver.telemetry", telemetry(lake.spark, {"event_timestamp": at(30 * 60 + 1), "system_status": "CRITICAL"}))
    for _ in range(2):
        pipeline.refresh_gold(lake, (day, day))
        after = {r.device_id: r for r in lake.read("gold.device_health").collect()}
        assert after["DEV000"] == before["DEV000"]
        assert after["DEV001"].critical_events == before["DEV001"].critical_events + 1
    assert sorted(map(str, after.values())) == sorted(
        map(str, health.device_health(lake.read("silver.telemetry")).select(columns).collect())
    )


def test_carried_state_equals_the_whole_over_random_runs(lake):
    """Uptime and gaps of the dates of each run, late ones included, with earlier dates told by gold's daily rows only."""
    rng = random.Random(8)
    events = [{"event_timestamp": at(15 * rng.randrange(96 * 9)), "device_id": f"DEV{rng.randrange(3)}"} for _ in range(120)]
    dates = sorted({e["event_timestamp"].date() for e in events})
    rng.shuffle(dates)
    for some in (dates[:4], dates[4:5], dates[5:]):
        lake.append_events("bronze.telemetry", telemetry(lake.spark, *[e for e in events if e["event_timestamp"].date() in some]))
        pipeline.refresh_silver(lake)
        asked = lake.spark.createDataFrame([(d,) for d in some], "event_date date")
        pipeline.refresh_gold(lake, asked)
        silver = lake.read("silver.telemetry").drop("event_date")
        for found, whole, at_ in (
            (pipeline.uptime_on(lake, asked, 2.0), series.uptime_hours(silver, 2.0), "event_timestamp"),
            (pipeline.gaps_on(lake, asked), series.missing_slots(silver), "gap_end"),
        ):
            expected = whole.filter(F.to_date(at_).isin(some))
            if at_ == "gap_end":  # those behind a device's last slot, and before its first, end with no reading or begin with none
                seen = silver.select("device_id", F.date_trunc("minute", "event_timestamp").cast("timestamp_ntz").alias("t"))
                first = seen.groupBy("device_id").agg(F.min("t").alias("t"))
                ended = expected.join(seen, (expected.device_id == seen.device_id) & (expected.gap_end == seen.t), "left_semi")
                begun = (ended.device_id == first.device_id) & (ended.gap_end == first.t)
                expected = ended.join(first, begun, "left_anti")
            assert rows(found, *found.columns) == rows(expected, *found.columns)
            assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_writing_no_rows(lake):
    none = telemetry(lake.spark, {}).limit(0)
    assert lake.append_events("silver.telemetry", none) == 0
    assert lake.append_events("silver.telemetry", none.filter("1 = 0")) == 0
    assert lake.replace("gold.device_health", health.device_health(none)) == 0
    assert lake.read("gold.device_health").count() == 0


def test_nothing_to_do(lake):
    assert pipeline.refresh_silver(lake) == 0
    assert pipeline.refresh_gold(lake) == 0
    assert pipeline.record_incidents(lake) == 0


def test_current_health_keeps_silent_devices(lake):
    lake.append_events("silver.telemetry", telemetry(lake.spark, {}, {"device_id": "DEV002"}))
    pipeline.refresh_gold(lake)
    pipeline.sync_current_health(lake, NOON)
    lake.replace("gold.device_health", lake.read("gold.device_health").filter("device_id = 'DEV001'"))
    pipeline.sync_current_health(lake, LATER)
    assert rows(lake.read("ops.device_health_current"), "device_id", "updated_at") == [("DEV001", LATER), ("DEV002", NOON)]


def test_incident_counts(lake):
    lake.append_events("silver.telemetry", telemetry(lake.spark, DEGRADED))
    assert pipeline.record_incidents(lake, NOON) == 5
    assert pipeline.record_incidents(lake, LATER) == 0
    table = lake.read("ops.incidents")
    assert {r.detected_at for r in table.collect()} == {NOON} and {r.status for r in table.collect()} == {"OPEN"}


def test_sql_over_tables_and_views(lake):
    lake.append_events("silver.telemetry", telemetry(lake.spark, DEGRADED))
    pipeline.record_incidents(lake, NOON)
    pipeline.register_views(lake)
    joined = pipeline.query(
        lake,
        f"SELECT s.device_id, i.raw_incident_count FROM {lake.name('silver.telemetry')} s "
        "JOIN device_incident_summary i ON s.device_id = i.device_id",
    )
    assert rows(joined, "device_id", "raw_incident_count") == [("DEV002", 5)]
    with pytest.raises(ValueError):
        pipeline.query(lake, f"DROP TABLE {lake.name('silver.telemetry')}")


# Files and messages ------------------------------------------------------------------


def test_csv_keeps_values_and_nulls(spark, tmp_path):
    t = datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([("TEL1", "DEV001", t, 1.5, None, 2.0, 3, 4, 5.0, 6.25, "HEALTHY", "v1")], schemas.TELEMETRY_CSV)
    path = str(tmp_path / "csv")
    files.write_csv(df, path)
    assert files.read_csv(spark, path, schemas.TELEMETRY_CSV).collect() == df.collect()
    files.write_csv(df.limit(0), path)
    assert files.read_csv(spark, path, schemas.TELEMETRY_CSV).count() == 0


def test_csv_from_another_writer(spark, tmp_path):
    path = tmp_path / "devices.csv"
    path.write_text(
        "device_id,device_name,qubit_count,processor_generation,location,operational_status,commission_date\n"
        "DEV001,alpha,50,Gen1,Phoenix,ACTIVE,2023-01-15\n"
    )
    r = files.read_csv(spark, str(path), schemas.DEVICES_CSV).first()
    assert (r.qubit_count, str(r.commission_date)) == (50, "2023-01-15")


def message_rows(spark, *values):
    data = [("DEV001", v if isinstance(v, str) else json.dumps(v), 0, i, NOON) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "key string, value string, partition int, offset long, timestamp timestamp")


EVENT = {"device_id": "DEV001", "event_timestamp": "2026-08-22T17:47:33.5+02:00", "temperature_mk": 15.0, "queue_depth": 3}


def test_decoding(spark):
    df = messages.decode_telemetry(
        message_rows(
            spark,
            {**EVENT, "gate_fidelity": 0.9},
            {**EVENT, "schema_version": "v2", "cryogenic_pressure_mbar": 1.1},
            "{bad",
            {**EVENT, "queue_depth": 3.5},
            {k: v for k, v in EVENT.items() if k != "device_id"},
            {k: v for k, v in EVENT.items() if k != "event_timestamp"},
            {**EVENT, "event_timestamp": "yesterday"},
            '{"device_id": "DEV001", "event_timestamp": "2026-08-22T10:00:00Z", "temperature_mk": NaN}',
        )
    )
    reasons = {r.kafka_offset: r.reject_reason for r in df.collect()}
    assert reasons == {
        0: None,
        1: None,
        2: "malformed_json",
        3: None,
        4: "missing_device_id",
        5: "missing_event_timestamp",
        6: "bad_event_timestamp",
        7: None,
    }
    good = {r.kafka_offset: r for r in messages.accepted(df).collect()}
    assert good[0].event_timestamp == datetime(2026, 8, 22, 15, 47, 33, 500000)
    assert (good[0].schema_version, good[0].hardware_error_rate, good[7].temperature_mk) == ("v1", None, None)
    assert good[3].queue_depth is None and good[0].queue_depth == 3
    assert messages.rejected(df).count() == 4
    assert messages.accepted(df).columns == schemas.TELEMETRY.fieldNames()


def test_reader_shows_new_fields_in_new_versions_only(spark):
    df = message_rows(spark, {**EVENT, "hardware_error_rate": 0.1}, {**EVENT, "hardware_error_rate": 0.1, "schema_version": "v2"})
    assert [r.hardware_error_rate for r in messages.telemetry_view(df).orderBy("kafka_offset").collect()] == [None, 0.1]


def test_messages_keep_microseconds(spark):
    t = datetime(2026, 8, 22, 12, 0, 0, 123456)
    sent = messages.to_messages(telemetry(spark, {"event_timestamp": t}), schemas.PAYLOAD.fieldNames())
    value = json.loads(sent.first().value)
    assert (sent.first().key, value["event_timestamp"]) == ("DEV001", "2026-08-22T12:00:00.123456+00:00")
    topic = sent.withColumns({"partition": F.lit(0), "offset": F.lit(1), "timestamp": F.current_timestamp()})
    assert messages.decode_telemetry(topic).first().event_timestamp == t


def send(spark, folder, *events, start=0):
    raw = telemetry(spark, *[{"kafka_offset": start + i, **e} for i, e in enumerate(events)])
    topic = messages.to_messages(raw, schemas.PAYLOAD.fieldNames()).select(
        "key",
        "value",
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.lit(NOON).cast("timestamp").alias("timestamp"),
    )
    messages.write_messages(topic.coalesce(1), folder)


def test_bronze_stream_appears_once(lake, tmp_path):
    folder, progress = str(tmp_path / "topic"), str(tmp_path / "progress")

    def drain():
        ingest.ingest_bronze(lake, {"files": folder, "max_files": 1}, progress).awaitTermination()
        return lake.read("bronze.telemetry").count()

    send(lake.spark, folder, {}, {"event_timestamp": at(1)}, {"device_id": None})
    assert drain() == 2
    assert rows(lake.read("bronze.rejected"), "reject_reason") == [("missing_device_id",)]
    assert drain() == 2
    send(lake.spark, folder, {"event_timestamp": at(24 * 60)}, start=9)
    assert drain() == 3
    assert lake.read("bronze.telemetry").filter(F.col("event_date") == at(24 * 60).date()).count() == 1


def test_files_of_messages_are_compressed_and_bounded(lake, tmp_path, monkeypatch):
    """They held a task's messages as plain text, in one file however many there were."""
    monkeypatch.setattr(messages, "FILE_ROWS", 40)
    topic = tmp_path / "topic"
    send(lake.spark, str(topic), *[{"event_timestamp": at(i)} for i in range(100)])
    files_ = [p for p in topic.iterdir() if p.name.startswith("part-")]
    assert len(files_) == 3 and all(p.read_bytes()[:2] == b"\x1f\x8b" for p in files_)
    ingest.ingest_bronze(lake, {"files": str(topic)}, str(tmp_path / "progress")).awaitTermination()
    assert rows(lake.read("bronze.telemetry"), "kafka_offset", "event_timestamp") == [(i, at(i)) for i in range(100)]


def test_a_column_added_later_is_filled_from_earlier_events(lake, tmp_path):
    """Events with a field that no schema knows, then the column: it has their values, and later events get theirs."""
    folder, progress = str(tmp_path / "topic"), str(tmp_path / "progress")

    def deliver(*values, start=0):
        sent = [("DEV001", json.dumps(v), 0, start + i, NOON) for i, v in enumerate(values)]
        schema = "key string, value string, partition int, offset long, timestamp timestamp"
        messages.write_messages(lake.spark.createDataFrame(sent, schema).coalesce(1), folder)
        ingest.ingest_bronze(lake, {"files": folder}, progress, whole=True).awaitTermination()
        pipeline.refresh_silver(lake)

    def event(minute, **fields):
        return {**EVENT, "event_timestamp": at(minute).isoformat(), "system_status": "HEALTHY", **fields}

    deliver(event(0, gate_fidelity=0.5), event(1, gate_fidelity="soon"), event(2), event(1440, gate_fidelity=7), {**event(0, gate_fidelity=0.75), "device_id": " dev001"})
    assert lake.read("ops.payloads").count() == 5
    fill = lambda **given: pipeline.fill_column(lake, "gate_fidelity", schemas.T.DoubleType(), **given)
    fill()
    found = lambda: rows(lake.read("silver.telemetry").na.fill(-1.0), "event_timestamp", "gate_fidelity")
    assert found() == [(at(0), 0.75), (at(1), -1.0), (at(2), -1.0), (at(1440), 7.0)]
    deliver(event(3, gate_fidelity=0.25), event(1441, gate_fidelity=0.5), start=10)
    assert (at(3), -1.0) in found()
    fill(dates=(NOON.date(), NOON.date()))
    assert found() == [(at(0), 0.75), (at(1), -1.0), (at(2), -1.0), (at(3), 0.25), (at(1440), 7.0), (at(1441), -1.0)]
    fill()
    assert (at(1441), 0.5) in found() and lake.read("silver.telemetry").columns[-2:] == ["gate_fidelity", "event_date"]
    assert pipeline.refresh_gold(lake) == 1


def test_silver_stream_in_chunks_equals_one_batch(lake, tmp_path):
    folder, progress = str(tmp_path / "topic"), str(tmp_path / "progress")
    chunks = [[{}, {"event_timestamp": at(1)}, {}], [{"event_timestamp": at(2)}, {}], [{"event_timestamp": at(1), "temperature_mk": 30.0}]]
    for i, chunk in enumerate(chunks):
        send(lake.spark, folder, *chunk, start=10 * i)
        ingest.stream_silver(lake, {"files": folder}, progress).awaitTermination()
    got = rows(lake.read("silver.telemetry"), "event_timestamp", "kafka_offset", "temperature_mk")
    assert got == [(NOON, 2, 15.0), (at(1), 1, 15.0), (at(2), 10, 15.0)]


def test_rejected_event_can_be_accepted_later(lake, tmp_path):
    folder, progress = str(tmp_path / "topic"), str(tmp_path / "progress")
    for status in ("UNKNOWN", "HEALTHY"):
        send(lake.spark, folder, {"system_status": status})
        ingest.stream_silver(lake, {"files": folder}, progress).awaitTermination()
    assert rows(lake.read("silver.telemetry"), "system_status") == [("HEALTHY",)]


def test_incidents_come_from_the_batch(lake, tmp_path):
    folder, progress = str(tmp_path / "topic"), str(tmp_path / "progress")
    for minute in (0, 1):
        send(lake.spark, folder, {**DEGRADED, "event_timestamp": at(minute)}, {**DEGRADED, "event_timestamp": at(0)})
        ingest.stream_incidents(lake, {"files": folder}, progress, at(minute)).awaitTermination()
    table = lake.read("ops.incidents")
    assert table.count() == 10 and lake.read("silver.telemetry").count() == 2
    assert table.filter(F.col("detected_at") == F.lit(NOON).cast("timestamp_ntz")).count() == 5
    ingest.add_incidents(lake, telemetry(lake.spark, DEGRADED), LATER)
    assert lake.read("ops.incidents").count() == 10


def test_no_message_is_lost(lake, tmp_path):
    """Accepted and rejected are all that were sent, in every stream."""
    events, progress = str(tmp_path / "events"), str(tmp_path / "progress")
    bad = ["{bad", None, "[1]", '{"device_id": "DEV001"}', json.dumps({**EVENT, "event_timestamp": "soon"})]
    good = [json.dumps(EVENT), json.dumps({**EVENT, "event_timestamp": "20260822T100000.1234567Z", "queue_depth": 45.0, "active_jobs": 1.5})]
    rows_ = [("DEV001", v, 0, i, NOON) for i, v in enumerate(bad + good)]
    sent = lake.spark.createDataFrame(rows_, "key string, value string, partition int, offset long, timestamp timestamp")
    messages.write_messages(sent, events)
    ingest.ingest_bronze(lake, {"files": events}, f"{progress}-bronze").awaitTermination()
    assert lake.read("bronze.telemetry").count() == 2 and lake.read("bronze.rejected").count() == 5
    kept = lake.read("bronze.telemetry").filter("kafka_offset = 6").first()
    assert (kept.event_timestamp, kept.queue_depth, kept.active_jobs) == (datetime(2026, 8, 22, 10, 0, 0, 123456), 45, None)
    ingest.stream_silver(lake, {"files": events}, f"{progress}-silver").awaitTermination()
    assert lake.read("bronze.rejected").count() == 10
    jobs = str(tmp_path / "jobs")
    values = ["{bad", None, "{}", '{"job_id": "J1", "shots": 10.0}', '{"job_id": "J2", "shots": 10.5}']
    sent = lake.spark.createDataFrame([("DEV001", v, 0, i, NOON) for i, v in enumerate(values)], sent.schema)
    messages.write_messages(sent, jobs)
    ingest.ingest_jobs(lake, {"files": jobs}, f"{progress}-jobs").awaitTermination()
    assert rows(lake.read("bronze.jobs"), "job_id", "shots") == [("J1", 10), ("J2", None)]
    assert rows(lake.read("bronze.rejected").filter("reject_reason = 'missing_job_id'"), "value") == [("{}",)]
    assert lake.read("bronze.rejected").count() == 13


def test_every_message_of_a_micro_batch_is_accounted_for(lake, tmp_path, monkeypatch):
    """Accepted, rejected and surplus are all messages, also when a batch fails and runs again, or comes again."""
    folder, progress = str(tmp_path / "topic"), str(tmp_path / "progress")
    events = [{}, {}, {"event_timestamp": at(1)}, {"device_id": None}, {"event_timestamp": at(2), "system_status": "?"}]
    start = lambda: ingest.stream_incidents(lake, {"files": folder}, progress, NOON).awaitTermination()
    send(lake.spark, folder, *events)
    with monkeypatch.context() as failing:
        calls = iter([lambda: NOON, lambda: 1 / 0])  # the second one is made when the batch is noted
        failing.setattr(ingest, "utc_now", lambda: next(calls)())
        with pytest.raises(Exception, match="division by zero"):
            start()
    assert lake.read("ops.stream_batches").isEmpty() and lake.read("silver.telemetry").count() == 2
    start()
    send(lake.spark, folder, *events, {"event_timestamp": at(3)}, start=10)
    start()
    noted = ("stream", "batch_number", "messages", "rejected", "accepted", "surplus")
    # the second attempt finds the first one's two events in silver
    assert rows(lake.read("ops.stream_batches"), *noted) == [("incidents", 0, 5, 1, 0, 4), ("incidents", 1, 6, 1, 1, 4)]
    assert lake.read("bronze.rejected").count() == 2


def test_a_repeated_batch_takes_its_own_place(lake):
    for _ in range(2):
        assert lake.append_events("bronze.telemetry", telemetry(lake.spark, {}, {"event_timestamp": at(24 * 60)}), "b-1") == 2
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}), "b-2")
    assert lake.read("bronze.telemetry").count() == 3


def test_mandatory_columns_are_enforced(lake):
    with pytest.raises(Exception, match="device_id must not be NULL"):
        lake.append_events("silver.telemetry", telemetry(lake.spark, {"device_id": None}))


def test_quarantine_is_filled_and_renewed(lake):
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}, {"event_timestamp": at(1), "temperature_mk": 99.0}))
    for _ in range(2):
        pipeline.run_pipeline(lake, at(60), REPLAY_TOLERANT)
    assert rows(lake.read("ops.quarantine"), "violations") == [(["range:temperature_mk"],)]


def test_a_run_takes_the_dates_of_new_files(lake):
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}))
    assert pipeline.run_pipeline(lake, at(60))["bronze_rows"] == 1
    assert pipeline.run_pipeline(lake, at(60))["bronze_rows"] == 0
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {"event_timestamp": at(24 * 60)}))
    run = pipeline.run_pipeline(lake, at(25 * 60))
    assert (run["bronze_rows"], run["silver_rows"]) == (1, 1)
    assert pipeline.run_pipeline(lake, at(25 * 60), full=True)["bronze_rows"] == 2


def age_bronze(lake):
    """Make bronze files look a day old, as those of an append that took that long to be committed."""
    long_ago = time.time() - 24 * 3600
    for file in Path(lake.root, "bronze", "telemetry").rglob("part-*"):
        os.utime(file, (long_ago, long_ago))


def test_a_run_takes_files_that_were_committed_late(lake):
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}))
    assert pipeline.run_pipeline(lake, at(60))["bronze_rows"] == 1
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {"event_timestamp": at(24 * 60)}), "b-1")
    age_bronze(lake)
    run = pipeline.run_pipeline(lake, at(25 * 60))
    assert (run["bronze_rows"], run["silver_rows"]) == (1, 1)
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {"event_timestamp": at(24 * 60 + 1)}), "b-1")
    age_bronze(lake)
    run = pipeline.run_pipeline(lake, at(25 * 60))
    assert (run["bronze_rows"], run["silver_rows"]) == (1, 1)
    assert pipeline.run_pipeline(lake, at(25 * 60))["bronze_rows"] == 0


def test_late_events_pass_the_default_gate(lake):
    """How fresh the data are is a matter of all of bronze, not of the dates that a run touches."""
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}))
    pipeline.run_pipeline(lake, at(60))
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {"event_timestamp": at(-5 * 24 * 60)}))
    run = pipeline.run_pipeline(lake, at(60))
    assert (run["run_status"], run["bronze_rows"], run["silver_rows"]) == ("SUCCESS", 1, 1)
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {"event_timestamp": at(-4 * 24 * 60)}))
    with pytest.raises(QualityError, match="stale.*2026-08-22 12:00"):
        pipeline.run_pipeline(lake, at(25 * 60))


def test_rows_without_a_time_are_counted_kept_aside_and_refused_in_every_run(lake):
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}))
    pipeline.run_pipeline(lake, at(60))
    untimed = [{"event_timestamp": None, "device_id": f"DEV{i}"} for i in range(2)]
    lake.append_events("bronze.telemetry", telemetry(lake.spark, *untimed, {"event_timestamp": at(1)}))
    day = NOON.date()
    for given in ({}, {}, {"dates": (day, day)}, {"full": True}):
        with pytest.raises(QualityError, match="event_timestamp contains 2 NULL values"):
            pipeline.run_pipeline(lake, at(60), **given)
    lenient = ("required_columns", "ranges")
    for given, expected in (({"dates": (day, day)}, (4, 1)), ({"full": True}, (4, 0)), ({}, (0, 0))):
        run = pipeline.run_pipeline(lake, at(60), lenient, **given)
        assert (run["bronze_rows"], run["silver_rows"]) == expected
        bad = lake.read("ops.quarantine")
        assert rows(bad, "device_id", "violations") == [(f"DEV{i}", ["not_null:event_timestamp"]) for i in range(2)]


def test_a_mended_date_leaves_quarantine(lake):
    bad = [{"event_timestamp": at(1), "temperature_mk": 99.0}, {"event_timestamp": None}, {"event_timestamp": at(24 * 60), "temperature_mk": 99.0}]
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}, *bad), "b-1")
    pipeline.run_pipeline(lake, at(60), ("required_columns",))
    assert lake.read("ops.quarantine").count() == 3
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}, bad[2]), "b-1")
    pipeline.run_pipeline(lake, at(60), ("required_columns",), full=True)
    assert rows(lake.read("ops.quarantine"), "event_timestamp") == [(at(24 * 60),)]
    assert not list(Path(lake.root, "ops", "quarantine").glob("event_date=2026-08-22"))


def test_a_batch_written_again_loses_the_dates_it_no_longer_has(lake):
    days = [{"event_timestamp": at(24 * 60 * d)} for d in range(3)]
    lake.append_events("bronze.telemetry", telemetry(lake.spark, *days, {"event_timestamp": None}), "b-1")
    lake.append_events("bronze.telemetry", telemetry(lake.spark, days[1]), "b-2")
    lake.append_events("bronze.telemetry", telemetry(lake.spark, days[2]), "b-1")
    assert rows(lake.read("bronze.telemetry"), "batch", "event_timestamp") == [
        ("b-1", days[2]["event_timestamp"]), ("b-2", days[1]["event_timestamp"])
    ]


def test_a_write_that_died_is_found(lake, monkeypatch):
    """Rows that were committed before their application could note it are taken by the next runs, until the batch is closed."""
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}))
    pipeline.run_pipeline(lake, at(60))
    with monkeypatch.context() as died:
        died.setattr(Lake, "_note_closed", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            lake.append_events("bronze.telemetry", telemetry(lake.spark, {"event_timestamp": at(24 * 60)}), "b-1")
    assert rows(lake.open_batches(), "batch") == [("b-1",)]
    for closed, expected in ((False, (1, 1)), (False, (1, 0)), (True, (1, 0)), (False, (0, 0))):
        if closed:
            lake.close_batch("b-1")
        run = pipeline.run_pipeline(lake, at(25 * 60))
        assert (run["bronze_rows"], run["silver_rows"]) == expected
    assert lake.open_batches().isEmpty()


def test_the_ledger_is_compared_in_tables(lake, monkeypatch):
    """100,000 lines of the ledger: what is pending comes from an anti-join; no file is listed, and no name reaches the driver."""
    n = 100_000
    lines = lake.spark.range(n).select(
        F.concat(F.lit("b-"), F.col("id")).alias("batch"),
        F.concat(F.lit("c-"), F.col("id")).alias("commit_id"),
        F.explode(F.array(F.lit("STARTED"), F.lit("COMMITTED"), F.lit("CLOSED"))).alias("state"),
        F.date_add(F.lit(NOON.date()), (F.col("id") % 1000).cast("int")).alias("batch_date"),
        F.lit(1).alias("row_count"),
        F.lit(NOON).alias("latest_event"),
    )
    lake._note(lines)
    lake._note(lines.filter("state = 'COMMITTED' AND commit_id NOT IN ('c-7', 'c-1007', 'c-99999')"), "ops.batches_done")
    monkeypatch.setattr("pyspark.sql.DataFrame.inputFiles", lambda *_: pytest.fail("files are listed"))
    pending = lake.pending_dates()
    assert re.search("Join.*LeftAnti", pending._jdf.queryExecution().executedPlan().toString())
    days = [NOON.date() + timedelta(days=d) for d in (7, 7, 999)]
    assert rows(pending, "commit_id", "event_date") == sorted(zip(("c-7", "c-1007", "c-99999"), days, strict=True))
    lake.compact_ledger(datetime.now().date() + timedelta(days=2))
    assert lake.read("ops.batches").count() == 3 * n
    assert lake.read("ops.batches").select(F.input_file_name()).distinct().count() == 1


def test_upsert_writes_only_the_buckets_it_touches(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), "ups_", buckets=32).create_all()
    schema = schemas.T.StructType(schemas.DEVICES.fields[:5])
    everyone = spark.createDataFrame([(f"DEV{i:03d}", "n", "Lab", 1, "ACTIVE") for i in range(600)], schema)
    pipeline.sync_devices(lake, everyone)
    files = lambda: {r.f for r in lake.read("ops.devices").select(F.input_file_name().alias("f")).distinct().collect()}
    before = files()
    assert len(before) == 32
    few = spark.createDataFrame([(f"DEV{i:03d}", "new", "Hall", 2, "ACTIVE") for i in range(598, 604)], schema)
    pipeline.sync_devices(lake, few)
    after = files()
    assert 32 - 6 <= len(before & after) < 32 and len(after) <= 32
    now = lake.read("ops.devices")
    assert now.count() == 604 and now.filter("location = 'Hall' AND qubit_count = 2").count() == 6
    assert now.filter("created_at IS NULL").isEmpty()


def test_small_files_of_a_date_are_put_together(lake):
    for minute in range(3):
        lake.append_events("silver.telemetry", telemetry(lake.spark, *[{"event_timestamp": at(minute + 10 * i)} for i in range(30)]))
    lake.append_events("silver.telemetry", telemetry(lake.spark, {"event_timestamp": at(24 * 60)}))
    day = lake.spark.createDataFrame([(NOON.date(),)], "event_date date")
    before = sorted(map(str, lake.read("silver.telemetry").collect()))
    lake.compact_dates("silver.telemetry", day)
    assert sorted(map(str, lake.read("silver.telemetry").collect())) == before
    files = lake.read("silver.telemetry").filter("event_date = '2026-08-22'").select(F.input_file_name()).distinct().count()
    assert files <= lake.buckets


def test_runs_of_given_dates_leave_the_others(lake):
    days = [{"event_timestamp": at(24 * 60 * d)} for d in range(3)]
    lake.append_events("bronze.telemetry", telemetry(lake.spark, days[0]))
    pipeline.run_pipeline(lake, at(60))
    lake.append_events("bronze.telemetry", telemetry(lake.spark, *days[1:]))
    day = days[1]["event_timestamp"].date()
    assert pipeline.run_pipeline(lake, at(25 * 60), dates=(day, day))["silver_rows"] == 1
    run = pipeline.run_pipeline(lake, at(72 * 60))
    assert (run["bronze_rows"], run["silver_rows"]) == (1, 1)


def test_replaced_folders_go(lake, monkeypatch):
    gold = health.device_health(telemetry(lake.spark, {}))
    monkeypatch.setattr(tables, "KEEP_REPLACED_HOURS", -1)
    for _ in range(3):
        lake.replace("gold.device_health", gold)
    left = [p.name for p in Path(lake.root, "gold").glob("device_health-*")]
    assert len(left) == 1 and lake.read("gold.device_health").count() == 1


def test_from_messages_to_summary(lake, tmp_path):
    """A stream fills bronze, the batch job does the rest, and a replay of all messages changes nothing."""
    folder, progress = str(tmp_path / "topic"), str(tmp_path / "progress")
    events = [{}, {"event_timestamp": at(15)}, {**DEGRADED, "event_timestamp": at(24 * 60)}, {"device_id": None}]
    now, days = at(25 * 60), (NOON.date(), at(24 * 60).date())
    state = None
    for _ in range(2):
        send(lake.spark, folder, *events)
        ingest.ingest_bronze(lake, {"files": folder}, progress).awaitTermination()
        run = pipeline.run_pipeline(lake, now, REPLAY_TOLERANT, dates=days)
        tables = ("silver.telemetry", "gold.device_health", "ops.incidents", "ops.device_health_current")
        found = {t: sorted(map(str, lake.read(t).collect())) for t in tables}
        assert state is None or found == state
        state = found
    assert (run["bronze_rows"], run["silver_rows"], run["gold_rows"]) == (6, 0, 2)
    pipeline.register_views(lake)
    view = pipeline.query(lake, "select device_id, incident_type_count from device_incident_summary")
    assert rows(view, "device_id", "incident_type_count") == [("DEV002", 5)]
