from __future__ import annotations

import random
from datetime import timedelta

import pytest
from frames import DEGRADED, NOON, at, telemetry
from pyspark.sql import functions as F

from fleetlake.operators import cleaning, duplicates, health, incidents, quality
from fleetlake.schemas import TELEMETRY


def keys(df):
    return sorted((r.device_id, r.event_timestamp, r.kafka_offset) for r in df.collect())


def test_texts_are_normalised_and_incomplete_rows_dropped(spark):
    df = telemetry(
        spark,
        {"device_id": "\t dev001 ", "system_status": " healthy\n", "schema_version": " V1 "},
        {"device_id": None},
        {"event_timestamp": None},
        {"schema_version": None},
        {"event_timestamp": at(1), "system_status": "UNKNOWN"},
        {"event_timestamp": at(2), "system_status": None},
    )
    row = cleaning.clean(df).collect()
    assert [(r.device_id, r.system_status, r.schema_version) for r in row] == [("DEV001", "HEALTHY", "v1")]


def test_invalid_last_copy_removes_the_event(spark):
    df = telemetry(spark, {}, {"system_status": "UNKNOWN"})
    assert cleaning.clean(df).count() == 0
    assert keys(cleaning.clean(telemetry(spark, {"system_status": "UNKNOWN"}, {}))) == [("DEV001", NOON, 1)]


def test_last_copy_wins_by_arrival(spark):
    df = telemetry(
        spark,
        {"ingested_at": at(5)},
        {"ingested_at": at(9), "device_id": " dev001"},
        {"ingested_at": at(9), "kafka_partition": 1},
        {"ingested_at": None},
    )
    assert keys(cleaning.clean(df)) == [("DEV001", NOON, 2)]


def test_nan_becomes_null(spark):
    row = cleaning.clean(telemetry(spark, {"temperature_mk": float("nan")})).first()
    assert row.temperature_mk is None


def test_deduplication_against_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        hot = rng.random() < 0.34
        device, minute = ("DEV001", 0) if hot else (f"DEV{rng.randrange(20):03d}", rng.randrange(30))
        status = rng.choice(["HEALTHY", "DEGRADED", "CRITICAL", "UNKNOWN", None])
        rows.append(
            {"device_id": device, "event_timestamp": at(minute), "ingested_at": at(rng.randrange(100)), "system_status": status, "kafka_offset": i}
        )
    last = {}
    for r in rows:
        k = (r["device_id"], r["event_timestamp"])
        if k not in last or (r["ingested_at"], r["kafka_offset"]) > (last[k]["ingested_at"], last[k]["kafka_offset"]):
            last[k] = r
    expected = sorted((*k, r["kafka_offset"]) for k, r in last.items() if r["system_status"] not in ("UNKNOWN", None))
    assert keys(cleaning.clean(telemetry(spark, *rows))) == expected


def test_unseen_events(spark):
    silver = telemetry(spark, {}, {"event_timestamp": at(1)})
    batch = telemetry(spark, {}, {"event_timestamp": at(2)}, {"device_id": "DEV009"})
    assert keys(cleaning.unseen(batch, silver)) == [("DEV001", at(2), 1), ("DEV009", NOON, 2)]
    assert cleaning.unseen(batch, silver.limit(0)).count() == 3
    assert cleaning.unseen(batch, batch).count() == 0


def test_funnel_adds_up(spark):
    df = telemetry(
        spark,
        {},
        {},
        {"device_id": None},
        {"event_timestamp": at(1), "system_status": "BROKEN"},
        {"event_timestamp": at(2)},
        {"device_id": None, "event_timestamp": None},
    )
    silver = telemetry(spark, {})
    f = cleaning.cleaning_funnel(df, silver).first()
    assert f.asDict() == {
        "received": 6,
        "missing_required": 2,
        "duplicates": 1,
        "invalid_status": 1,
        "available": 2,
        "already_processed": 1,
        "new_events": 1,
    }
    empty = cleaning.cleaning_funnel(df.limit(0), silver).first().asDict()
    assert set(empty.values()) == {0}


def test_health_skips_missing_readings(spark):
    df = telemetry(
        spark,
        {"temperature_mk": 10.0},
        {"temperature_mk": None, "event_timestamp": at(1), "system_status": "DEGRADED"},
        {"temperature_mk": 13.0, "event_timestamp": at(2), "system_status": "CRITICAL"},
    )
    row = health.device_health(cleaning.clean(df)).first()
    assert (row.total_events, row.avg_temperature_mk) == (3, 11.5)
    assert row.healthy_events + row.degraded_events + row.critical_events == row.total_events
    assert (row.health_score, row.latest_event_timestamp) == (0.0, at(2))


def test_ranking_breaks_ties_by_device(spark):
    df = telemetry(spark, *[{"device_id": f"DEV{n:03d}", "queue_depth": 10 + n // 3} for n in range(9)])
    assert [r.device_id for r in health.queue_ranking(df, "asc", 4).collect()] == ["DEV000", "DEV001", "DEV002", "DEV003"]
    assert [r.device_id for r in health.queue_ranking(df, top=2).collect()] == ["DEV006", "DEV007"]


# Incidents ---------------------------------------------------------------------------


def test_degraded_event_trips_five_rules(spark):
    found = incidents.detect(telemetry(spark, DEGRADED))
    assert sorted(r.incident_type for r in found.collect()) == [
        "DEVICE_DEGRADED",
        "HARDWARE_ERROR_SPIKE",
        "HIGH_TEMPERATURE",
        "LOW_SNR",
        "QUEUE_PRESSURE",
    ]
    texts = {r.incident_type: r.description for r in found.collect()}
    assert texts["HIGH_TEMPERATURE"] == "DEV002 temperature reached 21.50 mK, above threshold 18.00 mK."
    assert texts["HARDWARE_ERROR_SPIKE"] == "DEV002 hardware error rate reached 0.008100, above threshold 0.005000."
    assert texts["QUEUE_PRESSURE"] == "DEV002 queue depth reached 95, above threshold 80."
    assert texts["LOW_SNR"] == "DEV002 signal-to-noise ratio dropped to 18.00, below threshold 20.00."
    assert texts["DEVICE_DEGRADED"] == "DEV002 reported DEGRADED system status."


def test_thresholds_are_strict_and_null_never_fires(spark):
    edge = {"temperature_mk": 18.0, "hardware_error_rate": 0.005, "queue_depth": 80, "signal_noise_ratio": 20.0}
    nothing = {k: None for k in edge} | {"system_status": None}
    assert incidents.detect(telemetry(spark, edge, nothing)).count() == 0
    over = [{"temperature_mk": v} for v in (float("nan"), None, 18.0, 18.01)]
    found = incidents.detect(cleaning.standardize(telemetry(spark, *over)))
    assert [r.kafka_offset for r in telemetry(spark, *over).filter("temperature_mk = 18.01").collect()] == [3]
    assert found.count() == 1


def test_incidents_are_inserted_once(spark):
    found = incidents.detect(telemetry(spark, DEGRADED, DEGRADED))
    assert found.count() == 10
    first = incidents.absent(found, found.limit(0))
    assert first.count() == 5
    assert incidents.absent(found, first).count() == 0


def test_summaries_agree(spark):
    events = telemetry(spark, *[{**DEGRADED, "device_id": f"DEV{n % 3:03d}", "event_timestamp": at(n)} for n in range(10)])
    table = incidents.opened(incidents.detect(events), NOON)
    closed = table.withColumn("status", F.lit("RESOLVED")).filter("device_id = 'DEV000'")
    table = table.filter("device_id <> 'DEV000'").unionByName(closed)
    by_type, by_device = incidents.type_summary(table), incidents.device_summary(table)
    assert {r.device_id for r in by_device.collect()} == {"DEV001", "DEV002"}
    total = by_type.agg(F.sum("occurrence_count")).first()[0]
    assert total == by_device.agg(F.sum("raw_incident_count")).first()[0] == 30
    assert all(
        (r.incident_type_count, r.critical_count, r.high_count, r.medium_count) == (5, 3, 9, 3) for r in by_device.collect()
    )
    assert incidents.summary_of(table, "DEV000").count() == 0
    assert incidents.open_ranked(by_type, "DEV001").first().severity == "CRITICAL"


def test_evidence_of_every_device(spark):
    registry = spark.createDataFrame([("DEV002", "Beta", "Lab", 50, "ACTIVE"), ("DEV009", "Iota", "Lab", 50, "ACTIVE")],
                                     "device_id string, device_name string, location string, qubit_count int, operational_status string")
    events = telemetry(spark, DEGRADED)
    table = incidents.opened(incidents.detect(events), NOON)
    bundle = incidents.device_evidence(registry, health.device_health(events), table)
    rows = {r.device_id: r for r in bundle.collect()}
    assert rows["DEV009"].open_incidents is None and rows["DEV009"].device_health.total_events is None
    assert [i.severity for i in rows["DEV002"].open_incidents] == ["CRITICAL", "HIGH", "HIGH", "HIGH", "MEDIUM"]
    document = incidents.evidence_json(bundle).filter("device_id = 'DEV002'").first().document
    assert '"health_score":0.0' in document and '"incident_type":"LOW_SNR"' in document


# Quality -----------------------------------------------------------------------------


def failed(report):
    return {(r.check_name, r.subject): r.violations for r in report.collect() if not r.passed}


def test_clean_batch_passes(spark):
    report = quality.quality_report(telemetry(spark, {}, {"event_timestamp": at(1)}), at(60))
    assert failed(report) == {}
    quality.gate(report)
    assert {r.check_name for r in report.collect()} == set(quality.CHECKS)


def test_every_check_fails_on_its_own_fault(spark):
    rows = [
        {"device_id": None},
        {"event_timestamp": at(1), "temperature_mk": 4.9},
        {"event_timestamp": at(2), "temperature_mk": 40.1, "cpu_usage_pct": 100.0, "queue_depth": 501},
        {"event_timestamp": at(3), "system_status": " odd "},
        {"event_timestamp": at(4), "system_status": None, "temperature_mk": None},
        {"event_timestamp": at(5)},
        {"event_timestamp": at(5), "device_id": " dev001"},
    ]
    report = quality.quality_report(telemetry(spark, *rows), at(60))
    assert failed(report) == {
        ("not_null", "device_id"): 1,
        ("ranges", "temperature_mk"): 2,
        ("ranges", "queue_depth"): 1,
        ("status_values", "system_status"): 1,
        ("uniqueness", "device_id + event_timestamp"): 1,
    }
    summary = {r.check_name: (r.passed, r.error_count) for r in quality.check_summary(report).collect()}
    assert summary["overall"] == (False, 5) and summary["ranges"] == (False, 2) and summary["freshness"] == (True, 0)
    assert [r.system_status for r in quality.invalid_statuses(telemetry(spark, *rows)).collect()] == ["ODD"]
    with pytest.raises(quality.QualityError, match="5 quality checks"):
        quality.gate(report)
    quality.gate(report, fail_on=("required_columns", "freshness"))


def test_nan_is_missing_and_invalid_statuses_are_named(spark):
    df = telemetry(spark, {"temperature_mk": float("nan")}, {"event_timestamp": at(1), "system_status": "odd"}, {"event_timestamp": at(2), "system_status": " Bad"})
    report = quality.quality_report(df, at(60))
    assert failed(report) == {("status_values", "system_status"): 2}
    assert report.filter("check_name = 'status_values'").first().message == "system_status has 2 invalid values: BAD, ODD."
    good, bad = quality.split_quarantine(df)
    assert (good.count(), bad.count()) == (1, 2)


def test_null_keys_count_as_equal(spark):
    df = telemetry(spark, {"event_timestamp": None}, {"event_timestamp": None}, {"device_id": None}, {"device_id": None})
    assert quality.surplus_copies(df).first().surplus == 2


def test_freshness_is_strict(spark):
    day = timedelta(hours=24)
    fresh = lambda df, now: ("freshness", "event_timestamp") not in failed(quality.quality_report(df, now))
    df = telemetry(spark, {})
    assert fresh(df, NOON + day)
    assert not fresh(df, NOON + day + timedelta(microseconds=1))
    assert fresh(df, NOON - day)
    assert not fresh(df.limit(0), NOON)
    assert not fresh(telemetry(spark, {"event_timestamp": None}), NOON)


def test_missing_columns_are_reported(spark):
    report = quality.quality_report(telemetry(spark, {}).drop("schema_version", "queue_depth"), at(1))
    assert failed(report) == {("required_columns", ""): 1}
    assert "schema_version" in report.filter("not passed").first().message


def test_quarantine_splits_all_rows(spark):
    df = telemetry(spark, {}, {"temperature_mk": 99.0, "system_status": "odd"}, {"device_id": None}, {"queue_depth": None})
    good, bad = quality.split_quarantine(df)
    assert sorted(r.kafka_offset for r in good.collect()) == [0, 3]
    assert {r.kafka_offset: r.violations for r in bad.collect()} == {
        1: ["range:temperature_mk", "status_values:system_status"],
        2: ["not_null:device_id"],
    }
    assert good.columns == TELEMETRY.fieldNames()


def test_duplicate_positions(spark):
    df = telemetry(
        spark,
        {"kafka_offset": 1},
        {"kafka_offset": 1},
        {"kafka_offset": 2},
        {"kafka_offset": 2, "event_timestamp": at(1)},
        {"kafka_offset": 3},
        {"kafka_offset": None},
        {"kafka_offset": None},
        {"kafka_offset": 3, "kafka_partition": 1},
    )
    pairs = {r.kafka_offset: (r.row_count, r.interpretation) for r in duplicates.duplicate_positions(df).collect()}
    assert pairs == {1: (2, "replayed_ingestion"), 2: (2, "offset_reuse"), None: (2, "replayed_ingestion")}
    assert duplicates.duplicate_rows(df).count() == 6
    assert tuple(duplicates.duplicate_totals(df).first()) == (3, 6)
