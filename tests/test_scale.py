"""Plans that hold at scale: pushdown, pruning, pre-aggregation, skew."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR
from frames import DEGRADED, NOON, at, telemetry
from pyspark.sql import functions as F

from fleetlake.operators import calibration, cleaning, duplicates, health, incidents, jobs, profile, quality, series
from fleetlake.plans import datasets, pipeline
from fleetlake.plans.reports import REPORTS
from fleetlake.schemas import CALIBRATIONS_CSV, JOBS_CSV
from fleetlake.session import scratch_dir, shared_dir, size_for, sizing
from fleetlake.sources.tables import Lake

# These write tables or run streams while the result is set up.
EAGER = {
    "stream_bronze", "stream_silver", "stream_incidents", "stream_jobs", "stream_metrics", "run_metrics", "runs_with_late_events",
    "incidents_after_two_runs", "incident_summary_kept_up", "upsert_buckets", "uptime_from_carry",
    "gaps_from_carry", "late_bound_column", "csv_roundtrip", "table_evolution", "table_listing",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(set(REPORTS) - EAGER))
def test_no_product_joins_and_no_python(spark, name):
    text = plan(REPORTS[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|MapPartitions", text)
    assert not re.search(r"Window \[.*\], \[\], ", text), "a window without a partition"


def stored(lake, *rows):
    lake.append_events("silver.telemetry", telemetry(lake.spark, *rows))
    return lake.read("silver.telemetry")


def read_schema(text):
    return re.search(r"ReadSchema: struct<(.*?)>", text).group(1)


def test_only_needed_columns_are_read(lake):
    silver = stored(lake, {})
    assert read_schema(plan(silver.groupBy("system_status").count())) == "system_status:string"
    assert read_schema(plan(health.queue_ranking(silver))) == "device_id:string,queue_depth:int"
    counted = plan(incidents.severity_histogram(incidents.detect(silver)))
    assert "format_string" not in counted and "sha2" not in counted and "cpu_usage_pct" not in counted


def test_device_filter_reaches_the_scan(lake):
    silver = stored(lake, {})
    text = plan(health.device_health(silver).filter("device_id = 'DEV001'"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(device_id,DEV001\)", text)


def test_required_columns_are_filtered_in_the_scan(lake):
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}))
    text = plan(cleaning.clean(lake.read("bronze.telemetry")))
    for c in ("device_id", "event_timestamp", "schema_version"):
        assert re.search(rf"PushedFilters: \[[^\]]*IsNotNull\({c}\)", text)


def test_incremental_run_reads_touched_dates_only(lake):
    silver = stored(lake, *[{"event_timestamp": at(day * 24 * 60)} for day in range(5)])
    batch = telemetry(lake.spark, {"event_timestamp": at(24 * 60 + 5)}, {"event_timestamp": at(3 * 24 * 60)})
    new = cleaning.unseen(cleaning.clean(batch), silver, cleaning.touched_dates(batch))
    assert [r.event_timestamp for r in new.collect()] == [at(24 * 60 + 5)]
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan(new))


def test_many_dates_and_a_stray_one_prune_by_semi_join(lake):
    """However many dates a batch has, a table is read for just these."""
    days = [datetime(2020, 1, 1) + timedelta(days=d) for d in range(1500)] + [datetime(2126, 1, 1)]
    batch = telemetry(lake.spark, *[{"event_timestamp": d} for d in days])
    lake.append_events("silver.telemetry", telemetry(lake.spark, {}, {"event_timestamp": days[3]}, {"event_timestamp": days[-1]}))
    held = cleaning.on_dates(lake.read("silver.telemetry"), cleaning.touched_dates(batch))
    assert sorted(r.event_timestamp for r in held.collect()) == [days[3], days[-1]]
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan(held))
    assert cleaning.on_dates(lake.read("silver.telemetry"), cleaning.touched_dates(batch.limit(0))).collect() == []


def test_copies_are_limited_before_the_shuffle(spark):
    text = plan(cleaning.clean(telemetry(spark, {})))
    assert re.search(r"Final.*Exchange hashpartitioning.*Partial", text, re.S)
    assert len(re.findall("Exchange", text)) == 1


def test_aggregates_have_a_partial_stage_and_one_shuffle(spark):
    for df in (health.device_health(telemetry(spark, {})), quality.surplus_copies(telemetry(spark, {}))):
        text = plan(df)
        assert "partial_" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert len(re.findall("Exchange hash", plan(health.device_health(telemetry(spark, {}))))) == 1


def test_one_key_with_a_third_of_all_rows(spark):
    """Every operator that groups or joins by key, on a table dominated by one event."""
    n = 6000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "DEV001").otherwise(F.concat(F.lit("D"), F.col("id") % 500)).alias("device_id"),
        F.when(F.col("id") % 3 == 0, F.lit(NOON)).otherwise(F.lit(NOON) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("event_timestamp"),
        *[F.lit(1.0).alias(c) for c in ("temperature_mk", "cpu_usage_pct", "memory_usage_pct")],
        F.lit(1).alias("queue_depth"),
        F.lit(1).alias("active_jobs"),
        *[F.lit(1.0).alias(c) for c in ("signal_noise_ratio", "cryogenic_pressure_mbar", "hardware_error_rate")],
        F.lit("HEALTHY").alias("system_status"),
        F.lit("v2").alias("schema_version"),
        F.lit(NOON).cast("timestamp_ntz").alias("ingested_at"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(1).alias("kafka_partition"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("kafka_offset"),
    )
    hot, rest = n // 3, n - n // 3
    silver = cleaning.clean(df)
    assert silver.count() == rest + 1
    assert quality.surplus_copies(df).first().surplus == hot - 1
    assert tuple(duplicates.duplicate_totals(df).first()) == (1, hot)
    assert duplicates.duplicate_rows(df).count() == hot
    funnel = cleaning.cleaning_funnel(df, silver.limit(0)).first()
    assert (funnel.duplicates, funnel.new_events) == (hot - 1, rest + 1)
    assert health.device_health(df).filter("device_id = 'DEV001'").first().total_events == hot
    found = incidents.detect(df)  # two rules fire
    assert incidents.absent(found, found.limit(0)).count() == 2 * (rest + 1)


def test_hot_device_day_is_split_in_the_job_join(spark, no_broadcast):
    day = NOON
    history = spark.createDataFrame(
        [(f"C{i}", "HOT" if i == 0 else f"D{i}", "Q", day, 50.0, 50.0, 0.001, 0.001, 5.0, "PASS") for i in range(200)], CALIBRATIONS_CSV
    )
    work = spark.range(30_000).select(
        F.concat(F.lit("J"), F.col("id")).alias("job_id"),
        F.lit("U").alias("user_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("D"), F.col("id") % 200)).alias("device_id"),
        F.lit(day).cast("timestamp_ntz").alias("submitted_at"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in JOBS_CSV.fields[4:]],
    )
    scored = jobs.failure_probability(work.repartition(8), history)
    assert scored.groupBy().agg(F.count("*"), F.count_distinct("job_id")).first() == (30_000, 30_000)
    scored.collect()
    assert "skew=true" in plan(scored)


def test_hot_position_is_split_when_its_rows_are_fetched(spark, no_broadcast):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("kafka_offset"),
        F.lit(0).alias("kafka_partition"),
        F.lit(NOON).cast("timestamp_ntz").alias("event_timestamp"),
    )
    rows = duplicates.duplicate_rows(df.repartition(8))
    assert len(rows.collect()) == 10_000
    assert "skew=true" in plan(rows)


def test_latest_records_are_limited_before_the_shuffle(spark):
    history = spark.createDataFrame([("C", "DEV002", "Q", NOON, 50.0, 50.0, 0.001, 0.001, 5.0, "PASS")], CALIBRATIONS_CSV)
    assert re.search(r"Final.*Exchange hash.*Partial", plan(calibration.latest_records(history)), re.S)


def test_running_total_has_no_window_over_a_whole_device(spark):
    df = telemetry(spark, *[{"event_timestamp": at(i)} for i in range(50)])
    text = plan(series.uptime_hours(df))
    windows = re.findall(r"Window \[sum\(.*?windowspecdefinition\((.*?) ASC", text)
    over_rows, over_slices = sorted(windows, key=len, reverse=True)
    assert re.fullmatch(r"device_id#\d+, _slice#\d+, event_timestamp#\d+", over_rows)
    assert re.fullmatch(r"device_id#\d+, _slice#\d+", over_slices)


def test_top_k_needs_no_full_sort(spark):
    found = incidents.opened(incidents.detect(telemetry(spark, {})), NOON)
    assert "TakeOrderedAndProject" in plan(incidents.newest(found))
    assert "TakeOrderedAndProject" in plan(health.queue_ranking(telemetry(spark, {})))


def test_appends_are_rebalanced_by_date(lake):
    rows = [{"event_timestamp": at(i)} for i in range(40)] + [{"event_timestamp": at(24 * 60 * 3)}]
    assert lake.append_events("bronze.telemetry", telemetry(lake.spark, *rows)) == 41
    files = lake.read("bronze.telemetry").select(F.input_file_name()).distinct().count()
    assert files == 2


def scans(text, table):
    """The plan's operators above each scan of a table up to the next join."""
    lines = text.splitlines()
    for at, line in enumerate(lines):
        if re.search(rf"FileScan parquet \S*{table}\b", line):
            depth, above = line.index("FileScan"), []
            for other in reversed(lines[:at]):
                place = re.search(r"[A-Za-z]", other)
                if place and place.start() < depth:
                    depth = place.start()
                    if re.match(r"(SortMerge|ShuffledHash)Join", other[depth:]):
                        break
                    above.append(other[depth:])
            yield line, above


def test_looking_for_known_keys_does_not_shuffle_the_tables(lake, no_broadcast):
    """Silver and incidents keep each key in one bucket: only the new side moves."""
    lake.append_events("silver.telemetry", telemetry(lake.spark, {}, DEGRADED))
    pipeline.record_incidents(lake, NOON)
    batch = telemetry(lake.spark, {}, {"event_timestamp": at(1)}, {**DEGRADED, "event_timestamp": at(24 * 60)})
    dates = cleaning.touched_dates(batch)
    new = cleaning.unseen(cleaning.clean(batch), lake.read("silver.telemetry"), dates, standard=True)
    absent = incidents.absent(incidents.detect(batch), lake.read("ops.incidents"), dates)
    assert (new.count(), absent.count()) == (2, 5)
    for df, table in ((new, "telemetry"), (absent, "incidents")):
        found = list(scans(plan(df), table))
        assert found
        for scan, above in found:
            assert "Bucketed: true" in scan and not any("Exchange hash" in line for line in above), above


def test_a_bucket_of_silver_is_written_by_one_task(lake):
    rows = [{"event_timestamp": at(i), "device_id": f"D{i % 7}"} for i in range(400)]
    lake.append_events("bronze.telemetry", telemetry(lake.spark, *rows))
    pipeline.refresh_silver(lake)
    files = lake.read("silver.telemetry").select(F.input_file_name().alias("f")).distinct().collect()
    assert len(files) == lake.buckets


def rows_read(df) -> int:
    """Rows that the scan of a query without a shuffle gave, after row groups and pages were skipped."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_a_device_is_found_in_few_row_groups(lake):
    """Files are sorted by device, so that a device's rows stand together; Bloom filters tell of keys in no order."""
    rows = [{"event_timestamp": at(i / 60), "device_id": f"DEV{i % 50:03d}", "queue_depth": 95 if i % 4 == 0 else 1} for i in range(20_000)]
    lake.spark.conf.set("parquet.block.size", "20000")
    try:
        lake.append_events("silver.telemetry", telemetry(lake.spark, *rows))
        pipeline.record_incidents(lake, NOON)
    finally:
        lake.spark.conf.unset("parquet.block.size")
    one = lake.read("silver.telemetry").filter("device_id = 'DEV007'")
    assert one.count() == 400 and rows_read(one) < 20_000 / 10
    found = lake.read("ops.incidents")
    key = found.first().event_key
    assert found.count() == 5000
    assert found.filter(F.col("event_key") == key).count() == 1 and rows_read(found.filter(F.col("event_key") == key)) < 5000 / 10


def test_bloom_filters_are_of_the_size_that_their_rows_need(lake):
    """A file of few rows had a filter of a megabyte for each column."""
    hot = [{**DEGRADED, "event_timestamp": at(i), "device_id": f"DEV{i:03d}"} for i in range(300)]
    events = telemetry(lake.spark, *hot)
    lake.append_events("silver.telemetry", events)
    pipeline.record_incidents(lake, NOON)
    for table, column in (("silver/telemetry", "device_id"), ("ops/incidents", "event_key")):
        files = [str(p) for p in Path(lake.root, table).rglob("*.parquet")]
        found = duckdb.sql(f"SELECT bloom_filter_length FROM parquet_metadata({files}) WHERE path_in_schema = '{column}'").fetchall()
        assert len(found) >= len(files) > 0 and all(0 < length < 2**16 for (length,) in found)
        assert all(Path(f).stat().st_size < 2**17 for f in files)


def test_scratch_is_below_the_shared_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    assert scratch_dir(spark, "x").startswith(f"{named}/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_derived_tables_keep_every_row(spark):
    for name, source in (("jobs", "orders"), ("calibrations", "lineitem"), ("statements", "conversations")):
        assert getattr(datasets, name)(spark, SF_DIR).count() == datasets.table(spark, SF_DIR, source).count()
    ids = datasets.calibrations(spark, SF_DIR).select("calibration_id")
    assert ids.distinct().count() == ids.count()


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_silver_grows_with_the_events(spark, sf_dir):
    """One row for each user and event time whose last copy has a valid status; nothing is folded."""
    events = datasets.table(spark, sf_dir, "events")
    raw = datasets.telemetry_raw(spark, sf_dir)
    assert raw.count() == events.count() + events.filter("event_id % 8 = 1").count()
    kept = events.filter("event_id % 97 <> 0 AND event_id % 16 <> 1 AND event_type IN ('view', 'click', 'purchase', 'error')")
    time = F.when(F.col("event_id") % 4 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts"))
    silver = cleaning.clean(raw)
    assert silver.count() == kept.select("user_id", time).distinct().count() > 0.5 * events.count()
    assert silver.select("device_id").distinct().count() == kept.select("user_id").distinct().count()


def test_stale_data_is_relative_to_the_given_time(spark):
    report = quality.quality_report(telemetry(spark, {}), NOON + timedelta(days=2))
    assert not report.filter("check_name = 'freshness'").first().passed


def test_settings_grow_with_the_data(spark):
    width = lambda *a, **b: int(sizing(*a, **b)["spark.sql.shuffle.partitions"])
    assert (width(2**30), width(2**40), width(100 * 2**40)) == (200, 4096, 409_600)
    assert width(100 * 2**40, most=50_000) == 50_000 and width(2**40, 2**30) == 1024
    assert sizing(2**40)["spark.sql.files.maxPartitionBytes"] == sizing(100 * 2**40)["spark.sql.files.maxPartitionBytes"]
    before = {k: spark.conf.get(k) for k in sizing(1)}
    try:
        assert size_for(spark, 2**40).conf.get("spark.sql.shuffle.partitions") == "4096"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_run_reads_bronze_and_silver_few_times(lake, monkeypatch):
    """Tables a run opens, not scans: bronze for the gate (which scans it three times), quarantine and cleaning; silver for gold, comparison and detection."""
    lake.append_events("bronze.telemetry", telemetry(lake.spark, {}, {"event_timestamp": at(24 * 60)}))
    read, seen = Lake.read, []
    monkeypatch.setattr(Lake, "read", lambda self, table: seen.append(table) or read(self, table))
    pipeline.run_pipeline(lake, at(24 * 60))
    assert seen.count("bronze.telemetry") == 3 and seen.count("silver.telemetry") == 3


def test_funnel_and_crosstab_aggregate_in_hash_tables(spark):
    df = telemetry(spark, {}, {"device_id": "DEV002"})
    for text in (plan(cleaning.cleaning_funnel(df, df)), plan(profile.status_crosstab(df))):
        assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert len(re.findall("Exchange hash", plan(profile.status_crosstab(df)))) == 1
