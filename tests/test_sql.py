"""SQL over the lake: what a statement may do, functions, and summaries that are kept up by day."""

from __future__ import annotations

from datetime import timedelta

import pytest
from frames import DEGRADED, NOON, at, telemetry
from pyspark.sql import functions as F

from fleetlake.functions import rules, text
from fleetlake.operators import incidents
from fleetlake.operators.quality import REPLAY_TOLERANT
from fleetlake.plans import pipeline
from fleetlake.plans.sqlfunctions import FUNCTIONS, register_functions

NOW = at(24 * 60)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def filled(lake):
    lake.append_events("bronze.telemetry", telemetry(lake.spark, DEGRADED, {"event_timestamp": at(1)}))
    pipeline.run_pipeline(lake, at(60), REPLAY_TOLERANT)
    pipeline.register_views(lake)
    return lake


def test_reading_statements_pass(filled):
    silver, ops = filled.name("silver.telemetry"), filled.name("ops")
    for statement in (
        f"SELECT device_id, count(*) FILTER (WHERE queue_depth > 1) AS n FROM {silver} WHERE device_id IN (SELECT device_id FROM "
        f"{filled.name('gold.device_health')}) GROUP BY device_id HAVING n > 0 ORDER BY n DESC LIMIT 3",
        "WITH a AS (SELECT 1 AS x), b AS (SELECT x + 1 AS x FROM a) SELECT * FROM a UNION ALL SELECT * FROM b",
        f"SELECT 'DROP TABLE csv.`/x`' AS t, row_number() OVER w FROM {silver} WINDOW w AS (ORDER BY device_id) -- delete from it",
        f"SELECT t.a FROM {silver} LATERAL VIEW explode(array(1, 2)) t AS a /* insert */",
        f"SELECT * FROM spark_catalog.{silver} TABLESAMPLE (1 ROWS)",
        f"EXPLAIN SELECT * FROM {silver}",
        f"DESCRIBE TABLE {silver}",
        f"SHOW TABLES IN {ops}",
        "SELECT health_score(healthy_events, degraded_events, critical_events, total_events) FROM "
        f"{filled.name('gold.device_health')}",
        "SELECT * FROM open_incidents('dev002')",
        "SELECT max(raw_incident_count) FROM device_incident_summary",
    ):
        pipeline.query(filled, statement).collect()


def test_everything_else_is_refused(filled):
    silver = filled.name("silver.telemetry")
    filled.spark.range(1).createOrReplaceTempView("another_view")
    for statement, reason in (
        ("SELECT reflect('java.lang.System', 'getProperty', 'user.home')", "function: reflect"),
        ("SELECT * FROM csv.`/etc/passwd`", "table: csv./etc/passwd"),
        ("SELECT * FROM parquet.`/tmp`", "table: parquet"),
        ("EXPLAIN SELECT java_method('java.lang.System', 'exit', 1)", "function: java_method"),
        ("SELECT * FROM VALUES (reflect('a', 'b')) AS t(a)", "function: reflect"),
        ("WITH a AS (SELECT try_reflect('a', 'b') AS x) SELECT * FROM a", "function: try_reflect"),
        (f"SELECT * FROM {silver} WHERE EXISTS (SELECT 1 FROM text.`/etc/passwd`)", "table: text"),
        (f"SELECT (SELECT max(value) FROM text.`/etc/passwd`) FROM {silver}", "table: text"),
        (f"SELECT sum(1) FILTER (WHERE reflect('a', 'b') = 'x') FROM {silver}", "function: reflect"),
        (f"SELECT sum(1) OVER w FROM {silver} WINDOW w AS (ORDER BY reflect('a', 'b'))", "function: reflect"),
        (f"SELECT transform(array(1), x -> input_file_name()) FROM {silver}", "function: input_file_name"),
        (f"SELECT TRANSFORM(device_id) USING 'cat' FROM {silver}", "operation: ScriptTransformation"),
        ("SELECT * FROM another_view", "table: another_view"),
        ("SELECT * FROM (WITH another_view AS (SELECT 1) SELECT * FROM another_view), another_view", "table: another_view"),
        ("WITH a AS (SELECT * FROM a) SELECT * FROM a", "table: a"),
        ("SELECT * FROM IDENTIFIER('another_view')", "operation: PlanWithUnresolvedIdentifier"),
        ("SELECT * FROM range(10)", "function: range"),
        ("SHOW TABLES IN default", "namespace: default"),
        ("DESCRIBE TABLE another_view", "table: another_view"),
        (f"DROP TABLE {silver}", "read-only"),
    ):
        with pytest.raises(ValueError, match=reason):
            pipeline.query(filled, statement)


def test_functions_equal_their_columns(spark):
    assert set(register_functions(spark)) == set(FUNCTIONS)
    scored = spark.range(200).select(*[(F.col("id") * m % 7).alias(c) for c, m in zip("hdc", (3, 5, 11), strict=True)])
    scored = scored.withColumn("t", F.col("h") + F.col("d") + F.col("c"))
    events = spark.createDataFrame(
        [("DEV001", NOON, "LOW_SNR"), (None, NOON + timedelta(microseconds=7), "X"), ("é|", None, None)], "d string, t timestamp_ntz, i string"
    )
    readings = spark.range(400).selectExpr(
        "id % 40 + 0.5D AS t", "CAST(id % 30 AS DOUBLE) AS s", "CAST(id % 150 AS INT) AS q", "IF(id % 3 = 0, NULL, id % 20 / 1000D) AS e"
    )
    said = ["why is dev001 degraded?", "  dev002\t", "Any CRITICAL incidents", "queue depth: the lowest, it's \\ 'quoted'", "", None, "xDEV001", "DEV0012"]
    questions = spark.createDataFrame([(q,) for q in said], "q string")
    severities = spark.createDataFrame([(s,) for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW", "x", None)], "s string")
    col = F.col
    for frame, call, column in (
        (scored, "health_score(h, d, c, t)", rules.health_score(col("h"), col("d"), col("c"), col("t"))),
        (events, "event_key(d, t, i)", incidents.event_key(col("d"), col("t"), col("i"))),
        (readings, "operating_status(t, s, q, e)", rules.operating_status(col("t"), col("s"), col("q"), col("e"))),
        (readings, "calibration_status(e, e, t, s)", rules.calibration_status(col("e"), col("e"), col("t"), col("s"))),
        (severities, "severity_rank(s)", rules.severity_rank(col("s"))),
        (questions, "question_route(q)", text.question_route(col("q"))),
        (questions, "ranking_direction(q)", text.ranking_direction(col("q"))),
        (questions, "valid_device_id(q)", text.valid_device_id(col("q"))),
        (questions, "mentioned_device_id(q)", text.mentioned_device_id(col("q"))),
    ):
        frame.createOrReplaceTempView("given")
        found = spark.sql(f"SELECT {call} AS found FROM given")
        assert found.collect() == frame.select(column.alias("found")).collect(), call
        assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_open_incidents_of_a_device(filled):
    ranked = "SELECT *, severity_rank(severity) AS rank FROM open_incidents(' dev002 ') ORDER BY rank, incident_type"
    found = pipeline.query(filled, ranked).drop("rank")
    expected = incidents.open_ranked(incidents.type_summary(filled.read("ops.incidents")), "DEV002").select(found.columns)
    assert found.collect() == expected.collect() and found.count() == 5
    assert pipeline.query(filled, "SELECT * FROM open_incidents('nonsense')").count() == 0


def summaries(lake):
    pipeline.register_views(lake)
    kept = [lake.spark.table(v) for v in pipeline.VIEWS]
    table = lake.read("ops.incidents")
    whole = [incidents.type_summary(table), incidents.device_summary(table)]
    for found, expected in zip(kept, whole, strict=True):
        assert found.columns == expected.columns and rows(found) == rows(expected)
        assert "ops/incidents" not in found._jdf.queryExecution().executedPlan().toString()
    return {r.device_id: r.raw_incident_count for r in kept[1].collect()}


def test_summaries_are_kept_up_through_appends_replays_and_resolutions(lake):
    def deliver(*events):
        lake.append_events("bronze.telemetry", telemetry(lake.spark, *events))
        pipeline.run_pipeline(lake, NOW, REPLAY_TOLERANT)

    first = [DEGRADED, {**DEGRADED, "event_timestamp": at(5)}, {**DEGRADED, "device_id": "DEV003", "event_timestamp": at(-48 * 60)}]
    deliver(*first)
    assert summaries(lake) == {"DEV002": 10, "DEV003": 5}
    deliver(*first)
    deliver({**DEGRADED, "event_timestamp": at(-24 * 60), "queue_depth": 1})
    assert summaries(lake) == {"DEV002": 14, "DEV003": 5}
    table = lake.read("ops.incidents")
    some = table.filter("device_id = 'DEV003' OR incident_type = 'LOW_SNR'").select("event_key", "event_timestamp")
    unknown = some.limit(1).withColumn("event_key", F.lit("EVT-X"))
    pipeline.resolve_incidents(lake, some.unionByName(unknown), NOW)
    assert summaries(lake) == {"DEV002": 11}
    resolved = lake.read("ops.incidents").filter("status = 'RESOLVED'")
    assert resolved.count() == 8 and resolved.select("resolved_at").distinct().collect() == [(NOW,)]
    before = rows(lake.read("ops.incidents"))
    pipeline.resolve_incidents(lake, some, NOW + timedelta(days=1))
    deliver(*first)
    assert rows(lake.read("ops.incidents")) == before and summaries(lake) == {"DEV002": 11}


def files_of(table):
    listed = table.select("event_date", F.input_file_name().alias("file")).distinct().collect()
    return {day: sorted(r.file for r in listed if r.event_date == day) for day in {r.event_date for r in listed}}


def test_resolving_writes_only_its_dates(lake):
    lake.append_events("silver.telemetry", telemetry(lake.spark, DEGRADED, {**DEGRADED, "event_timestamp": at(24 * 60)}))
    pipeline.record_incidents(lake, NOW)
    table = lake.read("ops.incidents")
    before = files_of(table)
    pipeline.resolve_incidents(lake, table.filter(F.col("event_date") == NOON.date()).limit(1), NOW)
    after = files_of(lake.read("ops.incidents"))
    assert after[at(24 * 60).date()] == before[at(24 * 60).date()] and after[NOON.date()] != before[NOON.date()]
