"""Column functions: texts, times, numbers, classifications."""

from __future__ import annotations

import hashlib
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlake.functions import numbers, rules, text, times
from fleetlake.operators import health, incidents
from fleetlake.operators.incidents import event_key
from fleetlake.plans.pipeline import require_read_only


def column(spark, values, expression, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_strip_takes_every_white_space(spark):
    values = ["\t dev001 \n", "DEV001", "\xa0x ", " a b ", "", None, "\x1cq\x85"]
    assert column(spark, values, text.strip) == [None if v is None else v.strip() for v in values]


def test_device_id_format(spark):
    values = [" dev002\t", "DEV002", "DEV02", "DEV0022", "XDEV002", "DEV002\nX", None]
    assert column(spark, values, text.valid_device_id) == ["DEV002", "DEV002", None, None, None, None, None]


def test_required_device_id_fails(spark):
    assert column(spark, [" dev002 "], text.require_device_id) == ["DEV002"]
    with pytest.raises(Exception, match="invalid device id"):
        column(spark, ["DEV2"], text.require_device_id)


def test_mentioned_device(spark):
    values = ["Why is dev002 slow?", "DEV0021", "xDEV002", "(Dev003), DEV004", "nothing", None]
    assert column(spark, values, text.mentioned_device_id) == ["DEV002", None, None, "DEV003", None, None]


@pytest.mark.parametrize(
    "question, route, direction",
    [
        ("Why is DEV002 degraded?", "device_investigation", "DESC"),
        ("Any critical issue with dev002?", "device_investigation", "DESC"),
        ("Show DEV002", "general", "DESC"),
        ("List CRITICAL incidents", "critical_incidents", "DESC"),
        ("Which device has the lowest queue depth?", "queue_ranking", "ASC"),
        ("max queue depth", "queue_ranking", "DESC"),
        ("min queue depth", "queue_ranking", "ASC"),
        ("queue depth min", "queue_ranking", "DESC"),
        ("queue depth", "general", "DESC"),
    ],
)
def test_routing(spark, question, route, direction):
    assert column(spark, [question], text.question_route) == [route]
    assert column(spark, [question], text.ranking_direction) == [direction]


STATEMENTS = {
    "select 1": (None, None),
    "  With x as (select 1) select * from x": (None, None),
    "": ("empty", "empty"),
    " \n ": ("empty", "empty"),
    "drop table t": ("not_read_only", "not_read_only"),
    "selectx": ("not_read_only", "not_read_only"),
    "select 1; delete from t": ("blocked:DELETE", "blocked:DELETE"),
    "select 1;\ndrop\ntable t": (None, "blocked:DROP"),
    "select updated from t": (None, None),
    "explain insert": ("blocked:INSERT", "blocked:INSERT"),
}


def test_statement_audit(spark):
    assert column(spark, STATEMENTS, text.statement_verdict) == [v[0] for v in STATEMENTS.values()]
    strict = column(spark, STATEMENTS, lambda c: text.statement_verdict(c, strict=True))
    assert strict == [v[1] for v in STATEMENTS.values()]
    assert column(spark, [None], text.statement_verdict) == ["empty"]


def test_read_only_statements():
    assert require_read_only(" select 1 ") == "select 1"
    for good in ("select * from t where a = 'DELETE'", "select 1 -- drop\n", "select `call`, \"it's a merge\" from t"):
        assert require_read_only(good) == good.strip()
    for hidden in ("with x as (select 1) -- '\ninsert into t select 1 -- '", "select '\\'' ; drop table t",
                   "with x as (select r'\\' a) insert into t select 'b'", "with x as (select 1) -- a\rinsert into t select 1"):
        with pytest.raises(ValueError):
            require_read_only(hidden)
    for bad in ("", "drop table t", "select 1; drop table t", "select 1;\nDELETE\nfrom t"):
        with pytest.raises(ValueError):
            require_read_only(bad)


def test_iso_texts_become_utc(spark):
    values = [
        "2026-08-22T17:47:33.5+02:00",
        "2026-08-22T17:47:33.500000+00:00",
        "2026-08-22T17:47:33Z",
        "2026-08-22 17:47:33.000001",
        "2026-08-22T17:47:00+05:30",
        "2026-08-22",
        "2026-08-22T10:00:00.123456789Z",
        "20260822T100000Z",
        "20260822T100000,5+0530",
        "20260822T1000-0100",
        "20260822",
        "2026-13-22T17:47:33Z",
        "2026",
        "17:47:33",
        " 2026-08-22",
        "2026-08-22 soon",
        "soon",
        None,
    ]
    assert column(spark, values, times.naive_utc) == [
        datetime(2026, 8, 22, 15, 47, 33, 500000),
        datetime(2026, 8, 22, 17, 47, 33, 500000),
        datetime(2026, 8, 22, 17, 47, 33),
        datetime(2026, 8, 22, 17, 47, 33, 1),
        datetime(2026, 8, 22, 12, 17),
        datetime(2026, 8, 22),
        datetime(2026, 8, 22, 10, 0, 0, 123456),
        datetime(2026, 8, 22, 10),
        datetime(2026, 8, 22, 4, 30, 0, 500000),
        datetime(2026, 8, 22, 11),
        datetime(2026, 8, 22),
        *[None] * 7,
    ]


def test_known_event_key(spark):
    key = lambda ts: event_key(F.lit("DEV002"), ts, F.lit("LOW_SNR"))
    at = [datetime(2026, 8, 22, 17, 47, 33, 500000)]
    assert column(spark, at, key, "v timestamp_ntz") == ["EVT-C8A6DCD57AC9EC4FF28590B1"]


def test_event_keys_match_their_definition(spark):
    rng = random.Random(7)
    base = datetime(2024, 1, 1)
    fractions = [0, 1, 10, 120000, 500000, 999999]
    at = [base + timedelta(seconds=rng.randrange(10**8), microseconds=rng.choice(fractions)) for _ in range(200)]
    got = column(spark, at, lambda ts: event_key(F.lit("DEV007"), ts, F.lit("LOW_SNR")), "v timestamp_ntz")
    digest = lambda t: hashlib.sha256(f"DEV007|{t}|LOW_SNR".encode()).hexdigest()
    assert got == ["EVT-" + digest(t)[:24].upper() for t in at]


@pytest.mark.parametrize(
    "healthy, degraded, critical, score", [(10, 0, 0, 100.0), (5, 5, 0, 37.5), (0, 0, 4, 0.0), (0, 0, 0, 0.0), (2, 1, 0, 58.33)]
)
def test_health_score(spark, healthy, degraded, critical, score):
    df = spark.createDataFrame([(healthy, degraded, critical)], "h long, d long, c long")
    total = F.col("h") + F.col("d") + F.col("c")
    assert df.select(rules.health_score(F.col("h"), F.col("d"), F.col("c"), total)).first()[0] == score


def test_health_score_stays_within_bounds(spark):
    rng = random.Random(3)
    rows = [tuple(rng.randrange(50) for _ in range(3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "h long, d long, c long")
    total = F.col("h") + F.col("d") + F.col("c")
    scores = df.select(rules.health_score(F.col("h"), F.col("d"), F.col("c"), total).alias("s")).collect()
    assert all(0 <= r.s <= 100 for r in scores)


def test_status_limits(spark):
    rows = [
        (22.0, 20.0, 90, 0.008, "HEALTHY", "HEALTHY"),
        (22.1, 20.0, 90, 0.008, "DEGRADED", "DEGRADED"),
        (15.0, 30.0, 30, 0.009, "HEALTHY", "DEGRADED"),
        (15.0, 30.0, 30, 0.016, "HEALTHY", "CRITICAL"),
        (28.1, 19.0, 30, 0.0, "CRITICAL", "CRITICAL"),
        (15.0, 14.9, 30, None, "CRITICAL", "CRITICAL"),
        (15.0, 30.0, 131, None, "CRITICAL", "CRITICAL"),
        (None, None, None, None, "HEALTHY", "HEALTHY"),
    ]
    df = spark.createDataFrame(rows, "t double, s double, q int, e double, v1 string, v2 string")
    got = df.select(
        rules.operating_status(F.col("t"), F.col("s"), F.col("q")).alias("a"),
        rules.operating_status(F.col("t"), F.col("s"), F.col("q"), F.col("e")).alias("b"),
    ).collect()
    assert [(r.a, r.b) for r in got] == [r[4:] for r in rows]


def test_calibration_limits(spark):
    rows = [
        (0.01, 0.08, 40.0, 30.0, "PASS"),
        (0.0101, 0.08, 40.0, 30.0, "FAIL"),
        (0.01, 0.081, 40.0, 30.0, "FAIL"),
        (0.01, 0.08, 39.9, 30.0, "FAIL"),
        (0.01, 0.08, 40.0, 29.9, "FAIL"),
    ]
    df = spark.createDataFrame(rows, "g double, r double, t1 double, t2 double, want string")
    got = df.select("want", rules.calibration_status(F.col("g"), F.col("r"), F.col("t1"), F.col("t2")).alias("s"))
    assert all(r.want == r.s for r in got.collect())


def test_severity_order(spark):
    names = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "OTHER", None]
    assert column(spark, names, rules.severity_rank) == [1, 2, 3, 4, 5, 5]


def test_numbers(spark):
    assert column(spark, [1.5, float("nan"), None], numbers.no_nan, "v double") == [1.5, None, None]
    assert column(spark, [-1.0, 5.0, 11.0, None], lambda c: numbers.clamp(c, 0, 10), "v double") == [0, 5, 10, None]
    noisy = [0.1 + 0.2, 2.675, 1.005, 1e30, None]
    assert column(spark, noisy, lambda c: numbers.settle(c, 2), "v double") == [0.3, 2.68, 1.01, 1e30, None]


def test_codes(spark):
    assert column(spark, [7, 123, 4567], lambda c: text.coded("DEV", c, 3), "v long") == ["DEV007", "DEV123", "DEV4567"]


def test_time_arithmetic(spark):
    at = [datetime(2024, 1, 1, 0, 0, 0, 1)]
    assert column(spark, at, lambda c: times.plus_millis(c, F.lit(1500)), "v timestamp_ntz") == [
        datetime(2024, 1, 1, 0, 0, 1, 500001)
    ]
    assert column(spark, at, times.end_of_day_range, "v timestamp_ntz") == [datetime(2024, 1, 1, 23, 59, 0, 1)]
    half = lambda c: times.elapsed_days(F.lit(datetime(2023, 12, 31, 12)).cast("timestamp_ntz"), c)
    assert column(spark, [datetime(2024, 1, 1)], half, "v timestamp_ntz") == [0.5]


def test_word_lists_are_plain_words():
    words = text.INVESTIGATION_WORDS + text.CRITICAL_PHRASES + text.RANKING_WORDS + text.LOWEST_WORDS
    assert all(re.fullmatch(r"[a-z ]+", w) for w in words)


def test_lookups_refuse_a_malformed_device_id(spark):
    frame = spark.createDataFrame([("DEV001",)], "device_id string")
    for bad in ("", "DEV1", "DEV0011", "xDEV001", "DEV٠٠١", "DEV001; DROP"):
        for lookup in (lambda: health.health_report(frame, frame, bad), lambda: incidents.summary_of(frame, bad), lambda: incidents.open_ranked(frame, bad)):
            with pytest.raises(ValueError, match="invalid device id"):
                lookup()
    assert text.device_id_of(" dev001\n") == "DEV001"
