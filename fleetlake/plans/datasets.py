"""The fleet's data sets derived from the benchmark tables.

Each function reads whole tables and keeps every row and key apart, so the work and the result of
every query built on it grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.text import coded
from fleetlake.functions.times import plus_millis
from fleetlake.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze telemetry with untidy ids, statuses and versions; every eighth event was delivered again an hour later.

    Half of these second copies have a status that is not valid, which drops their event. A
    quarter of the event times are whole seconds.
    """
    sent = _telemetry_sent(spark, sf_dir)
    again = sent.filter(F.col("kafka_offset") % 8 == 1).withColumns(
        {
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"),
            "kafka_partition": F.col("kafka_partition") + 3,
            "system_status": F.when(F.col("kafka_offset") % 16 == 1, "unknown").otherwise(F.col("system_status")),
        }
    )
    return sent.unionByName(again)


def _telemetry_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    number = F.col("event_id")
    device = coded("DEV", F.col("user_id"), 3)
    is_v1 = number % 3 == 0
    depth = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.when(number % 97 == 0, F.lit(None).cast("string"))
        .when(number % 5 == 0, F.concat(F.lit(" "), F.lower(device), F.lit("\t")))
        .otherwise(device)
        .alias("device_id"),
        F.when(number % 4 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts")).cast("timestamp_ntz").alias("event_timestamp"),
        F.col("value").alias("temperature_mk"),
        (F.col("value") % 100).alias("cpu_usage_pct"),
        (F.col("value") * 2 % 100).alias("memory_usage_pct"),
        depth.alias("queue_depth"),
        F.floor(depth / 3).cast("int").alias("active_jobs"),
        (number % 20 + 15).cast("double").alias("signal_noise_ratio"),
        F.when(~is_v1, F.lit(1.0) + (number % 7) / F.lit(100.0)).alias("cryogenic_pressure_mbar"),
        F.when(~is_v1, (number % 10) / F.lit(1000.0)).alias("hardware_error_rate"),
        F.when(F.col("event_type") == "view", "healthy")
        .when(F.col("event_type") == "click", " Healthy ")
        .when(F.col("event_type") == "purchase", "DEGRADED")
        .when(F.col("event_type") == "error", "critical")
        .otherwise("unknown")
        .alias("system_status"),
        F.when(is_v1, "v1").otherwise(" V2 ").alias("schema_version"),
        F.col("ts").alias("ingested_at"),
        (F.col("user_id") % 3).cast("int").alias("kafka_partition"),
        number.alias("kafka_offset"),
    )


def telemetry_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze in which degraded events came twice, and critical ones share an offset with an event a day later."""
    raw = telemetry_raw(spark, sf_dir)
    hour = F.expr("INTERVAL 1 HOUR")
    replayed = raw.filter("system_status = 'DEGRADED'").withColumn("ingested_at", F.col("ingested_at") + hour)
    reused = raw.filter("system_status = 'critical'").withColumns(
        {
            "event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 1 DAY"),
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY"),
        }
    )
    return raw.unionByName(replayed).unionByName(reused)


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        coded("DEV", F.col("s_suppkey"), 3).alias("device_id"),
        F.col("s_name").alias("device_name"),
        F.col("n_name").alias("location"),
        (F.col("s_suppkey") % 3 * 25 + 50).cast("int").alias("qubit_count"),
        F.when(F.col("s_acctbal") >= 0, "ACTIVE").otherwise("MAINTENANCE").alias("operational_status"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    number = F.col("o_orderkey")
    return o.select(
        coded("JOB", number, 8).alias("job_id"),
        coded("USR", F.col("o_custkey"), 5).alias("user_id"),
        coded("DEV", F.col("o_custkey"), 3).alias("device_id"),
        F.col("o_orderdate").alias("submitted_at"),
        plus_millis(F.col("o_orderdate"), number % 480 + 20).alias("queued_at"),
        (number % 5000).alias("queue_time_ms"),
        (number % 900).alias("execution_time_ms"),
        (number % 40 * 100 + 100).cast("int").alias("shots"),
        (number % 245 + 5).cast("int").alias("circuit_depth"),
        F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(F.col("o_orderstatus") == "F", "TIMEOUT").alias("error_code"),
    )


def calibrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration records without their status, one for every line item."""
    item = table(spark, sf_dir, "lineitem")
    return item.select(
        F.concat_ws(
            "-",
            coded("CAL", F.col("l_orderkey"), 8),
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.to_date("l_shipdate").cast("string"),
            F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"),
        ).alias("calibration_id"),
        coded("DEV", F.col("l_suppkey"), 3).alias("device_id"),
        coded("Q", F.col("l_linenumber"), 3).alias("qubit_id"),
        F.col("l_shipdate").alias("calibration_timestamp"),
        (F.col("l_quantity") * 4).alias("t1_us"),
        (F.col("l_quantity") * 3).alias("t2_us"),
        (F.col("l_discount") / 8).alias("gate_error"),
        (F.col("l_tax") * 1.5).alias("readout_error"),
        (F.lit(4.5) + F.col("l_linenumber") / F.lit(10.0)).alias("frequency_ghz"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation text behind one of four openings."""
    c = table(spark, sf_dir, "conversations")
    opening = (
        F.when(F.col("conv_id") % 4 == 0, F.concat(F.lit("why is "), coded("dev", F.col("conv_id") % 1000, 3), F.lit(" degraded? ")))
        .when(F.col("conv_id") % 4 == 1, "Any CRITICAL incidents? ")
        .when((F.col("conv_id") % 4 == 2) & (F.col("turn") % 2 == 0), "Which device has the lowest queue depth? ")
        .when(F.col("conv_id") % 4 == 2, "Which device has the highest queue depth? ")
        .otherwise("")
    )
    return c.select("conv_id", "turn", F.concat(opening, "text").alias("text"))


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation text behind the beginning of a statement, some of which write."""
    c = table(spark, sf_dir, "conversations")
    case = (F.col("conv_id") * 3 + F.col("turn")) % 8
    opening = (
        F.when(case == 0, "SELECT * FROM gold.device_health -- ")
        .when(case == 1, "  show tables ")
        .when(case == 2, "drop table t; ")
        .when(case == 3, "with x as (select 1) delete from t ")
        .when(case == 4, "\n explain select 1;\ndrop\ntable t ")
        .when(case == 5, "insert into t values ")
        .when(case == 6, "Describe t; UPDATE t set a=1 ")
        .otherwise("")
    )
    return c.select("conv_id", "turn", F.concat(opening, "text").alias("statement"))
