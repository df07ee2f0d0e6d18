"""Keyed JSON messages: reading them from a broker or from files, decoding, publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.numbers import no_nan
from fleetlake.functions.times import naive_utc
from fleetlake.schemas import ENVELOPE, JOB_EVENT, PAYLOAD, TELEMETRY, V2_ONLY

CORRUPT = "_corrupt"
FIRST_VERSION = "v1"

# The writers' default formats stop at milliseconds.
PAYLOAD_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
ENVELOPE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


# What one micro-batch takes at most unless told otherwise; the rest follows in the next ones.
MAX_ROWS = 50_000_000
MAX_FILES = 1_000
# What a file of messages holds at most: it is compressed, and one task reads it.
FILE_ROWS = 100_000


def _event_schema(schema: T.StructType) -> T.StructType:
    """How a payload looks in JSON: timestamps and whole numbers are texts, and nothing is mandatory."""
    as_text = (T.TimestampNTZType, T.IntegerType, T.LongType)
    fields = [T.StructField(f.name, T.StringType() if isinstance(f.dataType, as_text) else f.dataType) for f in schema.fields]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def message_stream(spark: SparkSession, source: dict) -> DataFrame:
    """Stream of ``key, value, partition, offset, timestamp`` from the earliest message on.

    ``{"kafka": servers, "topic": name}`` reads a topic (the connector must be on the
    class path) and fails when offsets are gone that it has not read, unless ``fail_on_data_loss`` is
    false; ``{"files": folder}`` reads the same envelope as JSON lines. ``max_rows``
    or ``max_files`` bounds one micro-batch, MAX_ROWS and MAX_FILES by default; ``min_partitions`` reads a topic's few or
    uneven partitions in more tasks than there are partitions.
    """
    if "kafka" in source:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", source["kafka"])
            .option("subscribe", source["topic"])
            .option("startingOffsets", "earliest")
            .option("failOnDataLoss", str(source.get("fail_on_data_loss", True)).lower())
        )
        reader = reader.option("maxOffsetsPerTrigger", source.get("max_rows", MAX_ROWS))
        if "min_partitions" in source:
            reader = reader.option("minPartitions", source["min_partitions"])
        raw = reader.load()
        return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset", "timestamp")
    reader = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", source.get("max_files", MAX_FILES))
    return reader.json(source["files"])


def to_messages(df: DataFrame, payload: list[str] | None = None, key: str = "device_id") -> DataFrame:
    """Rows as JSON texts keyed by device, so that a broker keeps each device in order.

    Columns outside ``payload`` stay next to the message.
    """
    payload = payload or df.columns
    beside = [c for c in df.columns if c not in payload]
    return df.select(F.col(key).alias("key"), _json(payload).alias("value"), *beside)


def _json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"timestampNTZFormat": PAYLOAD_TIME})


def write_messages(messages: DataFrame, path: str) -> None:
    """Add envelope rows to a folder that ``message_stream`` can follow, as compressed files of at most FILE_ROWS."""
    writer = messages.write.mode("append").option("timestampFormat", ENVELOPE_TIME)
    writer.option("maxRecordsPerFile", FILE_ROWS).json(path, compression="gzip")


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Send keyed messages to a topic and wait for all replicas."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def _parsed(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the parsed ``event``.

    Unfolding a one-element array keeps later filters from being moved below it, where
    each of their conditions would parse the text once more.
    """
    event = F.from_json(
        "value", _event_schema(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return messages.withColumn("event", F.explode(F.array(event)))


def _fields(schema: T.StructType) -> dict[str, Column]:
    """The parsed event's fields. A number in a whole-number field counts if it is whole, also as ``45.0``; else it is NULL."""
    out = {}
    for f in schema.fields:
        value = F.col(f"event.{f.name}")
        if isinstance(f.dataType, (T.IntegerType, T.LongType)):
            number = value.try_cast("decimal(38,9)")
            value = F.when(number == F.floor(number), number.try_cast(f.dataType))
        elif isinstance(f.dataType, T.DoubleType):
            value = no_nan(value)
        out[f.name] = value
    return out


def _malformed() -> Column:
    return F.col("event").isNull() | F.col(f"event.{CORRUPT}").isNotNull()


def _position() -> list[Column]:
    return [F.col("partition").cast("int").alias("kafka_partition"), F.col("offset").cast("long").alias("kafka_offset")]


def decode_telemetry(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Bronze columns plus ``reject_reason``, which is NULL for a usable message.

    Missing fields become NULL, unknown ones are dropped, and an event without a version
    is of the first version.
    """
    event = _fields(PAYLOAD)
    happened = naive_utc(event["event_timestamp"])
    reason = (
        F.when(_malformed(), "malformed_json")
        .when(event["device_id"].isNull(), "missing_device_id")
        .when(event["event_timestamp"].isNull(), "missing_event_timestamp")
        .when(happened.isNull(), "bad_event_timestamp")
    )
    event["event_timestamp"] = happened
    event["schema_version"] = F.coalesce(event["schema_version"], F.lit(FIRST_VERSION))
    now = F.current_timestamp().cast("timestamp_ntz") if ingested_at is None else ingested_at
    return _parsed(messages, PAYLOAD).select(
        *[event[f.name].alias(f.name) for f in PAYLOAD.fields],
        now.alias("ingested_at"),
        *_position(),
        reason.alias("reject_reason"),
        "key",
        "value",
    )


def accepted(decoded: DataFrame, schema: T.StructType = TELEMETRY) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNull()).select(*schema.fieldNames())


def payloads(decoded: DataFrame) -> DataFrame:
    """Usable events with all their fields, known or not."""
    return decoded.filter(F.col("reject_reason").isNull()).withColumn("payload", F.try_parse_json("value"))


def rejected(decoded: DataFrame) -> DataFrame:
    """Messages that are kept aside instead of stopping the stream."""
    return decoded.filter(F.col("reject_reason").isNotNull()).select(
        "reject_reason", "value", "kafka_partition", "kafka_offset", "ingested_at"
    )


def telemetry_view(messages: DataFrame) -> DataFrame:
    """Reader's view across versions: version 2 fields show in version 2 events only."""
    decoded = decode_telemetry(messages)
    is_v2 = F.col("schema_version") == "v2"
    shown = [F.when(is_v2, F.col(c)).alias(c) for c in V2_ONLY]
    return decoded.filter(F.col("reject_reason").isNull()).select(
        F.col("key").alias("device"),
        "kafka_partition",
        "kafka_offset",
        "event_timestamp",
        "temperature_mk",
        "queue_depth",
        "signal_noise_ratio",
        "system_status",
        "schema_version",
        *shown,
    )


def decode_jobs(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Job messages as columns, next to their key and position in the topic, plus ``reject_reason``.

    A message that is no JSON object, or has no job id, is rejected.
    """
    event = _fields(JOB_EVENT)
    reason = F.when(_malformed(), "malformed_json").when(event["job_id"].isNull(), "missing_job_id")
    now = F.current_timestamp().cast("timestamp_ntz") if ingested_at is None else ingested_at
    return _parsed(messages, JOB_EVENT).select(
        F.col("key").alias("device_key"),
        *_position(),
        now.alias("ingested_at"),
        *[event[f.name].alias(f.name) for f in JOB_EVENT.fields],
        reason.alias("reject_reason"),
        "value",
    )
