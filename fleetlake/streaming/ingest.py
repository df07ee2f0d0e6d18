"""Streaming: messages to bronze, and bronze to silver and incidents.

Every query takes its messages in bounded micro-batches, decodes each message once, and keeps those it
cannot use in ``bronze.rejected``. A micro-batch that runs again takes the place of its first
run, or finds its events already there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlake.operators.cleaning import clean, touched_dates, unseen
from fleetlake.operators.incidents import absent, detect, opened
from fleetlake.plans.pipeline import refresh_incident_summary, utc_now
from fleetlake.schemas import JOBS, STREAM_BATCHES
from fleetlake.sources.messages import accepted, decode_jobs, decode_telemetry, message_stream, payloads, rejected
from fleetlake.sources.tables import Lake

#: What a stream does with a decoded micro-batch; returns how many rows its table took.
Step = Callable[[Lake, DataFrame, str], int]


def _start(
    lake: Lake,
    stream: str,
    source: dict,
    decode: Callable[[DataFrame], DataFrame],
    step: Step,
    checkpoint: str,
    follow: bool,
) -> StreamingQuery:
    """Run ``step`` on every decoded micro-batch, after keeping its rejected messages, and note what became of it.

    The notes of a batch take the place of those of an earlier attempt; messages are counted while the rejected
    ones are written.
    """
    name = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex

    def each(decoded: DataFrame, number: int) -> None:
        # The micro-batch runs in a session of its own, through which it must see the lake.
        started = utc_now()
        decoded.persist()
        try:
            own, batch = lake.within(decoded.sparkSession), f"{name}-{number}"
            seen = Observation()
            counted = decoded.observe(seen, F.count(F.lit(1)).alias("messages"))
            aside = own.append_messages("bronze.rejected", rejected(counted), batch)
            taken, messages = step(own, decoded, batch), seen.get["messages"]
            row = (stream, number, messages, aside, taken, messages - aside - taken, started, utc_now())
            noted = own.spark.createDataFrame([row], STREAM_BATCHES)
            own.append_messages("ops.stream_batches", noted, batch)
        finally:
            decoded.unpersist()

    batches = decode(message_stream(lake.spark, source))
    writer = batches.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer if follow else writer.trigger(availableNow=True)).start()


def ingest_bronze(
    lake: Lake, source: dict, checkpoint: str, follow: bool = False, whole: bool = False
) -> StreamingQuery:
    """Telemetry messages into the bronze table; without ``follow`` the query drains what is there and stops.

    With ``whole`` events are also kept with all their fields, for columns that are added later.
    """

    def step(own: Lake, decoded: DataFrame, batch: str) -> int:
        if whole:
            own.append_messages("ops.payloads", payloads(decoded), batch)
        return own.append_events("bronze.telemetry", accepted(decoded), batch)

    return _start(lake, "bronze", source, decode_telemetry, step, checkpoint, follow)


def ingest_jobs(lake: Lake, source: dict, checkpoint: str, follow: bool = False) -> StreamingQuery:
    """Job messages into ``bronze.jobs``."""

    def step(own: Lake, decoded: DataFrame, batch: str) -> int:
        return own.append_messages("bronze.jobs", accepted(decoded, JOBS), batch)

    return _start(lake, "jobs", source, decode_jobs, step, checkpoint, follow)


def new_events(lake: Lake, bronze: DataFrame) -> DataFrame:
    """The cleaned events of a batch that silver lacks; none if the batch was delivered or retried again."""
    return unseen(clean(bronze), lake.read("silver.telemetry"), touched_dates(bronze), standard=True)


def add_to_silver(lake: Lake, bronze: DataFrame) -> int:
    """Clean a batch and append the events silver lacks; returns their number."""
    return lake.append_events("silver.telemetry", new_events(lake, bronze), placed=True)


def add_incidents(lake: Lake, events: DataFrame, detected_at: datetime) -> None:
    """Insert the incidents of a batch of events that are not recorded yet, and renew the daily summaries of its dates."""
    dates = touched_dates(events)
    new_ones = absent(detect(events), lake.read("ops.incidents"), dates)
    lake.append_events("ops.incidents", opened(new_ones, detected_at), placed=True)
    refresh_incident_summary(lake, dates)


def stream_silver(
    lake: Lake, source: dict, checkpoint: str, ingested_at: Column | None = None, follow: bool = False
) -> StreamingQuery:
    """Telemetry messages to silver, micro-batch by micro-batch.

    ``ingested_at`` may name the message's own time instead of the time of reading.
    """

    def step(own: Lake, decoded: DataFrame, batch: str) -> int:
        return add_to_silver(own, accepted(decoded))

    return _start(lake, "silver", source, lambda m: decode_telemetry(m, ingested_at), step, checkpoint, follow)


def stream_incidents(
    lake: Lake,
    source: dict,
    checkpoint: str,
    detected_at: datetime | None = None,
    ingested_at: Column | None = None,
    follow: bool = False,
) -> StreamingQuery:
    """Telemetry messages to silver and to the incidents of the events that silver lacked.

    A batch is cleaned and compared with silver once; its new events are held, and both tables are filled from
    them: computed again, after a lost executor, they are the same, as silver's files are those of the comparison. Incidents go first: if the batch fails in between, its next run finds them there and adds the events.
    """

    def step(own: Lake, decoded: DataFrame, batch: str) -> int:
        events = new_events(own, accepted(decoded)).persist()
        try:
            add_incidents(own, events, detected_at or utc_now())
            return own.append_events("silver.telemetry", events, placed=True)
        finally:
            events.unpersist()

    return _start(lake, "incidents", source, lambda m: decode_telemetry(m, ingested_at), step, checkpoint, follow)
