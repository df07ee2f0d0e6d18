"""Bronze to silver: standardise, deduplicate, validate, and keep only unseen events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fleetlake.functions.numbers import no_nan
from fleetlake.functions.rules import VALID_STATUSES
from fleetlake.functions.text import lower_stripped, upper_stripped
from fleetlake.schemas import EVENT_DATE

REQUIRED = ("device_id", "event_timestamp", "schema_version")

# Broker offsets start again when a topic is recreated, so they do not identify an event.
# The time comes first: sorts compare its eight bytes before they look at the texts.
IDENTITY = ("event_timestamp", "device_id")

# Later copies win; the lineage columns make the order total.
ARRIVAL_ORDER = ("ingested_at", "kafka_partition", "kafka_offset")

# No date that a text with a four-digit year can name is before it.
FIRST_DATE = "0000-01-01"


def _has_required() -> Column:
    """Asked of the columns as they are stored, so that a scan can apply it."""
    return (
        F.col("device_id").isNotNull()
        & F.col("event_timestamp").try_cast("timestamp_ntz").isNotNull()
        & F.col("schema_version").isNotNull()
    )


def standardize_identity(df: DataFrame) -> DataFrame:
    """The two columns that identify an event, as silver has them."""
    return df.withColumns(
        {
            "device_id": upper_stripped(F.col("device_id")),
            "event_timestamp": F.col("event_timestamp").try_cast("timestamp_ntz"),
        }
    )


def standardize(bronze: DataFrame) -> DataFrame:
    """Coerce timestamps, normalise texts and turn NaN readings into NULL. Keeps every row."""
    changed = {
        "event_timestamp": F.col("event_timestamp").try_cast("timestamp_ntz"),
        "ingested_at": F.col("ingested_at").try_cast("timestamp_ntz"),
        "device_id": upper_stripped(F.col("device_id")),
        "system_status": upper_stripped(F.col("system_status")),
        "schema_version": lower_stripped(F.col("schema_version")),
    }
    for field in bronze.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            changed[field.name] = no_nan(F.col(field.name))
    return bronze.withColumns(changed)


def latest_copies(df: DataFrame, identity=IDENTITY, order=ARRIVAL_ORDER) -> DataFrame:
    """The last arrived row of every identity.

    Spark limits each group to one row before the shuffle as well as after it, so an
    event delivered very many times does not gather in one task.
    """
    newest_first = Window.partitionBy(*identity).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("_copy", F.row_number().over(newest_first)).filter("_copy = 1").drop("_copy")


def clean(bronze: DataFrame) -> DataFrame:
    """Valid events, one row per identity.

    The status is checked after deduplication: an event whose last copy is invalid is
    dropped altogether rather than replaced by an older copy.
    """
    complete = standardize(bronze.filter(_has_required()))
    return latest_copies(complete).filter(F.col("system_status").isin(*VALID_STATUSES))


def touched_dates(df: DataFrame, column: str = "event_timestamp") -> DataFrame:
    """The distinct dates of the events of ``df``, as ``event_date``; NULL stands for those without a time."""
    day = F.col(EVENT_DATE) if EVENT_DATE in df.columns else F.to_date(F.col(column).try_cast("timestamp_ntz"))
    return df.select(day.alias(EVENT_DATE)).distinct()


def date_key(date: Column) -> Column:
    """A date that equals itself also where it is NULL."""
    return F.coalesce(date, F.lit(FIRST_DATE).cast("date"))


def on_dates(table: DataFrame, dates: DataFrame | None) -> DataFrame:
    """The rows of an event table on the given dates; all without dates, or without date partitions.

    NULL among the dates asks for the rows without a date. The semi-join prunes partitions when the query
    runs, so one stray date reads one partition more, and no date reaches the driver. There are
    fewer than four million calendar dates, so the broadcast is bounded whatever the data. The
    condition on the first date holds always; it tells the optimizer that the dates select.
    """
    if dates is None or EVENT_DATE not in table.columns:
        return table
    some = dates.select(date_key(F.col(EVENT_DATE)).alias("_date")).distinct()
    some = F.broadcast(some.filter(F.col("_date") >= F.lit(FIRST_DATE).cast("date")))
    return table.join(some, date_key(F.col(EVENT_DATE)) == F.col("_date"), "left_semi").select(table.columns)


def unseen(events: DataFrame, silver: DataFrame, dates: DataFrame | None = None, standard: bool = False) -> DataFrame:
    """Events whose identity is not in silver yet.

    With ``dates`` (see :func:`touched_dates`) the silver side is cut to the batch's date
    partitions, so an incremental run reads as much of silver as its batch touches. Where silver's texts
    are ``standard`` already, as in the lake's table, its columns are compared as they are stored, so that a table
    bucketed by identity is not shuffled.
    """
    seen = on_dates(silver, dates)
    if not standard:
        seen = standardize_identity(seen)
    return events.join(seen.select(*IDENTITY), list(IDENTITY), "left_anti").select(events.columns)


def cleaning_funnel(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """How many rows each cleaning step removes, as one row.

    One pass counts the rows, another one takes the last copy of each identity, limited before the
    shuffle, and compares it with silver in the same partitioning.
    """
    received, missing = F.count(F.lit(1)).alias("received"), F.count_if(~_has_required()).alias("missing_required")
    rows = bronze.agg(F.struct(received, missing).alias("rows"))
    seen = silver.select(*IDENTITY, F.lit(True).alias("_seen"))
    valid = F.coalesce(F.col("system_status").isin(*VALID_STATUSES), F.lit(False))
    in_silver = F.coalesce(F.col("_seen"), F.lit(False))
    last = latest_copies(standardize(bronze.filter(_has_required()))).select(*IDENTITY, "system_status")
    events = last.join(seen, list(IDENTITY), "left").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(~valid).alias("invalid_status"),
        F.count_if(valid).alias("available"),
        F.count_if(valid & in_silver).alias("already_processed"),
        F.count_if(valid & ~in_silver).alias("new_events"),
    )
    return events.withColumn("rows", rows.scalar()).select(
        "rows.received",
        "rows.missing_required",
        (F.col("rows.received") - F.col("rows.missing_required") - F.col("events")).alias("duplicates"),
        "invalid_status",
        "available",
        "already_processed",
        "new_events",
    )
