"""Time series: running totals, and gaps in a device's readings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlake.functions.times import elapsed_days, from_micros, micros
from fleetlake.operators.cleaning import on_dates, touched_dates
from fleetlake.schemas import EVENT_DATE

HOURS_PER_READING = 0.25
SLOT_MINUTES = 15
SLICE = "hour"
DAY_MICROS = 86_400_000_000


def running_total(
    df: DataFrame,
    value: Column,
    name: str,
    entity: str | tuple[str, ...] = "device_id",
    order: tuple[str, ...] = ("event_timestamp",),
) -> DataFrame:
    """Running sum of ``value`` per entity in time order.

    A window over a whole entity would put all its rows into one task. Here the window
    runs within the hours of the first order column, and the sum of an entity's earlier hours is
    added to it; that carry has one row per entity and hour. ``order`` is unique per
    entity, as event times are in silver.
    """
    entity = (entity,) if isinstance(entity, str) else entity
    sliced = df.withColumn("_slice", F.date_trunc(SLICE, order[0])).withColumn("_value", value)
    so_far = (
        Window.partitionBy(*entity, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.partitionBy(*entity).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        sliced.groupBy(*entity, "_slice")
        .agg(F.sum("_value").alias("_sum"))
        .select(*entity, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carry"))
    )
    return (
        sliced.withColumn("_sum", F.sum("_value").over(so_far))
        .join(carry, [*entity, "_slice"])
        .withColumn(name, F.col("_sum") + F.col("_carry"))
        .select(*df.columns, name)
    )


def uptime_hours(events: DataFrame, start: float = 0.0) -> DataFrame:
    """Uptime that grows by a quarter of an hour with every reading."""
    grown = running_total(events, F.lit(HOURS_PER_READING), "uptime_hours")
    return grown.withColumn("uptime_hours", F.round(F.col("uptime_hours") + start, 2))


def uptime_of_dates(events: DataFrame, daily: DataFrame, start: float = 0.0) -> DataFrame:
    """As :func:`uptime_hours` of all events, for whole dates of them: what came before is taken from daily counts.

    ``daily`` has ``device_id, event_date, total_events`` for every device and date, one row each.
    """
    date = F.to_date("event_timestamp")
    earlier = Window.partitionBy("device_id").orderBy(EVENT_DATE).rowsBetween(Window.unboundedPreceding, -1)
    carry = daily.select("device_id", EVENT_DATE, F.coalesce(F.sum("total_events").over(earlier), F.lit(0)).alias("_before"))
    grown = running_total(events.withColumn("_date", date), F.lit(1), "_readings", order=("event_timestamp",), entity=("device_id", "_date"))
    carry = carry.withColumnRenamed(EVENT_DATE, "_date")
    total = F.round((F.col("_before") + F.col("_readings")) * HOURS_PER_READING + start, 2)
    return grown.join(carry, ["device_id", "_date"]).select(*events.columns, total.alias("uptime_hours"))


def gaps_ending_on(events: DataFrame, daily: DataFrame, step_minutes: int = SLOT_MINUTES) -> DataFrame:
    """The :func:`missing_slots` of all events that end on the dates of ``events``, which are whole dates of them.

    ``daily`` has ``device_id, event_date, first_event_timestamp, latest_event_timestamp`` for every device and date; it
    tells when a device was heard of before a date. Stretches behind a device's last slot end on no date.
    """
    step = step_minutes * 60_000_000
    day, slot = F.to_date("event_timestamp").alias("day"), _slot(F.col("event_timestamp"), step).alias("slot")
    occupied = events.groupBy("device_id", day, slot).agg(F.lit(1).alias("_one"))
    within = Window.partitionBy("device_id", "day").orderBy("slot")
    inner = occupied.select("device_id", F.lag("slot").over(within).alias("before"), F.col("slot").alias("after"))
    by_day = Window.partitionBy("device_id").orderBy(EVENT_DATE)
    last = F.lag(_slot(F.col("latest_event_timestamp"), step)).over(by_day)
    days = daily.select("device_id", EVENT_DATE, last.alias("before"), _slot(F.col("first_event_timestamp"), step).alias("after"))
    between = on_dates(days, touched_dates(events)).select("device_id", "before", "after")
    return _stretches(inner.unionByName(between), step)


def _slot(time: Column, step: int) -> Column:
    return F.floor(micros(time) / step).cast("long")


def missing_slots(
    events: DataFrame,
    step_minutes: int = SLOT_MINUTES,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """The stretches in which a device that has events sent nothing, one row each.

    Time is cut into slots of ``step_minutes`` from midnight on, so the step divides a day. A stretch reaches from ``gap_start``
    to before ``gap_end``, with ``missing_slots`` empty slots and ``gap_days`` days. Stretches before
    a device's first slot and behind its last count from ``start`` to before ``end``; by default these are the first and
    last slot of all devices.

    No slot is made up: occupied slots are compared with the one before within a device's day,
    and days with the day before, of which there is one row per device and day.
    """
    step = step_minutes * 60_000_000
    slot = _slot(F.col("event_timestamp"), step)
    occupied = events.groupBy("device_id", slot.alias("slot")).agg(F.lit(1).alias("_one"))
    day = F.floor(F.col("slot") * step / DAY_MICROS).alias("day")
    occupied = occupied.select("device_id", day, "slot")
    within = Window.partitionBy("device_id", "day").orderBy("slot")
    inner = occupied.select("device_id", F.lag("slot").over(within).alias("before"), F.col("slot").alias("after"))
    days = occupied.groupBy("device_id", "day").agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    by_day = Window.partitionBy("device_id").orderBy("day")
    between = days.select("device_id", F.lag("last").over(by_day).alias("before"), F.col("first").alias("after"))
    span = days.agg(F.struct(F.min("first").alias("low"), F.max("last").alias("high")).alias("span")).scalar()
    low = F.col("span.low") if start is None else _slot(F.lit(start).cast("timestamp_ntz"), step)
    high = F.col("span.high") if end is None else _slot(F.lit(end).cast("timestamp_ntz"), step) - 1
    ends = days.groupBy("device_id").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    outer = ends.withColumn("span", span).select(
        "device_id",
        F.inline(
            F.array(
                F.struct((low - 1).alias("before"), F.col("first").alias("after")),
                F.struct(F.col("last").alias("before"), (high + 1).alias("after")),
            )
        ),
    )
    return _stretches(inner.unionByName(between).unionByName(outer), step)


def _stretches(neighbours: DataFrame, step: int) -> DataFrame:
    """What lies between neighbouring occupied slots, where there is something."""
    began, ended = from_micros((F.col("before") + 1) * step), from_micros(F.col("after") * step)
    return neighbours.filter(F.col("after") - F.col("before") > 1).select(
        "device_id",
        began.alias("gap_start"),
        ended.alias("gap_end"),
        (F.col("after") - F.col("before") - 1).alias("missing_slots"),
        elapsed_days(began, ended).alias("gap_days"),
    )


def gap_summary(
    events: DataFrame,
    step_minutes: int = SLOT_MINUTES,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    return (
        missing_slots(events, step_minutes, start, end)
        .groupBy("device_id")
        .agg(
            F.count(F.lit(1)).alias("gaps"),
            F.sum("missing_slots").alias("missing_slots"),
            F.min("gap_start").alias("first_gap_start"),
            F.max("gap_end").alias("last_gap_end"),
        )
    )
