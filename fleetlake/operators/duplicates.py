"""Inspection of rows that share a broker partition and offset."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POSITION = ("kafka_partition", "kafka_offset")


def duplicate_positions(df: DataFrame) -> DataFrame:
    """Positions held by more than one row, with their likely cause.

    The same event time in all rows points to a replay, different ones to offsets that
    were used again after the topic was recreated.
    """
    one_time = (F.min("event_timestamp") == F.max("event_timestamp")) & (
        F.count("event_timestamp") == F.count(F.lit(1))
    )
    no_time = F.count("event_timestamp") == 0
    cause = F.when(one_time | no_time, "replayed_ingestion").otherwise("offset_reuse")
    return (
        df.groupBy(*POSITION)
        .agg(F.count(F.lit(1)).alias("row_count"), cause.alias("interpretation"))
        .filter("row_count > 1")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """All rows of duplicated positions.

    The positions are found by a pre-aggregated grouping and joined back, so that no task
    has to hold all copies of one position as a window over the position would.
    """
    repeated = duplicate_positions(df).select(*[F.col(c).alias(f"_{c}") for c in POSITION])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in POSITION])
    return df.join(repeated, same, "left_semi")


def duplicate_report(df: DataFrame, top: int | None = None) -> DataFrame:
    """The duplicated rows to read; with ``top`` the first ones in order of position and time.

    All rows together stay unsorted: a total order would gather equal copies in one task.
    """
    rows = duplicate_rows(df).select("device_id", "event_timestamp", "schema_version", *POSITION, "ingested_at")
    return rows if top is None else rows.orderBy(*POSITION, "event_timestamp", "ingested_at").limit(top)


def duplicate_totals(df: DataFrame) -> DataFrame:
    """Number of duplicated positions and of rows involved."""
    return duplicate_positions(df).agg(
        F.count(F.lit(1)).alias("duplicate_pairs"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_involved"),
    )
