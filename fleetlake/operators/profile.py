"""Value counts, crosstabs and table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.rules import VALID_STATUSES


def value_counts(df: DataFrame, column: str, with_null: bool = False) -> DataFrame:
    """Rows per value, most frequent first."""
    if not with_null:
        df = df.filter(F.col(column).isNotNull())
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), column)


def status_crosstab(events: DataFrame) -> DataFrame:
    """Events by device (rows) and status (columns), zero where there are none."""
    counts = [F.count_if(F.col("system_status") == s).alias(s.lower()) for s in VALID_STATUSES]
    return events.groupBy("device_id").agg(*counts)


def profile(df: DataFrame, columns: tuple[str, ...] = ("schema_version", "system_status", "device_id")) -> DataFrame:
    """Total rows and the value counts of several columns, NULL included, in one pass."""
    sets = [[], *[[c] for c in columns]]
    held = F.lit("rows")
    value = F.lit(None).cast("string")
    for c in columns:
        grouped = F.grouping(c) == 0
        held = F.when(grouped, c).otherwise(held)
        value = F.when(grouped, F.col(c).cast("string")).otherwise(value)
    return df.groupingSets(sets, *columns).agg(
        held.alias("section"), value.alias("value"), F.count(F.lit(1)).alias("row_count")
    ).select("section", "value", "row_count")


def head(df: DataFrame, rows: int = 10) -> DataFrame:
    """A few rows to look at."""
    return df.limit(rows)


def lineage_sample(df: DataFrame, rows: int = 10) -> DataFrame:
    wanted = ("device_id", "kafka_partition", "kafka_offset", "ingested_at")
    return df.select(*[c for c in wanted if c in df.columns]).limit(rows)


def column_total(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(column).alias("total"))
