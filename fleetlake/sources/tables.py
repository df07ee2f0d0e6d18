"""Lakehouse tables: creation, schema evolution, appends, replacement and keyed merges."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake import schemas
from fleetlake.functions.numbers import no_nan
from fleetlake.operators.cleaning import IDENTITY, date_key, on_dates
from fleetlake.schemas import BATCH, BUCKET, DAY, EVENT_DATE
from fleetlake.session import kept, use_utc

# Tables that grow are partitioned by the event's date, so that incremental work reads
# the dates it touches; the others hold current state.
EVENT_TABLES = {
    "bronze.telemetry": schemas.TELEMETRY,
    "silver.telemetry": schemas.TELEMETRY,
    "ops.incidents": schemas.INCIDENTS,
    "ops.quarantine": schemas.QUARANTINE,
    "gold.device_health_daily": schemas.DEVICE_HEALTH_DAILY,
    "gold.incident_daily": schemas.INCIDENT_DAILY,
}
STATE_TABLES = {
    "gold.device_health": schemas.DEVICE_HEALTH,
    "ops.devices": schemas.DEVICES,
    "ops.device_health_current": schemas.DEVICE_HEALTH_CURRENT,
    "ops.pipeline_runs": schemas.PIPELINE_RUNS,
}
MESSAGE_TABLES = {
    "bronze.jobs": schemas.JOBS,
    "bronze.rejected": schemas.REJECTED,
    "ops.payloads": schemas.PAYLOADS,
    "ops.stream_batches": schemas.STREAM_BATCHES,
}
LEDGER_TABLES = {"ops.batches": schemas.BATCHES, "ops.batches_done": schemas.BATCHES_DONE}
NAMESPACES = ("bronze", "silver", "gold", "ops")

# Tables that also have the batch of each row as a partition, so that a batch that is written again
# takes its own place.
BATCHED = ("bronze.telemetry", *MESSAGE_TABLES)

# Tables of messages that are read by the dates of their events.
DATED = ("ops.payloads",)

# Tables whose mandatory columns are enforced. Bronze keeps incomplete events, which the checks count.
ENFORCED = ("silver.telemetry", "ops.incidents")

# Tables whose batches are noted in the ledger.
LEDGERED = ("bronze.telemetry",)

# Tables that keep each key in one bucket, so that looking for keys does not shuffle them. Files are sorted by
# device, so that a device's rows stand in few row groups.
BUCKETED = {"silver.telemetry": IDENTITY, "ops.incidents": ("event_key",)}
SORTED = ("device_id", "event_timestamp")
# Columns with Bloom filters in every row group.
LOOKED_UP = {"silver.telemetry": ("device_id",), "ops.incidents": ("device_id", "event_key")}
# A filter is of the smallest of FILTER_SIZES, each half the one before it, that holds the row group's values; the first has
# the one megabyte that every filter would have otherwise, however few rows a file of one date and bucket has.
FILTER_SIZES = 10

# State tables that are merged bucket by bucket, with their keys.
MERGED = {"ops.devices": "device_id", "ops.device_health_current": "device_id"}

# How the state of a batch is named in the ledger.
STARTED, COMMITTED, CLOSED = "STARTED", "COMMITTED", "CLOSED"

# Folders of replaced contents are kept this long, for readers that still hold them.
KEEP_REPLACED_HOURS = 24


def conform(df: DataFrame, schema: T.StructType, enforce: bool = False) -> DataFrame:
    """Exactly the columns of ``schema``, in order and type.

    Absent columns become NULL, extra ones are dropped, values that do not fit become
    NULL, and so does NaN. With ``enforce`` a NULL in a mandatory column ends the query.
    """
    out = []
    for field in schema.fields:
        if field.name in df.columns:
            value = F.col(field.name).try_cast(field.dataType)
            if isinstance(field.dataType, T.DoubleType):
                value = no_nan(value)
        else:
            value = F.lit(None).cast(field.dataType)
        if enforce and not field.nullable:
            failure = F.raise_error(F.lit(f"{field.name} must not be NULL")).cast(field.dataType)
            value = F.coalesce(value, failure)
        out.append(value.alias(field.name))
    return df.select(*out)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str],
    stamps: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows of ``target`` with ``source`` merged in; ``source`` has one row per key.

    Columns in ``update`` are taken from a matching source row, ``stamps`` are set on
    every row the source touches, other columns keep the target's value, and target rows
    without a source row stay as they are.
    """
    stamps = stamps or {}
    new = source.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in source.columns if c != key])
    joined = target.join(new, F.col(key) == F.col("_key"), "full_outer")
    touched = F.col("_key").isNotNull()
    inserted = F.col(key).isNull()
    out = []
    for c in target.columns:
        if c == key:
            value = F.coalesce(F.col(key), F.col("_key"))
        elif c in stamps:
            value = F.when(touched, stamps[c]).otherwise(F.col(c))
        elif c in update:
            value = F.when(touched, F.col(f"_new_{c}")).otherwise(F.col(c))
        elif c in source.columns:
            value = F.when(inserted, F.col(f"_new_{c}")).otherwise(F.col(c))
        else:
            value = F.col(c)
        out.append(value.alias(c))
    return joined.select(*out)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while they are written.

    Used on the last step only: its tasks report once each, whereas a lost shuffle task
    that runs again would count its rows twice. Of event tables the dates are noted as well.
    """
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if EVENT_DATE in df.columns:
        metrics += [F.collect_set(EVENT_DATE).alias("dates"), F.count_if(F.col(EVENT_DATE).isNull()).alias("undated")]
    return df.observe(seen, *metrics), seen


def _dates(seen: Observation) -> set[date | None]:
    """The dates of the rows that were counted, None for rows without one."""
    return {*seen.get["dates"], *([None] if seen.get["undated"] else [])}


class Lake:
    """The catalog tables below one root folder.

    ``prefix`` keeps several lakes apart within one catalog. ``buckets`` is fixed when the tables are created: a
    date of silver has so many files, and as many as there are shuffle partitions save a shuffle of new events.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", buckets: int = 8):
        self.spark = use_utc(spark)
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.buckets = buckets

    def within(self, spark: SparkSession) -> Lake:
        """The same lake seen from another session."""
        return Lake(spark, self.root, self.prefix, self.buckets)

    def name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def create_namespaces(self) -> None:
        for namespace in NAMESPACES:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.prefix}{namespace} LOCATION '{self.root}/{namespace}'"
            )

    def create_table(self, table: str, schema: T.StructType) -> None:
        """Create the table unless it exists.

        Event tables get an ``event_date`` partition, batched ones a ``batch``, the ledger a ``day``, and tables merged by
        key a ``bucket``. Overwriting replaces the partitions that the new rows have, and no others.
        """
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields]
        parts = {EVENT_DATE: ("date", table in EVENT_TABLES or table in DATED), BATCH: ("string", table in BATCHED)}
        parts |= {DAY: ("date", table in LEDGER_TABLES), BUCKET: ("int", table in MERGED)}
        parts = {name: kind for name, (kind, wanted) in parts.items() if wanted}
        columns += [f"{name} {kind}" for name, kind in parts.items()]
        options = ["partitionOverwriteMode 'dynamic'"]
        options += [f"'parquet.bloom.filter.enabled#{c}' 'true'" for c in LOOKED_UP.get(table, ())]
        if table in LOOKED_UP:
            options.append("'parquet.bloom.filter.adaptive.enabled' 'true'")
            options += [f"'parquet.bloom.filter.candidates.number#{c}' '{FILTER_SIZES}'" for c in LOOKED_UP[table]]
        layout = f"PARTITIONED BY ({', '.join(parts)}) " if parts else ""
        if table in BUCKETED:
            layout += f"CLUSTERED BY ({', '.join(BUCKETED[table])}) SORTED BY ({', '.join(SORTED)}) INTO {self.buckets} BUCKETS "
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({', '.join(columns)}) USING parquet "
            f"OPTIONS ({', '.join(options)}) {layout}LOCATION '{self._folder(table)}'"
        )

    def create_all(self) -> Lake:
        self.create_namespaces()
        for table, schema in {**EVENT_TABLES, **STATE_TABLES, **MESSAGE_TABLES, **LEDGER_TABLES}.items():
            self.create_table(table, schema)
        return self

    def add_missing_columns(self, table: str, schema: T.StructType) -> list[str]:
        """Add the columns the table lacks; running it again changes nothing."""
        present = set(self.spark.table(self.name(table)).columns)
        missing = [f for f in schema.fields if f.name not in present]
        if missing:
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in missing)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({columns})")
        return [f.name for f in missing]

    def drop_table(self, table: str) -> bool:
        """Drop the table if it is there; tells whether it was."""
        there = self.spark.catalog.tableExists(self.name(table))
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        return there

    def list_tables(self, namespace: str) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(f"{self.prefix}{namespace}") if not t.isTemporary)

    def read(self, table: str) -> DataFrame:
        name = self.name(table)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def schema_of(self, table: str) -> T.StructType:
        """An event table's declared columns, then those that were added to it."""
        declared, partitions = EVENT_TABLES[table], (EVENT_DATE, BATCH)
        there = self.spark.table(self.name(table)).schema.fields
        return T.StructType(declared.fields + [f for f in there if f.name not in (*declared.fieldNames(), *partitions)])

    def append_events(self, table: str, df: DataFrame, batch: str | None = None, placed: bool = False) -> int:
        """Append to an event table, by date; returns the number of rows.

        In a batched table the rows of a ``batch`` that was written before are replaced, so that
        a repeated micro-batch adds nothing, and the ledger notes the write.

        In a bucketed table a task writes one bucket of all dates; rows that come from a join with the table
        are ``placed`` so already. Elsewhere ``REBALANCE`` lets adaptive execution split a date that holds a large
        share of the rows over several files and merge small ones, so neither one task nor many tiny
        files result. Rows are ordered within files only.
        """
        conformed = conform(df, self.schema_of(table), enforce=table in ENFORCED)
        conformed = conformed.withColumn(EVENT_DATE, F.to_date("event_timestamp"))
        if table in BUCKETED:
            spread = conformed if placed else conformed.repartition(self.buckets, *BUCKETED[table])
        else:
            spread = conformed.hint("rebalance", EVENT_DATE).sortWithinPartitions(EVENT_DATE, "event_timestamp", "device_id")
        rows, seen = _counted(spread)
        if table in LEDGERED:
            self._write_noted(table, rows, seen, batch)
        else:
            self._insert(table, rows, batch or uuid.uuid4().hex)
        return seen.get["rows"]

    def append_messages(self, table: str, df: DataFrame, batch: str | None = None) -> int:
        """Append to a table of messages; returns the number of rows. Those of a ``batch`` written before are replaced."""
        rows = conform(df, MESSAGE_TABLES[table])
        if table in DATED:
            rows = rows.withColumn(EVENT_DATE, F.to_date("event_timestamp")).hint("rebalance", EVENT_DATE)
        rows, seen = _counted(rows)
        self._insert(table, rows, batch or uuid.uuid4().hex)
        return seen.get["rows"]

    def _insert(self, table: str, rows: DataFrame, batch: str) -> None:
        if table in BATCHED:
            rows = rows.withColumn(BATCH, F.lit(batch))
        rows.write.insertInto(self.name(table), overwrite=table in BATCHED)

    # The ledger: one line when the write of a batch begins, one for each date it left, and one when it ended.

    def _write_noted(self, table: str, rows: DataFrame, seen: Observation, batch: str | None) -> None:
        new, commit = batch is None, uuid.uuid4().hex
        batch = batch or uuid.uuid4().hex
        self._note(self._line(batch, commit, STARTED))
        self._insert(table, rows, batch)
        if not new:
            # dates that an earlier write of the batch had and this one lacks are not overwritten
            lines = self.read("ops.batches").filter((F.col("batch") == batch) & (F.col("state") == COMMITTED))
            had = {row.batch_date for row in lines.select("batch_date").distinct().collect()}  # of one batch
            self._drop_partitions(table, [{EVENT_DATE: day, BATCH: batch} for day in had - _dates(seen)])
        self._note_closed(table, batch, commit)

    def _line(self, batch: str, commit: str, state: str) -> DataFrame:
        return conform(self.spark.range(1).select(
            F.lit(batch).alias("batch"), F.lit(commit).alias("commit_id"), F.lit(state).alias("state")
        ), schemas.BATCHES)

    def _note(self, lines: DataFrame, table: str = "ops.batches") -> None:
        now = F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
        stamped = conform(lines.withColumn("noted_at", now), LEDGER_TABLES[table])
        stamped.withColumn(DAY, F.to_date("noted_at")).coalesce(1).write.insertInto(self.name(table))

    def _note_closed(self, table: str, batch: str, commit: str) -> None:
        """The dates that the batch has now, counted where they lie, and that its write has ended, in one write."""
        counted = (
            self.read(table)
            .filter(F.col(BATCH) == batch)
            .groupBy(F.col(EVENT_DATE).alias("batch_date"))
            .agg(F.count(F.lit(1)).alias("row_count"), F.max("event_timestamp").alias("latest_event"))
            .withColumns({"batch": F.lit(batch), "commit_id": F.lit(commit), "state": F.lit(COMMITTED)})
        )
        self._note(conform(counted, schemas.BATCHES).unionByName(self._line(batch, commit, CLOSED)))

    def pending_dates(self) -> DataFrame:
        """``commit_id, event_date`` of bronze's writes that no successful run has taken; only the ledger is read.

        A write that began and did not end, as its application died, may have left rows: the dates of
        its batch are pending, without a commit, until the batch is written again or :meth:`close_batch` is called.
        """
        lines, done = self.read("ops.batches"), self.read("ops.batches_done")
        key = date_key(F.col("batch_date")).alias("_date")
        committed = lines.filter(F.col("state") == COMMITTED).select("commit_id", "batch_date", key)
        left = committed.join(done.select("commit_id", key), ["commit_id", "_date"], "left_anti")
        left = left.select("commit_id", F.col("batch_date").alias(EVENT_DATE))
        dead = self.open_batches()
        if dead.isEmpty():
            return left
        bronze = self.read(LEDGERED[0]).select(EVENT_DATE, BATCH)
        found = bronze.join(F.broadcast(dead), BATCH, "left_semi").select(EVENT_DATE).distinct()
        return left.unionByName(found.select(F.lit(None).cast("string").alias("commit_id"), EVENT_DATE))

    def open_batches(self) -> DataFrame:
        """``batch``: those whose last write began and has not ended, as many as writes that run or died."""
        at = [F.max(F.when(F.col("state") == s, F.col("noted_at"))).alias(s) for s in (STARTED, CLOSED)]
        last = self.read("ops.batches").filter(F.col("state") != COMMITTED).groupBy("batch").agg(*at)
        return last.filter(F.col(CLOSED).isNull() | (F.col(CLOSED) < F.col(STARTED))).select("batch")

    def close_batch(self, batch: str) -> None:
        """Note what the batch has in bronze as a write that ended, after the application that wrote it died."""
        self._note_closed(LEDGERED[0], batch, uuid.uuid4().hex)

    def mark_done(self, taken: DataFrame) -> None:
        """Note that a run has taken these :meth:`pending_dates`."""
        ended = taken.filter(F.col("commit_id").isNotNull())
        self._note(ended.select("commit_id", F.col(EVENT_DATE).alias("batch_date")), "ops.batches_done")

    def latest_event(self) -> datetime | None:
        """The latest event time in all of bronze, from the last write of each batch; None if none is noted."""
        lines = self.read("ops.batches")
        closed = lines.filter(F.col("state") == CLOSED).groupBy("batch").agg(
            F.max_by("commit_id", F.struct("noted_at", "commit_id")).alias("commit_id")
        )
        last = lines.filter(F.col("state") == COMMITTED).join(closed, ["batch", "commit_id"], "left_semi")
        return last.agg(F.max("latest_event")).first()[0]

    def compact_ledger(self, before: date) -> None:
        """Put each day of the ledger before ``before``, which no write adds to any more, into one file."""
        for table in LEDGER_TABLES:
            old = self.read(table).filter(F.col(DAY) < F.lit(before).cast("date"))
            kept(old).repartition(DAY).write.insertInto(self.name(table), overwrite=True)

    # Partitions.

    def dates_of(self, table: str) -> DataFrame:
        """``event_date`` of the partitions that the catalog lists; no file is opened."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}")
        day = F.regexp_extract("partition", rf"^{EVENT_DATE}=([^/]*)", 1).try_cast("date")
        return listed.select(day.alias(EVENT_DATE)).distinct()

    def _drop_partitions(self, table: str, specs: list[dict]) -> None:
        """Take partitions out of the catalog, then remove their folders."""
        if not specs:
            return
        jvm = self.spark._jvm
        listed = []
        for spec in specs:
            values = {k: "null" if v is None else f"'{v}'" for k, v in spec.items()}
            listed.append("PARTITION (" + ", ".join(f"{k} = {v}" for k, v in values.items()) + ")")
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {', '.join(listed)}")
        for spec in specs:
            parts = [f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in spec.items()]
            path = jvm.org.apache.hadoop.fs.Path("/".join([self._folder(table), *parts]))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.spark.catalog.refreshTable(self.name(table))

    def replace_dates(self, table: str, df: DataFrame, cleared: DataFrame | None = None) -> None:
        """Put the dates that ``df`` has in place of the table's; other dates stay.

        Of the dates ``cleared`` those that ``df`` lacks become empty.
        """
        rows = df.select(*self.schema_of(table).fieldNames(), EVENT_DATE)
        if table in BUCKETED:
            rows = rows.repartition(self.buckets, *BUCKETED[table])
        else:
            rows = rows.hint("rebalance", EVENT_DATE)
        spread, seen = _counted(rows)
        spread.write.insertInto(self.name(table), overwrite=True)
        if cleared is not None:
            there = on_dates(self.dates_of(table), cleared).collect()  # calendar dates
            empty = {row[EVENT_DATE] for row in there} - _dates(seen)
            self._drop_partitions(table, [{EVENT_DATE: day} for day in empty])

    def compact_dates(self, table: str, dates: DataFrame) -> None:
        """Write the table's rows on these dates anew, in as few files as its layout allows; micro-batches leave many."""
        self.replace_dates(table, kept(on_dates(self.read(table), dates)))

    def append_rows(self, table: str, df: DataFrame) -> None:
        conform(df, STATE_TABLES[table]).write.mode("append").insertInto(self.name(table))

    def upsert(
        self, table: str, source: DataFrame, update: Sequence[str], stamps: dict[str, Column] | None = None
    ) -> None:
        """Merge rows into a table that is kept by buckets of its key (see :func:`merge_upsert`).

        Only buckets that ``source`` has keys of are read and written anew; they are replaced one after the other.
        """
        key = MERGED[table]
        bucket = F.pmod(F.hash(key), F.lit(self.buckets)).cast("int").alias(BUCKET)
        source = kept(source)
        touched = F.broadcast(source.select(bucket).distinct())  # at most as many as buckets
        target = self.read(table).join(touched, BUCKET, "left_semi").drop(BUCKET)
        merged = kept(conform(merge_upsert(target, source, key, update, stamps), STATE_TABLES[table]).select("*", bucket))
        merged.repartition(self.buckets, BUCKET).write.insertInto(self.name(table), overwrite=True)

    def replace(self, table: str, df: DataFrame) -> int:
        """Put new contents in place of the old, also when they were computed from the old.

        The rows go to a new folder and the table is then pointed to it, so readers see
        one state or the other, and a failed write leaves the old one. Folders that were
        replaced more than KEEP_REPLACED_HOURS ago are removed.
        """
        folder = f"{self._folder(table)}-{uuid.uuid4().hex}"
        rows, seen = _counted(conform(df, STATE_TABLES[table]))
        rows.write.parquet(folder)
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{folder}'")
        self.spark.catalog.refreshTable(self.name(table))
        self._remove_replaced(table, folder)
        return seen.get["rows"]

    def _remove_replaced(self, table: str, current: str) -> None:
        """Remove the table's earlier folders, by their names and age."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(current).getFileSystem(self.spark._jsc.hadoopConfiguration())
        oldest = (time.time() - KEEP_REPLACED_HOURS * 3600) * 1000
        for status in fs.globStatus(path(f"{self._folder(table)}-{'[0-9a-f]' * 32}")):
            if status.getModificationTime() < oldest and status.getPath().getName() != path(current).getName():
                fs.delete(status.getPath(), True)
