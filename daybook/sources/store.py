"""Parquet storage for the daily state.

Layout under one root per table (no row-level DML: every batch writes new
partitions, a rerun of the same batch replaces exactly its own partitions):

``<root>/part=closed/batch_date=D/``
    SCD2 rows closed by batch D (``open_only`` mode: closed rows never change,
    so they are written once and never read by later applies).
``<root>/part=open/batch_date=D/``
    The complete open state after batch D.  The next batch reads only the
    newest open partition before its own date and writes a new one, so it
    never overwrites the path it reads.
``<facts>/tx_day=YYYY-MM-DD/``
    Insert-only fact history.  Appends are idempotent because only unseen
    keys are appended.
``<report>/batch_date=D/``
    Report rows of batch D (the folder is overwritten: reruns replace).

Every table is read with its declared schema.  Only a path that isn't there
counts as an empty table; any other read error is raised.  A rerun overwrites
the folders of its batch also where it has no rows for them.

``materialize`` writes an intermediate DataFrame as a table in the shared
checkpoint folder and reads it back: the lineage is cut (executor loss does
not recompute it) and the planner sees its real size, so small dimensions
are broadcast by size and large ones are shuffle-joined.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.constants import CLOSE_OPEN_ONLY
from daybook.operators.facts import unseen
from daybook.operators.scd2 import history_columns, scd2_open_changes, snapshot_rejects
from daybook.schemas import REP_FRAUD
from daybook.session import scratch_path
from daybook.sources.files import delete_path, list_names, move_into, read_or_none, write_folder
from daybook.sources.histories import apply_all_versions
from daybook.sources.warehouse import Warehouse


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` and read it back.

    Without ``path`` a fresh folder under the shared checkpoint folder is used
    (safe while earlier results are still referenced). With ``path`` the
    table is replaced in place: for a pipeline's own working tables that are
    rebuilt every run.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, f"daybook/{name}/{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _log_path(root: str) -> str:
    return f"{root}/_batches"


def applied_batches(spark: SparkSession, root: str) -> DataFrame | None:
    return read_or_none(spark, _log_path(root), "applied_at timestamp, batch_date date")


class DayLog:
    """The days that a stored run has begun and finished, as an appended list of (batch_date, state, seq, files).

    ``files`` are the names of a stream's files that the day has read (null
    in a day run by hand).
    States: ``reset`` (the stores are being emptied), ``begun``, ``done``.  A
    day's last state counts; what precedes the last reset is forgotten.  One
    append per state, a few rows per day of operation.
    """

    SCHEMA = "batch_date date, state string, seq long, files array<string>"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _rows(self) -> list:
        log = read_or_none(self.spark, self.root, self.SCHEMA)
        rows = [] if log is None else sorted(log.collect(), key=lambda r: r["seq"])
        resets = [i for i, r in enumerate(rows) if r["state"] == "reset"]
        return rows[resets[-1]:] if resets else rows

    def days(self) -> dict[_dt.date, str]:
        return {r["batch_date"]: r["state"] for r in self._rows()}

    def files(self) -> dict[_dt.date, set[str]]:
        """Names of the stream's files that each finished day has read."""
        found: dict[_dt.date, set[str]] = {}
        for r in self._rows():
            if r["state"] == "done":
                found.setdefault(r["batch_date"], set()).update(r["files"] or ())
        return found

    def add(self, d: _dt.date, state: str, files: list[str] | None = None) -> None:
        seq = max((r["seq"] for r in self._rows()), default=0) + 1
        self.spark.createDataFrame([(d, state, seq, files)], self.SCHEMA).coalesce(1).write.mode("append").parquet(self.root)

    def begin(self, d: _dt.date) -> None:
        """Refuse a day out of order, before anything of it is written."""
        for day, state in self.days().items():
            if state == "reset":
                raise ValueError(f"the reset for batch {day} was not finished: run it again as the initial load")
            if day != d and state != "done":
                raise ValueError(f"batch {day} was begun and not finished: run it again first")
            if day > d:
                raise ValueError(f"batch {d} is older than the last applied batch {day}")
        self.add(d, "begun")


def batch_dates(spark: SparkSession, root: str) -> list[_dt.date]:
    """Applied batch dates of a store (one small read of its log)."""
    log = applied_batches(spark, root)
    if log is None:
        return []
    return sorted(r["batch_date"] for r in log.select("batch_date").distinct().collect())


def last_batch_before(spark: SparkSession, root: str, d: _dt.date) -> _dt.date | None:
    earlier = [b for b in batch_dates(spark, root) if b < d]
    return earlier[-1] if earlier else None


def last_batch(spark: SparkSession, root: str) -> _dt.date | None:
    dates = batch_dates(spark, root)
    return dates[-1] if dates else None


def _record_batch(spark: SparkSession, root: str, d: _dt.date) -> None:
    write_folder(spark.range(1).select(F.current_timestamp().alias("applied_at")), f"{_log_path(root)}/batch_date={d.isoformat()}")


def _in_order(spark: SparkSession, root: str, d: _dt.date) -> _dt.date | None:
    """The batch that ``d`` builds on; a date before the last applied one is refused."""
    dates = batch_dates(spark, root)
    if dates and d < dates[-1]:
        raise ValueError(f"batch {d} is older than the last applied batch {dates[-1]}")
    earlier = [b for b in dates if b < d]
    return earlier[-1] if earlier else None


class HistoryStore:
    """An SCD2 history table in the open/closed layout (``open_only`` mode)."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], attrs: list[str], empty: DataFrame):
        self.spark, self.root, self.keys, self.attrs = spark, root, keys, attrs
        self.empty = empty.select(*history_columns(keys, attrs))

    def _folder(self, part: str, d: _dt.date) -> str:
        return f"{self.root}/part={part}/batch_date={d.isoformat()}"

    def _open_at(self, d: _dt.date | None) -> DataFrame:
        # An applied batch has its folder, be it empty: a missing one is an error.
        return self.empty if d is None else self.spark.read.schema(self.empty.schema).parquet(self._folder("open", d))

    def open_rows(self, before: _dt.date | None = None) -> DataFrame:
        return self._open_at(last_batch_before(self.spark, self.root, before) if before else last_batch(self.spark, self.root))

    def history(self) -> DataFrame:
        """Closed rows of every batch plus the newest open state."""
        d = last_batch(self.spark, self.root)
        if d is None:
            return self.empty
        closed = self.spark.read.schema(T.StructType([*self.empty.schema, T.StructField("batch_date", T.DateType())]))
        closed = closed.parquet(f"{self.root}/part=closed").filter(F.col("batch_date") <= F.lit(d)).drop("batch_date")
        return closed.unionByName(self._open_at(d))

    def apply(self, snapshot: DataFrame, batch_date: _dt.date, from_col: str | None = None) -> DataFrame:
        """Apply one snapshot; returns the new open rows (read from their folder).

        Rows that ``snapshot_rejects`` sets aside are written to
        ``<root>_rejects/batch_date=D`` (see ``rejects``).
        """
        prev = self._open_at(_in_order(self.spark, self.root, batch_date))
        changes = scd2_open_changes(prev, snapshot, self.keys, self.attrs, batch_date, from_col)
        written = Observation()
        counts = [F.count(F.when(F.col("part") == p, 1)).alias(p) for p in ("open", "closed")]
        (
            changes.observe(written, *counts)
            .withColumn("batch_date", F.lit(batch_date).cast("date"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("part", "batch_date")
            .parquet(self.root)
        )
        # A dynamic overwrite leaves a folder alone for which it has no rows.
        for part, n in written.get.items():
            if not n:
                write_folder(self.empty, self._folder(part, batch_date))
        write_folder(snapshot_rejects(snapshot, self.keys), f"{self.root}_rejects/batch_date={batch_date.isoformat()}")
        _record_batch(self.spark, self.root, batch_date)
        return self._open_at(batch_date)

    def rejects(self, batch_date: _dt.date) -> DataFrame:
        """Snapshot rows of a batch with a NULL key, and all rows of its duplicated keys."""
        return self.spark.read.parquet(f"{self.root}_rejects/batch_date={batch_date.isoformat()}")

    def clear(self) -> None:
        for path in (self.root, f"{self.root}_rejects"):
            delete_path(self.spark, path)

    def prune_open(self, keep: int = 2) -> list[_dt.date]:
        """Empty the open-state partitions older than the newest ``keep``.

        Closed rows are never touched, so ``history()`` is unchanged.  Keeping
        at least two leaves a rerun of the latest batch possible (it reads the
        open state before it).  Each pruned partition is overwritten with an
        empty table of the same schema.  Returns the pruned batch dates.
        """
        if keep < 2:
            raise ValueError("keep at least the latest two open states")
        dates = batch_dates(self.spark, self.root)
        pruned = dates[:-keep]
        for d in pruned:
            write_folder(self.empty, self._folder("open", d))
        return pruned


class VersionedHistoryStore:
    """An SCD2 history in the reference close mode (``all_versions``), as versions that share their untouched buckets.

    Closing restamps every version of a touched key; a batch writes the buckets
    of such keys again, and its version names the folders of all others as they
    are (see ``warehouse``).  A rerun of a date builds on the version before it;
    a date older than the newest version's is refused.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], attrs: list[str], empty: DataFrame, buckets: int = 16):
        self.spark, self.root, self.keys, self.attrs = spark, root, keys, attrs
        schema = empty.select(*history_columns(keys, attrs)).schema
        self.warehouse = Warehouse(spark, root, {"history": schema}, {"buckets": str(buckets)})

    def history(self) -> DataFrame:
        return self.warehouse.read("history")

    def apply(self, snapshot: DataFrame, batch_date: _dt.date, from_col: str | None = None) -> DataFrame:
        """Apply one snapshot; returns the new full history (read from its version)."""
        with self.warehouse.begin(batch_date) as run:
            apply_all_versions(run, "history", snapshot, self.keys, self.attrs, from_col)
        return self.warehouse.read("history", run.manifest.version)

    def clear(self) -> None:
        delete_path(self.spark, self.root)


class FactStore:
    """Insert-only fact history partitioned by day.

    With ``buckets`` the history is a table clustered by the key
    (``CLUSTERED BY key INTO n BUCKETS``, registered in the session catalog
    over ``root``): the daily anti join then reads the stored keys bucket by
    bucket without shuffling them, and only the day's batch is exchanged.
    Without it, the stored key column is shuffled for the join.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: list[str],
        ts_col: str,
        empty: DataFrame,
        buckets: int | None = None,
        table: str | None = None,
    ):
        self.spark, self.root, self.keys, self.ts_col, self.empty = spark, root, keys, ts_col, empty
        self.buckets = buckets
        self.table = table or ("daybook_facts_" + uuid.uuid5(uuid.NAMESPACE_URL, root).hex[:12] if buckets else None)
        if buckets:
            self._ensure_table()

    def _ensure_table(self) -> None:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.empty.schema.fields)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({cols}, tx_day date) USING parquet "
            f"PARTITIONED BY (tx_day) CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.root}'"
        )
        # A catalog that is new, or behind another one, does not know the days stored.
        if read_or_none(self.spark, self.root, self._stored_schema()) is not None:
            self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
            self.spark.catalog.refreshTable(self.table)

    def _stored_schema(self) -> T.StructType:
        return T.StructType([*self.empty.schema, T.StructField("tx_day", T.DateType())])

    def read(self) -> DataFrame:
        if self.table:
            return self.spark.table(self.table).drop("tx_day")
        stored = read_or_none(self.spark, self.root, self._stored_schema())
        return self.empty if stored is None else stored.drop("tx_day")

    def clear(self) -> None:
        if self.table:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        delete_path(self.spark, self.root)
        if self.table:
            self._ensure_table()

    def append_unseen(self, batch: DataFrame) -> None:
        # Appending to the table the anti join reads is safe: the read's file
        # listing is fixed at planning, new files are committed at job end.
        new = unseen(self.read(), batch, self.keys)
        rows = new.select(*self.empty.columns).withColumn("tx_day", F.to_date(self.ts_col))
        if self.table:
            # Dealt by the table's own bucket law: a bucket of a day is one file.
            rows.repartition(self.buckets, *self.keys).write.insertInto(self.table)
        else:
            rows.write.mode("append").partitionBy("tx_day").parquet(self.root)


class ReportStore:
    """Report rows per batch; a rerun replaces the batch's partition (idempotent)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def write(self, rows: DataFrame, batch_date: _dt.date) -> None:
        write_folder(rows.select(*REP_FRAUD.names), f"{self.root}/batch_date={batch_date.isoformat()}")

    def read(self) -> DataFrame:
        schema = T.StructType([*REP_FRAUD, T.StructField("batch_date", T.DateType())])
        return self.spark.read.schema(schema).parquet(self.root)

    def clear(self) -> None:
        delete_path(self.spark, self.root)


__all__ = [
    "CLOSE_OPEN_ONLY", "FactStore", "HistoryStore", "ReportStore", "VersionedHistoryStore",
    "delete_path", "list_names", "materialize", "move_into", "read_or_none", "write_folder",
]
