"""One snapshot applied to a history of a ``Warehouse``, in either close mode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.scd2 import (
    all_versions_added,
    all_versions_changes,
    all_versions_restamped,
    history_columns,
    scd2_open_changes,
    snapshot_rejects,
)
from daybook.sources.warehouse import Run

#: The part with a history's open rows (open-only mode).
OPEN = "open"


def apply_open_only(run: Run, table: str, snapshot: DataFrame, keys: list[str], attrs: list[str], from_col: str | None) -> None:
    """Replaces the part with the open rows and adds one with the rows that this day closes.

    Rejected snapshot rows go to ``<table>_rejects``.
    """
    changes = scd2_open_changes(run.read(table, [OPEN]), snapshot, keys, attrs, run.batch_date, from_col)
    run.put_parts(table, changes, "part", {"open": OPEN, "closed": f"closed {run.batch_date}"})
    run.put(f"{table}_rejects", run.batch_date.isoformat(), snapshot_rejects(snapshot, keys))


def apply_all_versions(run: Run, table: str, snapshot: DataFrame, keys: list[str], attrs: list[str], from_col: str | None) -> None:
    """Writes the buckets of the keys that the snapshot touches again; the others stay as they are.

    The warehouse's option ``buckets`` deals the history by the hash of its key.
    A day without a change writes nothing.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(int(run.warehouse.options["buckets"]))).cast("int")
    changes = run.work(all_versions_changes(run.read(table), snapshot, keys, attrs, from_col), f"{table}_changes")
    touched = {str(r[0]): f"bucket {r[0]}" for r in changes.select(bucket).distinct().collect()}  # at most ``buckets``
    if not touched:
        return
    cols = history_columns(keys, attrs)
    old = all_versions_restamped(run.read(table, touched.values()), changes, keys, run.batch_date)
    new = all_versions_added(changes, keys, attrs, run.batch_date, from_col)
    whole = old.select(*cols).unionByName(new.select(*cols)).withColumn("bucket", bucket)
    # A bucket is dealt to one task and is one file.
    run.put_parts(table, whole.repartition(len(touched), "bucket"), "bucket", touched)
