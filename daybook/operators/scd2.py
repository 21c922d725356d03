"""Type-2 slowly changing dimensions: current state and daily apply.

History rows carry ``effective_from``, ``effective_to`` and ``deleted_flg``;
an open row has ``effective_to`` = 2999-12-31 00:00:00, and rows closed by a
batch end at batch_date - 1 second.

Two close modes:

``all_versions`` (the reference behaviour)
    Every version of a changed or deleted key is restamped, closed rows and
    old tombstones included; a tombstone stays open when its key returns;
    attributes are compared with ``<>`` (a change to or from NULL is unseen);
    NULL and duplicate snapshot keys flow through unchanged.

``open_only`` (the documented intent, the default)
    Only open rows are closed, so validity periods of a key never overlap
    and closed rows are immutable (storage can append them and rewrite only
    the open part).  A returning key closes its tombstone.  Attributes are
    compared NULL-safely.  Snapshot rows with a NULL key, and all but one row
    of a duplicated key, are set aside (see ``snapshot_rejects``).

Plan: one full outer join of the open rows with the snapshot on the business
key; each joined row emits up to two history rows through one ``explode``
(the old row, restamped or not, and a new version or tombstone).  Closed
history rows are not read in ``open_only`` mode.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.constants import CLOSE_ALL_VERSIONS, CLOSE_OPEN_ONLY, DELETED, LIVE, OPEN_UNTIL
from daybook.functions.dates import DateLike, as_ntz, close_ts, date_start, ntz_lit, open_until
from daybook.operators import diff as D
from daybook.operators.surrogate import row_id
from daybook.schemas import empty_frame, history_schema


def history_columns(keys: list[str], attrs: list[str]) -> list[str]:
    return ["id", *keys, *attrs, "effective_from", "effective_to", "deleted_flg"]


def empty_history(spark: SparkSession, keys: list[str], attrs: list[str], base: T.StructType) -> DataFrame:
    return empty_frame(spark, history_schema(keys, attrs, base))


def is_open() -> Column:
    return F.col("effective_to") == open_until()


def scd2_current(hist: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Open, not deleted rows (the current-state view)."""
    cur = hist.filter(is_open() & (F.col("deleted_flg") == F.lit(LIVE)))
    return cur if columns is None else cur.select(*columns)


def snapshot_rejects(snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """Snapshot rows ``open_only`` mode sets aside: NULL keys and duplicated keys.

    Duplicated keys are found by a map-side-combined count and matched back
    with a semi join (a hot key is one row on the small side; AQE can split
    the large side), not by a window that would hold a hot key in one task.
    """
    null_key = " OR ".join(f"`{k}` IS NULL" for k in keys)
    valid = snapshot.where(f"NOT ({null_key})")
    dup_keys = valid.groupBy(*keys).count().where("count > 1").select(*keys)
    return snapshot.where(null_key).unionByName(valid.join(dup_keys, list(keys), "left_semi"))


def clean_snapshot(snapshot: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """Drop NULL keys; keep one deterministic row per key (the greatest payload)."""
    valid = snapshot.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    if not payload:
        return valid.select(*keys).distinct()
    fields = ", ".join(f"`{p}`" for p in payload)
    return (
        valid.groupBy(*keys)
        .agg(F.expr(f"max(struct({fields}))").alias("_v"))
        .selectExpr(*[f"`{k}`" for k in keys], *[f"_v.`{p}` AS `{p}`" for p in payload])
    )


def _with_ids(rows: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    content = [*keys, *attrs, "effective_from", "deleted_flg"]
    return rows.withColumn("id", F.coalesce(F.col("id"), row_id(content)))


def scd2_apply(
    hist: DataFrame,
    snapshot: DataFrame,
    keys: list[str],
    attrs: list[str],
    batch_date: DateLike,
    from_col: str | None = None,
    close: str = CLOSE_OPEN_ONLY,
    null_safe: bool | None = None,
) -> DataFrame:
    """History after applying one full snapshot taken on ``batch_date``.

    ``from_col``: snapshot column that supplies ``effective_from`` of NEW rows
    (the black list's own ``date``); otherwise the batch date is used.
    """
    if null_safe is None:
        null_safe = close == CLOSE_OPEN_ONLY
    cols = history_columns(keys, attrs)
    if close == CLOSE_ALL_VERSIONS:
        return _apply_all_versions(hist, snapshot, keys, attrs, batch_date, from_col, null_safe).select(*cols)
    if close == CLOSE_OPEN_ONLY:
        # Closed rows pass through untouched; only the open rows are joined.
        changes = scd2_open_changes(hist.filter(is_open()), snapshot, keys, attrs, batch_date, from_col, null_safe)
        return hist.filter(~is_open()).select(*cols).unionByName(changes.select(*cols))
    raise ValueError(f"unknown close mode {close!r}")


def _apply_all_versions(hist, snapshot, keys, attrs, batch_date, from_col, null_safe) -> DataFrame:
    cols = history_columns(keys, attrs)
    changes = all_versions_changes(hist, snapshot, keys, attrs, from_col, null_safe)
    restamped = all_versions_restamped(hist, changes, keys, batch_date)
    return restamped.select(*cols).unionByName(all_versions_added(changes, keys, attrs, batch_date, from_col).select(*cols))


def all_versions_changes(
    hist: DataFrame, snapshot: DataFrame, keys: list[str], attrs: list[str], from_col: str | None = None, null_safe: bool = False
) -> DataFrame:
    """The snapshot's difference from the current state (with ``from_col`` of the snapshot)."""
    extra = [from_col] if from_col else []
    return D.snapshot_diff(scd2_current(hist), snapshot, keys, attrs, null_safe=null_safe, snapshot_extra=extra)


def all_versions_added(changes: DataFrame, keys: list[str], attrs: list[str], batch_date: DateLike, from_col: str | None = None) -> DataFrame:
    """The rows that the changes add: new versions and tombstones."""
    batch = date_start(batch_date)
    new_from = as_ntz(F.col(from_col)) if from_col else batch
    change = F.col("change")
    eff_from = F.when(change == D.NEW, new_from).otherwise(batch)
    flg = F.when(change == D.DELETED, F.lit(DELETED)).otherwise(F.lit(LIVE))
    added = changes.select(
        F.lit(None).cast("long").alias("id"),
        *keys,
        *attrs,
        eff_from.alias("effective_from"),
        open_until().alias("effective_to"),
        flg.cast("int").alias("deleted_flg"),
    )
    return _with_ids(added, keys, attrs)


def all_versions_restamped(hist: DataFrame, changes: DataFrame, keys: list[str], batch_date: DateLike) -> DataFrame:
    """``hist`` with every version of an updated or deleted key closed (``key IN (...)``: NULL keys never match)."""
    hit = changes.filter(F.col("change").isin(D.UPDATED, D.DELETED)).select(*keys).distinct().withColumn("_hit", F.lit(True))
    closed = F.when(F.col("_hit"), close_ts(batch_date)).otherwise(F.col("effective_to"))
    return hist.join(hit, keys, "left").withColumn("effective_to", closed)


def scd2_open_changes(
    open_rows: DataFrame,
    snapshot: DataFrame,
    keys: list[str],
    attrs: list[str],
    batch_date: DateLike,
    from_col: str | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """``open_only`` step over the open rows only.

    Returns the new open rows and the rows closed by this batch, with a
    ``part`` column (``open`` / ``closed``), so a store can append the closed
    rows and replace the open ones in a single write.
    """
    cols = history_columns(keys, attrs)
    payload = list(attrs) + ([from_col] if from_col else [])
    snap = clean_snapshot(snapshot, keys, payload)
    j = D.diff_join(
        open_rows,
        snap,
        keys,
        attrs,
        null_safe=null_safe,
        current_extra=["id", "effective_from", "deleted_flg"],
        snapshot_extra=[from_col] if from_col else [],
    )
    # The emission is one SQL expression (see diff_join on why SQL text).
    d = _as_pydate(batch_date)
    start = _dt.datetime.combine(d, _dt.time())
    open_ts, close_at, start_ts = _ntz_sql(OPEN_UNTIL), _ntz_sql(start - _dt.timedelta(seconds=1)), _ntz_sql(start)
    has_o = f"(change <> '{D.NEW}')"
    has_s = f"(change <> '{D.DELETED}')"
    o_tomb = f"({has_o} AND c_deleted_flg = {DELETED})"
    o_live = f"({has_o} AND NOT {o_tomb})"
    differ = f"(change = '{D.UPDATED}')"
    close_o = f"(({has_o} AND {has_s} AND ({o_tomb} OR {differ})) OR ({o_live} AND NOT {has_s}))"
    new_version = f"({has_s} AND (NOT {has_o} OR {o_tomb} OR {differ}))"
    tombstone = f"({o_live} AND NOT {has_s})"
    new_from = f"CAST(`s_{from_col}` AS TIMESTAMP_NTZ)" if from_col else start_ts

    def row(side: str, id_sql: str | None, eff_from: str, eff_to: str, flg: str, part: str) -> str:
        cols = [f"`{side}_{c}`" for c in [*keys, *attrs]]
        eff_from = f"CAST({eff_from} AS TIMESTAMP_NTZ)"
        flg = f"CAST({flg} AS INT)"
        # New rows get a content id; carried rows keep theirs.
        rid = id_sql or f"xxhash64({', '.join([*cols, eff_from, flg])})"
        fields = ", ".join(f"'{c}', {v}" for c, v in zip([*keys, *attrs], cols))
        return (
            f"named_struct('id', CAST({rid} AS BIGINT), {fields}, 'effective_from', {eff_from}, "
            f"'effective_to', {eff_to}, 'deleted_flg', {flg}, 'part', {part})"
        )

    old = (
        f"CASE WHEN {has_o} THEN "
        + row("c", "c_id", "c_effective_from", f"CASE WHEN {close_o} THEN {close_at} ELSE {open_ts} END",
              "c_deleted_flg", f"CASE WHEN {close_o} THEN 'closed' ELSE 'open' END")
        + " END"
    )
    new = (
        f"CASE WHEN {new_version} THEN " + row("s", None, new_from, open_ts, str(LIVE), "'open'")
        + f" WHEN {tombstone} THEN " + row("c", None, start_ts, open_ts, str(DELETED), "'open'")
        + " END"
    )
    # Up to two history rows per joined row (old restamped or kept, new version
    # or tombstone), in one generator.
    return j.selectExpr(f"inline(filter(array({old}, {new}), x -> x IS NOT NULL))").select(*cols, "part")


def _as_pydate(d: DateLike) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    if isinstance(d, str):
        return _dt.date.fromisoformat(d)
    raise TypeError("the open_only apply takes a batch date value, not a column")


def _ntz_sql(ts: _dt.datetime) -> str:
    return f"TIMESTAMP_NTZ '{ts:%Y-%m-%d %H:%M:%S}'"


def terminals_current(hist: DataFrame) -> DataFrame:
    return scd2_current(hist, ["terminal_id", "terminal_type", "terminal_city", "terminal_address"])


def blacklist_current(hist: DataFrame) -> DataFrame:
    return scd2_current(hist, ["effective_from", "passport"])


def as_of(hist: DataFrame, ts: _dt.datetime | Column) -> DataFrame:
    """Rows valid at ``ts`` (not deleted), for point-in-time lookups."""
    t = ts if isinstance(ts, Column) else ntz_lit(ts)
    return hist.filter(
        (F.col("effective_from") <= t) & (t <= F.col("effective_to")) & (F.col("deleted_flg") == F.lit(LIVE))
    )
