"""The daily step on versioned tables: a day is seen in all four tables at once, or in none.

``run_day_versioned`` is ``run_day`` on a ``Warehouse``.  The tables:

``terminals``, ``blacklist``
    Open-only mode: one part with the open rows, replaced each day, and one with
    the rows that each day closed.  Reference mode (``all_versions``): the
    history by buckets of the key.  A day restamps all versions of the keys that
    it touches, so it reads and writes the buckets of these keys only; the other
    buckets' folders are shared with the version before (copy on write).
``transactions``, ``report``
    One part for each day.
``terminals_rejects``, ``blacklist_rejects``
    Snapshot rows that open-only mode sets aside, one part for each day that has
    any; their number is in the manifest.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.constants import CLOSE_OPEN_ONLY, LIVE, OPEN_UNTIL
from daybook.operators.enrich import card_holders, enrich_transactions
from daybook.operators.facts import unseen
from daybook.operators.fraud import rep_fraud
from daybook.operators.scd2 import blacklist_current, history_columns, terminals_current
from daybook.plans.daily import TX_KEYS, DailyFeeds, Dimensions
from daybook.schemas import BLACKLIST, BLACKLIST_KEYS, REP_FRAUD, TERMINAL_ATTRS, TERMINAL_KEYS, TERMINALS, TRANSACTIONS, history_schema
from daybook.session import together
from daybook.sources.histories import OPEN, apply_all_versions, apply_open_only
from daybook.sources.warehouse import Run, Warehouse, publish

HISTORIES = {"terminals": (TERMINAL_KEYS, TERMINAL_ATTRS, None), "blacklist": (BLACKLIST_KEYS, [], "date")}


def bank_warehouse(spark: SparkSession, root: str, close: str = CLOSE_OPEN_ONLY, buckets: int = 64) -> Warehouse:
    """The bank's tables below ``root``.

    ``buckets``: of the histories in reference mode; choose it so that a bucket
    is some hundred MB and well more than the keys that change on a day need.
    """
    def history(keys: list[str], attrs: list[str], base: T.StructType) -> T.StructType:
        by_name = {f.name: f for f in history_schema(keys, attrs, base)}
        return T.StructType([by_name[c] for c in history_columns(keys, attrs)])

    schemas = {
        "terminals": history(TERMINAL_KEYS, TERMINAL_ATTRS, TERMINALS),
        "blacklist": history(BLACKLIST_KEYS, [], BLACKLIST),
        "terminals_rejects": TERMINALS,
        "blacklist_rejects": BLACKLIST,
        "transactions": TRANSACTIONS,
        "report": REP_FRAUD,
    }
    options = {"close": close} | ({} if close == CLOSE_OPEN_ONLY else {"buckets": buckets})
    return Warehouse(spark, root, schemas, options)


def run_day_versioned(
    warehouse: Warehouse,
    feeds: DailyFeeds,
    dims: Dimensions,
    batch_date: _dt.date,
    initial: bool = False,
    replace_done: bool = True,
    files: list[str] | None = None,
) -> DataFrame:
    """One day on the warehouse; returns the day's report rows, read from the version that it made.

    A finished day is run again on the version before it, or left as it is if
    ``replace_done`` is false.  A failed day leaves no trace.  ``files`` names
    the files that the feeds are read from; the version keeps them.
    """
    newest = warehouse.manifest()
    day = batch_date.isoformat()
    if not (newest and newest.batch_date == batch_date and not replace_done and not initial):
        with warehouse.begin(batch_date, initial) as run:
            _, places, holders = together(
                warehouse.spark,
                lambda: run.put("transactions", day, unseen(_near(run, feeds.transactions), feeds.transactions, TX_KEYS)),
                lambda: _places(run, feeds.terminals),
                lambda: _holders(run, feeds.blacklist, dims),
            )
            run.files = sorted(files or ())
            run.put("report", day, rep_fraud(enrich_transactions(feeds.transactions, holders, places)))
        newest = run.manifest
    return warehouse.read("report", newest.version, [day])


def _places(run: Run, snapshot: DataFrame) -> DataFrame:
    """The current terminals after the day's snapshot."""
    _apply(run, "terminals", snapshot)
    return terminals_current(run.read_new("terminals", _current_parts(run, "terminals")))


def _holders(run: Run, snapshot: DataFrame, dims: Dimensions) -> DataFrame:
    """The holders of the cards after the day's black list."""
    _apply(run, "blacklist", snapshot)
    black = blacklist_current(run.read_new("blacklist", _current_parts(run, "blacklist")))
    return run.work(card_holders(dims.cards, dims.accounts, dims.clients, black), "card_holders")


def _near(run: Run, batch: DataFrame) -> DataFrame:
    """The stored transactions whose id is in the range of the batch's: the scan skips all other row groups by their statistics."""
    key = TX_KEYS[0]
    least, most = batch.agg(F.min(key), F.max(key)).first()
    stored = run.read("transactions")
    return stored if least is None else stored.where(F.col(key).between(least, most))


def _current_parts(run: Run, table: str) -> list[str]:
    """The parts that hold the open rows."""
    there = run.tables.get(table, {})
    return [OPEN] if OPEN in there or run.warehouse.options["close"] == CLOSE_OPEN_ONLY else list(there)


def _apply(run: Run, table: str, snapshot: DataFrame) -> None:
    keys, attrs, from_col = HISTORIES[table]
    if run.warehouse.options["close"] == CLOSE_OPEN_ONLY:
        apply_open_only(run, table, snapshot, keys, attrs, from_col)
    else:
        apply_all_versions(run, table, snapshot, keys, attrs, from_col)


def publish_current(warehouse: Warehouse, prefix: str = "") -> None:
    """Catalog views ``v_terminals`` and ``v_passport_blacklist`` (the current states) over the newest version."""
    parts = (lambda p: p == OPEN) if warehouse.options["close"] == CLOSE_OPEN_ONLY else (lambda p: True)
    condition = f"deleted_flg = {LIVE} AND effective_to = TIMESTAMP_NTZ '{OPEN_UNTIL:%Y-%m-%d %H:%M:%S}'"
    publish(
        warehouse,
        {
            f"{prefix}v_terminals": ("terminals", parts, condition, [*TERMINAL_KEYS, *TERMINAL_ATTRS]),
            f"{prefix}v_passport_blacklist": ("blacklist", parts, condition, ["effective_from", *BLACKLIST_KEYS]),
        },
    )
