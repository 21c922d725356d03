"""The daily step: stage -> diff -> apply histories -> fraud report.

``run_day`` is a pure function of the previous state and the day's feeds.
Order matters and follows the original load: diffs see the state *before*
the apply; the report sees the state *after* it and covers the whole staged
transaction batch.

For folds, ``cut_lineage`` writes each day's state as tables in the
cluster's shared checkpoint folder (``spark.checkpoint.dir``), so plans stay
small and a lost executor never forces a recomputation of earlier days.  Production runs read and write the state
through ``daybook.sources.store`` instead (each day a written table).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.constants import CLOSE_OPEN_ONLY
from daybook.functions.dates import DateLike
from daybook.operators.enrich import card_holders, enrich_transactions
from daybook.operators.facts import append_unseen
from daybook.operators.fraud import rep_fraud
from daybook.operators.scd2 import blacklist_current, empty_history, scd2_apply, terminals_current
from daybook.schemas import (
    BLACKLIST,
    BLACKLIST_KEYS,
    REP_FRAUD,
    TERMINAL_ATTRS,
    TERMINAL_KEYS,
    TERMINALS,
    TRANSACTIONS,
    empty_frame,
)
from daybook.session import together

TX_KEYS = ["transaction_id"]


@dataclass(frozen=True)
class Dimensions:
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame


@dataclass(frozen=True)
class DailyFeeds:
    transactions: DataFrame
    terminals: DataFrame
    blacklist: DataFrame


@dataclass(frozen=True)
class DailyState:
    terminals: DataFrame
    blacklist: DataFrame
    transactions: DataFrame
    report: DataFrame
    last_batch: _dt.date | None = None


def initial_state(spark: SparkSession) -> DailyState:
    """Empty histories (the initial-load reset)."""
    return DailyState(
        terminals=empty_history(spark, TERMINAL_KEYS, TERMINAL_ATTRS, TERMINALS),
        blacklist=empty_history(spark, BLACKLIST_KEYS, [], BLACKLIST),
        transactions=empty_frame(spark, TRANSACTIONS),
        report=empty_frame(spark, REP_FRAUD),
    )


def run_day(
    state: DailyState,
    feeds: DailyFeeds,
    dims: Dimensions,
    batch_date: DateLike,
    close: str = CLOSE_OPEN_ONLY,
    facts: bool = True,
) -> tuple[DailyState, DataFrame]:
    """Apply one day; returns the new state and the day's report rows.

    ``facts=False`` leaves the fact history untouched (the report never reads it).
    """
    batch_date = _dt.date.fromisoformat(batch_date) if isinstance(batch_date, str) else batch_date
    if close == CLOSE_OPEN_ONLY and state.last_batch is not None and isinstance(batch_date, _dt.date):
        if batch_date < state.last_batch:
            raise ValueError(f"batch {batch_date} is older than the last applied batch {state.last_batch}")
    tx_hist = append_unseen(state.transactions, feeds.transactions, TX_KEYS) if facts else state.transactions
    term = scd2_apply(state.terminals, feeds.terminals, TERMINAL_KEYS, TERMINAL_ATTRS, batch_date, close=close)
    black = scd2_apply(state.blacklist, feeds.blacklist, BLACKLIST_KEYS, [], batch_date, from_col="date", close=close)
    holders = card_holders(dims.cards, dims.accounts, dims.clients, blacklist_current(black))
    enriched = enrich_transactions(feeds.transactions, holders, terminals_current(term))
    day_report = rep_fraud(enriched)
    new_state = DailyState(
        terminals=term,
        blacklist=black,
        transactions=tx_hist,
        report=state.report.unionByName(day_report),
        last_batch=batch_date if isinstance(batch_date, _dt.date) else state.last_batch,
    )
    return new_state, day_report


def cut_lineage(state: DailyState, facts: bool = True) -> DailyState:
    """Write the state as tables in the shared checkpoint folder and read them back.

    Unlike an RDD checkpoint, a written Parquet table also gives the planner
    its real size for the next day's join decisions.
    """
    from daybook.sources.store import materialize

    # The report is a plain union of daily results (linear plan growth); the
    # histories feed the next day twice each (exponential growth) and are cut.
    return replace(
        state,
        terminals=materialize(state.terminals, "state_terminals"),
        blacklist=materialize(state.blacklist, "state_blacklist"),
        transactions=materialize(state.transactions, "state_transactions") if facts else state.transactions,
    )


def run_days(
    state: DailyState,
    days: list[tuple[DailyFeeds, DateLike]],
    dims: Dimensions,
    close: str = CLOSE_OPEN_ONLY,
    checkpoint_every: int = 0,
    facts: bool = True,
) -> DailyState:
    """Fold ``run_day`` over several days (oldest first)."""
    for i, (feeds, d) in enumerate(days, start=1):
        state, _ = run_day(state, feeds, dims, d, close=close, facts=facts)
        # Cut only where another day will build on this state.
        if checkpoint_every and i % checkpoint_every == 0 and i < len(days):
            state = cut_lineage(state, facts=facts)
    return state


@dataclass(frozen=True)
class StateRoots:
    """Storage roots of a production run (shared file system paths)."""

    terminals: str
    blacklist: str
    transactions: str
    report: str
    # Cluster the fact history by transaction_id into this many buckets (size
    # it to the history, e.g. thousands at 100 TB); None keeps a plain layout.
    fact_buckets: int | None = None


def run_day_stored(
    spark: SparkSession,
    roots: StateRoots,
    feeds: DailyFeeds,
    dims: Dimensions,
    batch_date: _dt.date,
    close: str = CLOSE_OPEN_ONLY,
    initial: bool = False,
    replace_done: bool = True,
    files: list[str] | None = None,
) -> DataFrame:
    """One production day against stored state; returns the day's report rows.

    ``close="open_only"`` (default) keeps histories in the open/closed layout;
    ``close="all_versions"`` reproduces the original close behaviour with one
    full history version per batch.  ``initial`` empties the stores first.

    The day is entered in a log before its first write and again after its
    last.  A date before the last applied one, or any other date while a begun
    day isn't finished, is refused before anything is written.  A failed day is
    run again: facts that it has already appended aren't appended twice, and
    all else replaces exactly that batch's folders.  A finished day is done
    again with the new feeds, or left as it is if ``replace_done`` is false
    (replays of a stream).  ``files`` names a stream's files of the day; the
    log keeps them.  The card -> holder dimension is a working table
    (so that the planner sizes the fact join on real bytes), removed at the end.
    """
    from daybook.sources.store import DayLog, FactStore, HistoryStore, ReportStore, VersionedHistoryStore, delete_path, materialize

    log, reports = DayLog(spark, f"{roots.report}_days"), ReportStore(spark, roots.report)
    if not initial and not replace_done and log.days().get(batch_date) == "done":
        return reports.read().where(F.col("batch_date") == F.lit(batch_date)).drop("batch_date")
    Store = HistoryStore if close == CLOSE_OPEN_ONLY else VersionedHistoryStore
    term_store = Store(
        spark, roots.terminals, TERMINAL_KEYS, TERMINAL_ATTRS,
        empty_history(spark, TERMINAL_KEYS, TERMINAL_ATTRS, TERMINALS),
    )
    black_store = Store(
        spark, roots.blacklist, BLACKLIST_KEYS, [], empty_history(spark, BLACKLIST_KEYS, [], BLACKLIST)
    )
    facts = FactStore(
        spark, roots.transactions, TX_KEYS, "transaction_date", empty_frame(spark, TRANSACTIONS),
        buckets=roots.fact_buckets,
    )
    # The staged files are immutable until archived (after commit), so they are
    # read twice (append, report) rather than copied: no daily copy of the batch.
    staged_tx = feeds.transactions
    if initial:
        log.add(batch_date, "reset")
        for store in (term_store, black_store, facts, reports):
            store.clear()
        log.add(batch_date, "begun")
    else:
        log.begin(batch_date)
    working = f"{roots.report}_work/card_holders"

    def holders_today() -> DataFrame:
        black = blacklist_current(black_store.apply(feeds.blacklist, batch_date, from_col="date"))
        return materialize(card_holders(dims.cards, dims.accounts, dims.clients, black), "card_holders", path=working)

    _, term_open, holders = together(
        spark,
        lambda: facts.append_unseen(staged_tx),
        lambda: term_store.apply(feeds.terminals, batch_date),
        holders_today,
    )
    reports.write(rep_fraud(enrich_transactions(staged_tx, holders, terminals_current(term_open))), batch_date)
    delete_path(spark, working)
    log.add(batch_date, "done", files)
    return reports.read().where(F.col("batch_date") == F.lit(batch_date)).drop("batch_date")


def register_current_views(terminals: DataFrame, blacklist: DataFrame) -> None:
    """The current states of the two histories as temporary views."""
    terminals_current(terminals).createOrReplaceTempView("v_terminals")
    blacklist_current(blacklist).createOrReplaceTempView("v_passport_blacklist")
