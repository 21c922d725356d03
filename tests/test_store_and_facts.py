"""Stored state: history store equals the pure fold; reruns are idempotent; fact append."""

import datetime as dt

import pytest
from helpers import d, rows

from daybook.constants import CLOSE_OPEN_ONLY
from daybook.operators.facts import append_unseen, unseen
from daybook.operators.scd2 import empty_history, scd2_apply
from daybook.schemas import TERMINAL_ATTRS, TERMINAL_KEYS, TERMINALS, TRANSACTIONS, empty_frame
from daybook.sources.store import FactStore, HistoryStore

K, A = TERMINAL_KEYS, TERMINAL_ATTRS
S1 = [("T1", "ATM", "Moscow", "a"), ("T2", "POS", "Kazan", "b"), ("T3", "ATM", "Omsk", "c")]
S2 = [("T1", "ATM", "Tver", "a"), ("T2", "POS", "Kazan", None)]
S3 = [("T1", "ATM", "Perm", "a"), ("T2", "POS", "Kazan", None), ("T3", "ATM", "Omsk", "c")]
DAYS = [(d("2024-01-10"), S1), (d("2024-01-20"), S2), (d("2024-02-01"), S3)]


def test_history_store_equals_fold_and_reruns_are_idempotent(spark, tmpdir_path):
    store = HistoryStore(spark, f"{tmpdir_path}/terminals", K, A, empty_history(spark, K, A, TERMINALS))
    h = empty_history(spark, K, A, TERMINALS)
    for day, s in DAYS:
        snap = spark.createDataFrame(s, TERMINALS)
        store.apply(snap, day)
        h = scd2_apply(h, snap, K, A, day, close=CLOSE_OPEN_ONLY)
    assert rows(store.history()) == rows(h)
    # Rerun of the last batch with the same snapshot: same stored history.
    store.apply(spark.createDataFrame(S3, TERMINALS), DAYS[-1][0])
    assert rows(store.history()) == rows(h)
    with pytest.raises(ValueError):
        store.apply(spark.createDataFrame(S1, TERMINALS), d("2024-01-01"))


def tx(spark, data):
    return spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1, 10), None, "K", "pay", "OK", "T") for i in data], TRANSACTIONS
    )


def test_unseen_keeps_null_keys_and_batch_duplicates(spark):
    hist = tx(spark, [1, 2])
    batch = tx(spark, [2, 3, 3, None])
    assert sorted((r[0] for r in unseen(hist, batch, ["transaction_id"]).collect()), key=repr) == sorted(
        [3, 3, None], key=repr
    )
    assert append_unseen(hist, batch, ["transaction_id"]).count() == 5


def test_fact_store_append_is_idempotent(spark, tmpdir_path):
    store = FactStore(spark, f"{tmpdir_path}/facts", ["transaction_id"], "transaction_date", empty_frame(spark, TRANSACTIONS))
    store.append_unseen(tx(spark, [1, 2]))
    store.append_unseen(tx(spark, [2, 3]))
    store.append_unseen(tx(spark, [2, 3]))
    assert sorted(r[0] for r in store.read().collect()) == [1, 2, 3]


def test_bucketed_fact_store_reads_history_without_exchange(spark, tmpdir_path):
    store = FactStore(
        spark, f"{tmpdir_path}/bfacts", ["transaction_id"], "transaction_date", empty_frame(spark, TRANSACTIONS), buckets=4
    )
    store.append_unseen(tx(spark, [1, 2]))
    store.append_unseen(tx(spark, [2, 3]))
    assert sorted(r[0] for r in store.read().collect()) == [1, 2, 3]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = unseen(store.read(), tx(spark, [3, 4]), ["transaction_id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scan = [line for line in plan.splitlines() if "daybook_facts" in line][0]
    assert "Bucketed: true" in scan
    # Exactly one exchange: the batch side.
    assert plan.count("Exchange hashpartitioning") == 1


def test_prune_open_keeps_history_and_rerun(spark, tmpdir_path):
    store = HistoryStore(spark, f"{tmpdir_path}/pruned", K, A, empty_history(spark, K, A, TERMINALS))
    for day, s in DAYS:
        store.apply(spark.createDataFrame(s, TERMINALS), day)
    before = rows(store.history())
    assert store.prune_open(keep=2) == [DAYS[0][0]]
    assert spark.read.parquet(f"{tmpdir_path}/pruned/part=open/batch_date={DAYS[0][0].isoformat()}").count() == 0
    assert rows(store.history()) == before
    store.apply(spark.createDataFrame(S3, TERMINALS), DAYS[-1][0])
    assert rows(store.history()) == before


def test_versioned_store_equals_reference_fold(spark, tmpdir_path):
    from daybook.constants import CLOSE_ALL_VERSIONS
    from daybook.sources.store import VersionedHistoryStore

    store = VersionedHistoryStore(spark, f"{tmpdir_path}/versioned", K, A, empty_history(spark, K, A, TERMINALS))
    h = empty_history(spark, K, A, TERMINALS)
    for day, s in DAYS:
        snap = spark.createDataFrame(s, TERMINALS)
        store.apply(snap, day)
        h = scd2_apply(h, snap, K, A, day, close=CLOSE_ALL_VERSIONS)
    assert rows(store.history()) == rows(h)
    store.apply(spark.createDataFrame(S3, TERMINALS), DAYS[-1][0])
    assert rows(store.history()) == rows(h)


def test_stored_run_in_reference_mode_equals_pure_fold(spark, tmpdir_path):
    import __spark_entry__ as E

    from daybook.constants import CLOSE_ALL_VERSIONS
    from daybook.plans.daily import DailyFeeds, Dimensions, StateRoots, run_day_stored
    from daybook.sources.fixtures import Fixtures, batch_date

    sf = "/root/testdata/sf0.001"
    fx = Fixtures(spark, sf)
    base = f"{tmpdir_path}/ref_run"
    roots = StateRoots(f"{base}/t", f"{base}/b", f"{base}/x", f"{base}/r")
    dims = Dimensions(fx.cards(), fx.accounts(), fx.clients())
    for n in (1, 2, 3):
        feeds = DailyFeeds(fx.transactions(n), fx.terminals(n), fx.blacklist(n))
        run_day_stored(spark, roots, feeds, dims, batch_date(n), close=CLOSE_ALL_VERSIONS)
    stored = spark.read.parquet(roots.report).drop("batch_date")
    assert rows(stored) == rows(E.queries()["daily_run_report_all_versions"](spark, sf))
