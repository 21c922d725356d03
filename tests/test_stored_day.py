"""The stored day under failures, reruns, empty feeds and restarts."""

import datetime as dt

import pytest
from helpers import d, rows

from daybook.plans.daily import DailyFeeds, Dimensions, StateRoots, register_current_views, run_day_stored
from daybook.operators.scd2 import empty_history
from daybook.schemas import BLACKLIST, TERMINAL_ATTRS, TERMINAL_KEYS, TERMINALS, TRANSACTIONS, empty_frame
from daybook.sources.feeds import archive_drop, drop_batch_date, read_drop
from daybook.sources.fixtures import Fixtures
from daybook.sources.store import DayLog, FactStore, HistoryStore, read_or_none
from daybook.sources.delimited import write_delimited

DAY1, DAY2 = d("2024-01-10"), d("2024-01-20")
T1 = [("T1", "ATM", "Omsk", "a"), ("T2", "POS", "Perm", "b")]
T2 = [("T1", "ATM", "Omsk", "a")]


def day(spark, terminals, ids, blacklist=()):
    tx = [(i, dt.datetime(2024, 1, 9, 10), None, "K", "pay", "OK", "T1") for i in ids]
    return DailyFeeds(
        spark.createDataFrame(tx, TRANSACTIONS),
        spark.createDataFrame(list(terminals), TERMINALS),
        spark.createDataFrame(list(blacklist), BLACKLIST),
    )


@pytest.fixture
def run(spark, tmp_path):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    dims = Dimensions(fx.cards(), fx.accounts(), fx.clients())
    roots = StateRoots(*(f"{tmp_path}/{n}" for n in "tbxr"))
    run = lambda feeds, date, **kw: run_day_stored(spark, roots, feeds, dims, date, **kw)
    run.roots = roots
    run.terminals = HistoryStore(spark, roots.terminals, TERMINAL_KEYS, TERMINAL_ATTRS, empty_history(spark, TERMINAL_KEYS, TERMINAL_ATTRS, TERMINALS))
    run.facts = lambda: sorted(r[0] for r in FactStore(spark, roots.transactions, ["transaction_id"], "transaction_date", empty_frame(spark, TRANSACTIONS)).read().collect())
    return run


def periods(store):
    return sorted((r["terminal_id"], r["effective_from"].date(), r["deleted_flg"], r["effective_to"].year == 2999) for r in store.history().collect())


def test_empty_first_blacklist_and_report(spark, run):
    assert run(day(spark, T1, [1]), DAY1).count() == 0
    assert run(day(spark, T1, [1, 2], [(dt.datetime(2024, 1, 3), "PS1")]), DAY2).count() == 0
    assert run.facts() == [1, 2]


def test_corrected_rerun_leaves_no_stale_rows(spark, run):
    run(day(spark, T1, [1]), DAY1)
    run(day(spark, T2, [2]), DAY2)
    assert ("T2", DAY2, 1, True) in periods(run.terminals)
    run(day(spark, T1, [2]), DAY2)
    assert periods(run.terminals) == [("T1", DAY1, 0, True), ("T2", DAY1, 0, True)]


def test_refused_day_writes_nothing(spark, run):
    run(day(spark, T1, [1]), DAY2)
    with pytest.raises(ValueError, match="older"):
        run(day(spark, T2, [9]), DAY1)
    assert run.facts() == [1] and len(periods(run.terminals)) == 2


def test_failed_day_must_be_run_again_first(spark, run):
    run(day(spark, T1, [1]), DAY1)
    DayLog(spark, f"{run.roots.report}_days").add(DAY2, "begun")
    with pytest.raises(ValueError, match="not finished"):
        run(day(spark, T1, [3]), d("2024-02-01"))
    run(day(spark, T2, [2]), DAY2)
    run(day(spark, T1, [5]), DAY2, replace_done=False)  # a replay of a finished day
    assert run.facts() == [1, 2] and ("T2", DAY2, 1, True) in periods(run.terminals)


def test_initial_load_empties_the_stores(spark, run):
    run(day(spark, T1, [1]), DAY2)
    run(day(spark, T2, [7]), DAY1, initial=True)
    assert run.facts() == [7] and periods(run.terminals) == [("T1", DAY1, 0, True)]
    register_current_views(run.terminals.history(), empty_history(spark, ["passport"], [], BLACKLIST))
    assert spark.table("v_terminals").count() == 1 and spark.table("v_passport_blacklist").count() == 0
    assert read_or_none(spark, f"{run.roots.report}_work/card_holders", "card_num string") is None


def test_rejects_are_stored(spark, run):
    run(day(spark, [*T1, (None, "ATM", "x", "y"), ("T1", "POS", "Omsk", "a")], [1]), DAY1)
    assert sorted((r["terminal_id"] or "", r["terminal_type"]) for r in run.terminals.rejects(DAY1).collect()) == [
        ("", "ATM"), ("T1", "ATM"), ("T1", "POS"),
    ]


def test_bucketed_facts_survive_a_new_catalog(spark, tmp_path):
    tx = day(spark, T1, [1, 2]).transactions

    def store():
        return FactStore(spark, f"{tmp_path}/f", ["transaction_id"], "transaction_date", empty_frame(spark, TRANSACTIONS), buckets=2)

    first = store()
    first.append_unseen(tx)
    spark.sql(f"DROP TABLE {first.table}")
    again = store()
    again.append_unseen(tx)
    assert sorted(r[0] for r in again.read().collect()) == [1, 2]


def _drop(spark, folder, words=("transactions", "terminals", "passport_blacklist")):
    feeds = day(spark, T1, [1], [(dt.datetime(2024, 1, 3), "PS1")])
    for word, feed in zip(("transactions", "terminals", "passport_blacklist"), (feeds.transactions, feeds.terminals, feeds.blacklist)):
        if word in words:
            write_delimited(feed, f"{folder}/{word}_10012024.txt")


def test_drop_below_a_folder_named_like_a_feed_and_archive(spark, tmp_path):
    folder = f"{tmp_path}/bank_transactions/incoming"
    _drop(spark, folder)
    feeds, date = read_drop(spark, folder)
    assert date == DAY1 and feeds.terminals.count() == 2
    assert len(archive_drop(spark, folder, f"{tmp_path}/archive")) == 3
    assert drop_batch_date(spark, f"{tmp_path}/archive") == DAY1
    with pytest.raises(ValueError):
        read_drop(spark, folder)


def test_incomplete_drop_and_lacking_column_are_refused(spark, tmp_path):
    _drop(spark, f"{tmp_path}/a", ("transactions", "passport_blacklist"))
    with pytest.raises(FileNotFoundError, match="terminals"):
        read_drop(spark, f"{tmp_path}/a")
    _drop(spark, f"{tmp_path}/b")
    write_delimited(spark.createDataFrame([("T1",)], "terminal_id string"), f"{tmp_path}/b/terminals_10012024.txt")
    with pytest.raises(ValueError, match="lacks"):
        read_drop(spark, f"{tmp_path}/b")


def test_hourly_upsert_replaces_the_unknown_passport(spark, tmp_path):
    from daybook.streaming.city_hours import upsert_into

    schema = "passport_num string, hour_start timestamp_ntz, count_cities long"
    sink, hour = upsert_into(f"{tmp_path}/hours"), dt.datetime(2024, 1, 9, 10)
    for n in (1, 2, 3):
        sink(spark.createDataFrame([(None, hour, n), (f"P{n}", hour, n)], schema), n)
    stored = spark.read.parquet(f"{tmp_path}/hours").collect()
    assert sorted((r["passport_num"] or "", r["count_cities"]) for r in stored) == [("", 3), ("P1", 1), ("P2", 2), ("P3", 3)]


def test_late_file_of_a_finished_day_is_refused_until_read(spark, run, tmp_path):
    from daybook.streaming.drops import daily_drop_stream, record_files

    fx, inc = Fixtures(spark, "/root/testdata/sf0.001"), f"{tmp_path}/incoming"
    dims = Dimensions(fx.cards(), fx.accounts(), fx.clients())

    def drain():
        daily_drop_stream(spark, inc, run.roots, dims, f"{tmp_path}/ck", archive_dir=f"{tmp_path}/old").awaitTermination()

    _drop(spark, inc, ("transactions", "terminals"))
    with pytest.raises(Exception, match="no file of the feed"):
        drain()
    _drop(spark, inc, ("passport_blacklist",))
    drain()  # the file that completed the day was read with it
    assert run.facts() == [1]
    late = day(spark, T1, [2])
    write_delimited(late.transactions, f"{inc}/transactions_10012024_b.txt")
    with pytest.raises(Exception, match="has not read"):
        drain()
    files = [f"transactions_10012024_b.txt/{p.name}" for p in (tmp_path / "incoming" / "transactions_10012024_b.txt").glob("part-*")]
    run(day(spark, T1, [1, 2], [(dt.datetime(2024, 1, 3), "PS1")]), DAY1)
    assert files and run.facts() == [1, 2]
    record_files(spark, run.roots, DAY1, files)
    drain()
    assert run.facts() == [1, 2]
