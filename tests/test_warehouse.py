"""Versions of the daily state: failed days, reruns, copy on write, what a run leaves behind, views."""

import datetime as dt

import pytest
from helpers import d, rows
from pyspark.sql import functions as F

from daybook.constants import CLOSE_ALL_VERSIONS
from daybook.plans.daily import DailyFeeds, Dimensions, initial_state, run_days
from daybook.plans.versioned import bank_warehouse, publish_current, run_day_versioned
from daybook.schemas import BLACKLIST, TERMINALS, TRANSACTIONS
from daybook.sources.fixtures import Fixtures
from daybook.sources.store import list_names

DAYS = [d("2024-01-10"), d("2024-01-20"), d("2024-01-30")]
HISTORY = ["terminal_id", "terminal_type", "terminal_city", "effective_from", "effective_to", "deleted_flg"]


def day(spark, terminals, ids, blacklist=()):
    tx = [(i, dt.datetime(2024, 1, 9, 10), None, "K1-0", "pay", "OK", "T1") for i in ids]
    return DailyFeeds(
        spark.createDataFrame(tx, TRANSACTIONS),
        spark.createDataFrame([(k, "ATM", city, None) for k, city in terminals], TERMINALS),
        spark.createDataFrame([(dt.datetime(2024, 1, 3), p) for p in blacklist], BLACKLIST),
    )


@pytest.fixture(scope="module")
def dims(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    return Dimensions(fx.cards(), fx.accounts(), fx.clients())


def folders(warehouse):
    return {n: list_names(warehouse.spark, f"{warehouse.root}/runs/{n}") for n in list_names(warehouse.spark, f"{warehouse.root}/runs")}


@pytest.mark.parametrize("close", ["open_only", CLOSE_ALL_VERSIONS])
def test_three_days_equal_the_fold_and_every_version_stays_readable(spark, tmp_path, dims, close):
    feeds = [
        day(spark, [("T1", "Omsk"), ("T2", "Perm"), (None, "x")], [1, 2], ["PS1"]),
        day(spark, [("T1", "Tver"), ("T3", "Perm"), (None, "x")], [2, 3], []),
        day(spark, [("T2", "Perm"), ("T3", "Perm"), ("T3", "Perm")], [1, 3, 4], ["PS1", "PS2"]),
    ]
    w = bank_warehouse(spark, str(tmp_path / "w"), close, buckets=4)
    assert w.manifest() is None and w.read("report").count() == 0
    for f, date in zip(feeds, DAYS, strict=True):
        run_day_versioned(w, f, dims, date)
    assert w.versions() == [1, 2, 3]
    for n in (1, 2, 3):
        state = run_days(initial_state(spark), list(zip(feeds[:n], DAYS[:n], strict=True)), dims, close=close, checkpoint_every=1)
        assert rows(w.read("terminals", n), *HISTORY) == rows(state.terminals, *HISTORY)
        assert rows(w.read("blacklist", n).drop("id")) == rows(state.blacklist.select(*w.read("blacklist", n).drop("id").columns))
        assert rows(w.read("transactions", n)) == rows(state.transactions.select(*TRANSACTIONS.names))
        assert rows(w.read("report", n)) == rows(state.report)


def test_a_failed_day_is_not_seen_and_leaves_nothing(spark, tmp_path, dims):
    w = bank_warehouse(spark, str(tmp_path / "w"))
    run_day_versioned(w, day(spark, [("T1", "Omsk")], [1], ["PS1"]), dims, DAYS[0])
    before = {t: rows(w.read(t)) for t in ("terminals", "blacklist", "transactions", "report")}
    kept = folders(w)
    broken = Dimensions(dims.cards.withColumn("account", F.expr("IF(length(card_num) > 0, CAST(raise_error('lost') AS STRING), account)")), dims.accounts, dims.clients)
    with pytest.raises(Exception, match="lost"):
        run_day_versioned(w, day(spark, [("T2", "Perm")], [2]), broken, DAYS[1])
    assert w.versions() == [1] and folders(w) == kept
    assert {t: rows(w.read(t)) for t in before} == before
    during = w.begin(DAYS[1])  # a reader during a run sees the day before
    during.put("transactions", "2024-01-20", day(spark, [], [7]).transactions)
    assert rows(w.read("transactions")) == before["transactions"]
    assert during.name in folders(w) and w.sweep() == [during.name]  # as after a lost driver
    assert folders(w) == kept


def test_a_rerun_replaces_all_of_its_first_attempt(spark, tmp_path, dims):
    w = bank_warehouse(spark, str(tmp_path / "w"))
    run_day_versioned(w, day(spark, [("T1", "Omsk")], [1]), dims, DAYS[0])
    run_day_versioned(w, day(spark, [("T9", "Omsk")], [1, 8, 9]), dims, DAYS[1])
    run_day_versioned(w, day(spark, [("T1", "Omsk")], [5]), dims, DAYS[1], replace_done=False)
    assert w.versions() == [1, 2]
    run_day_versioned(w, day(spark, [("T1", "Omsk")], [1, 2]), dims, DAYS[1])
    assert sorted(r[0] for r in w.read("transactions").collect()) == [1, 2]
    assert rows(w.read("terminals"), "terminal_id", "deleted_flg") == [("T1", 0)]
    assert sorted(r[0] for r in w.read("transactions", 2).collect()) == [1, 8, 9]
    with pytest.raises(ValueError, match="older"):
        run_day_versioned(w, day(spark, [], []), dims, DAYS[0])
    run_day_versioned(w, day(spark, [("T5", "Omsk")], [5]), dims, DAYS[0], initial=True)
    assert rows(w.read("terminals"), "terminal_id") == [("T5",)] and w.manifest().base is None
    assert w.expire(1) == [1, 2, 3] and sorted(r[0] for r in w.read("transactions").collect()) == [5]
    assert list(folders(w)) == [w.manifest().run]


def test_only_buckets_of_touched_keys_are_written(spark, tmp_path, dims):
    w = bank_warehouse(spark, str(tmp_path / "w"), CLOSE_ALL_VERSIONS, buckets=16)
    many = [(f"T{i}", "Omsk") for i in range(300)]
    run_day_versioned(w, day(spark, many, [1]), dims, DAYS[0])
    run_day_versioned(w, day(spark, [("T7", "Perm"), *(t for t in many if t[0] not in ("T7", "T8"))], [1]), dims, DAYS[1])
    first, second = (w.manifest(v).tables["terminals"] for v in (1, 2))
    changed = {p for p in second if second[p] != first[p]}
    bucket = F.pmod(F.xxhash64(F.col("k")), F.lit(16))
    expected = {f"bucket {r[0]}" for r in spark.createDataFrame([("T7",), ("T8",)], "k string").select(bucket).collect()}
    assert changed == expected and len(first) == len(second) == 16
    run = w.manifest().run
    assert set(list_names(spark, f"{w.root}/runs/{run}/terminals")) == {p.replace(" ", "=") for p in expected}
    run_day_versioned(w, day(spark, [("T7", "Perm"), *(t for t in many if t[0] not in ("T7", "T8"))], [1]), dims, DAYS[2])
    assert w.manifest().tables["terminals"] == second and "terminals" not in w.manifest().rows


def test_other_options_and_a_second_writer_are_refused(spark, tmp_path, dims):
    w = bank_warehouse(spark, str(tmp_path / "w"), CLOSE_ALL_VERSIONS, buckets=4)
    run_day_versioned(w, day(spark, [("T1", "Omsk")], [1]), dims, DAYS[0])
    with pytest.raises(ValueError, match="written with"):
        run_day_versioned(bank_warehouse(spark, w.root, CLOSE_ALL_VERSIONS, buckets=8), day(spark, [], []), dims, DAYS[1])
    late = w.begin(DAYS[1])
    late.put("transactions", "x", day(spark, [], [7]).transactions)
    versions = w.versions
    w.versions = lambda: []  # what a writer that began at the same time would see
    with pytest.raises(Exception, match="exist"):
        late.__exit__(None, None, None)
    w.versions = versions
    assert late.name not in folders(w) and w.versions() == [1] and rows(w.read("transactions"), "transaction_id") == [(1,)]
    assert list_names(spark, f"{w.root}/_versions") == ["00000001.json"]


def test_rejects_are_kept_and_counted(spark, tmp_path, dims):
    w = bank_warehouse(spark, str(tmp_path / "w"))
    run_day_versioned(w, day(spark, [("T1", "a"), (None, "b"), ("T2", "a"), ("T2", "b")], [1], ["PS1", "PS1", None]), dims, DAYS[0])
    assert w.manifest().rows["terminals_rejects"] == w.read("terminals_rejects").count() == 3
    assert w.manifest().rows["blacklist_rejects"] == 3
    run_day_versioned(w, day(spark, [("T1", "a")], [1], ["PS1"]), dims, DAYS[1])
    assert w.manifest().rows["terminals_rejects"] == 0 and w.read("terminals_rejects").count() == 3


@pytest.mark.parametrize("close", ["open_only", CLOSE_ALL_VERSIONS])
def test_views_are_read_by_another_session_after_a_rerun(spark, tmp_path, dims, close):
    w = bank_warehouse(spark, str(tmp_path / "w"), close, buckets=4)
    prefix = f"t_{close}_"
    publish_current(w, prefix)
    other = spark.newSession()
    assert other.table(f"{prefix}v_terminals").count() == 0
    run_day_versioned(w, day(spark, [("T1", "Omsk"), ("T2", "Perm")], [1], ["PS1"]), dims, DAYS[0])
    publish_current(w, prefix)
    assert rows(other.table(f"{prefix}v_terminals"), "terminal_id", "terminal_city") == [("T1", "Omsk"), ("T2", "Perm")]
    run_day_versioned(w, day(spark, [("T2", "Tver")], [1], []), dims, DAYS[1])
    run_day_versioned(w, day(spark, [("T2", "Orel")], [1], []), dims, DAYS[1])
    publish_current(w, prefix)
    assert rows(other.table(f"{prefix}v_terminals"), "terminal_id", "terminal_city") == [("T2", "Orel")]
    assert rows(other.table(f"{prefix}v_passport_blacklist")) == []
    assert other.table(f"{prefix}v_passport_blacklist").columns == ["effective_from", "passport"]
